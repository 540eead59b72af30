"""The corpus pipeline: documents to clean, deduplicated, mixed training shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read back as the next stage's docs.
``run`` applies them to the documents table.

1. language_id: learns from the labelled rows of docs and drops documents without a
   language (no text or no letter) or for which no language reaches ``LEAST_SCORE``.
2. near_dedup: keeps the document with the smallest id of each group of near duplicates
   (Jaccard 0.8 over 5-word shingles). Rows are told apart by id and text: rows that repeat
   an id with another text are documents of their own, of rows that repeat both one stays
   (the least in its other columns). Rows without an id are compared with nothing and stay.
3. decontaminate: drops documents that hold a benchmark item, its numbers, units and names
   changed or not.
4. mix: orders all documents by the Pfair schedule of the sources' target weights. The
   output is range partitioned and sorted by that order, so its files, read in order of
   their names, are the mixture.
5. shard: adds each document's shard (prefix, depth, page) under the byte limit and its place
   there, by the order of the mix. The rows of a shard stand together in that order, so that
   each shard is a mixture of its own.

SQL cannot express the stages (forward recursions, MinHash), so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm import langid
from lateflow.llm.decontam import contamination
from lateflow.llm.mixing import pfair_mix
from lateflow.llm.near_dup import near_duplicates
from lateflow.llm.queries import PIECES, SHARD_BYTES
from lateflow.llm.sharding import extendible_shards
from lateflow.llm.shared import in_file_order, table, unused, written

LEAST_SCORE = 0.5
SIMILARITY = 0.8


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # columns of the documents that are named like the prediction's step aside
    aside = {c: unused(docs, c) for c in ("lang_pred", "score") if c in docs.columns}
    rows = docs.withColumnsRenamed(aside)
    scored = langid.predict(rows, langid.fit(rows, PIECES))
    known = scored.filter((F.col("lang_pred") != langid.UNKNOWN)
                          & (F.col("score") >= LEAST_SCORE))
    return known.drop("lang_pred", "score").withColumnsRenamed(
        {new: old for old, new in aside.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows are told apart by id and text, so that an id that repeats links nothing
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = docs.filter("doc_id is not null").select(
        key.alias("doc_id"), F.col("doc_id").cast("long").alias("id"), "text")
    found = written(near_duplicates(rows.select("doc_id", "text"), threshold=SIMILARITY)
                    .groupBy("doc_id").agg(F.max("component_id").alias("component"),
                                           F.count(F.lit(1)).alias("n")), "groups")
    placed = written(found.join(rows.select("doc_id", "id").distinct(), "doc_id"), "placed")
    stays = placed.filter("component is not null").groupBy("component").agg(
        F.min("id").alias("least"))
    tied = placed.join(stays, "component")  # the smallest id; of equal ids the smallest key
    stays = tied.filter("id = least").groupBy("component").agg(F.min("doc_id").alias("stays"))
    gone, twice = unused(docs, "gone"), unused(docs, "twice")
    # written first, so that Spark knows the bytes of the small sides before it picks a join
    dropped = written(placed.join(stays, "component").filter("doc_id <> stays").select(
        F.col("doc_id").alias(gone)), "dropped")
    again = written(placed.filter("n > 1").select(F.col("doc_id").alias(twice)).join(
        dropped, F.col(twice) == F.col(gone), "left_anti"), "repeated")
    # without an id a row has been compared with nothing
    own = F.when(F.col("doc_id").isNotNull(), key)
    kept = docs.join(dropped, own == F.col(gone), "left_anti")
    if again.isEmpty():
        return kept.select(*docs.columns)
    whole = F.struct(*docs.columns)
    once = kept.join(again, own == F.col(twice)).groupBy(twice).agg(
        F.min(whole).alias("row")).select("row.*")
    return kept.join(again, own == F.col(twice), "left_anti").select(*docs.columns).union(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = written(found.filter("contaminated").select("key").distinct(), "contaminated")
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.join(bad, key == bad["key"], "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the documents travel as one column, so that columns named like the schedule's stay
    whole = docs.select(F.struct(*docs.columns).alias("document"), "source", "doc_id")
    mixed = pfair_mix(whole, order=["doc_id"]).select("document", "position")
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select(
        "document.*")


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the mix is the order of its files; a window holds one shard, which the limit bounds
    mixed = unused(docs, "mixed")
    rows = extendible_shards(in_file_order(docs, mixed), SHARD_BYTES)
    shard = Window.partitionBy("prefix", "depth", "page").orderBy(mixed)
    return rows.withColumn("place", F.row_number().over(shard).cast("long") - 1).drop(mixed)


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("shard", assign_shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
