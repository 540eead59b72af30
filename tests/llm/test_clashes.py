"""Every operator and stage on rows with extra columns named like any helper or output."""

import corpus_pipeline as P
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from lateflow.llm import (centroids, chat, decontam, langid, lm_score, mixing, phrases, secret_scan,
                          sharding, simhash, token_count, topk)
from lateflow.llm.near_dup import near_duplicates
from lateflow.llm.queries import PIECES, TOKENIZER
from lateflow.llm.shared import table

NAMES = """_n _k _u _h _c _at _cell _part _b _r _m _most _rank _before _spread _k0 _source _unit
_slot _first _last _release _deadline _taken _q number block release deadline slot position
in_horizon row order0 document letter parts read record kept paths mapping fingerprint key n h1
h2 bands sig rep component component_id a b c fp masked lo hi own other m l r rank phrase score
lang_pred held_out item item_id item_ids hits shift band own_ n_bytes n_tokens over_limit depth
prefix page shard shard_bytes bucket_bytes cell cluster distance inertia v x query_id vec_id h
word half asked seed left right inner spans base_sha256 gone twice id least stays""".split()


def clashing(df, drop=()):
    extra = [n for n in NAMES if n.lower() not in {c.lower() for c in df.columns} and n not in drop]
    return df.select("*", *[F.concat(F.lit(f"{n} of "), F.col(df.columns[0]).cast("string")).alias(n)
                            for n in extra]), extra


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_SMALL, "documents").filter("doc_id < 60")


def same(found, plain):
    names = plain.columns
    assert sorted(map(str, found.select(*names).collect())) == sorted(map(str, plain.collect()))


OPERATORS = {
    "mix": lambda d: mixing.pfair_mix(d),
    "shards": lambda d: sharding.extendible_shards(d, 20_000),
    "langid": lambda d: langid.predict(d, langid.fit(d, PIECES)),
    "tokens": lambda d: token_count.token_counts(d, TOKENIZER),
    "secrets": lambda d: secret_scan.scan(d, secret_scan.fit(d)),
    "near": lambda d: near_duplicates(d),
    "simhash": lambda d: simhash.simhash_duplicates(d),
    "phrases": lambda d: phrases.collocations(d, least=3),
    "lm": lambda d: lm_score.lm_scores(d, F.col("doc_id") % 7 == 0, PIECES),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(docs, name):
    wide, extra = clashing(docs)
    plain, found = OPERATORS[name](docs), OPERATORS[name](wide)
    made = set(plain.columns) - set(docs.columns)
    if set(docs.columns) <= set(plain.columns):  # an operator that keeps its rows' columns
        kept = [c for c in extra if c not in made]
        assert set(kept) <= set(found.columns)
        first = found.select("doc_id", *kept).first()
        assert all(first[c] == f"{c} of {first['doc_id']}" for c in kept)
    same(found, plain)


def test_operators_on_other_tables(spark, docs):
    vectors = table(spark, SF_SMALL, "embeddings").filter("vec_id < 80")
    wide, _ = clashing(vectors)
    ints = [topk.integer_vectors(d, "vec_id", "embedding") for d in (wide, vectors)]
    same(*(topk.exact_top_k(d, F.col("vec_id") % 20 == 0, 3) for d in ints))
    same(*(centroids.clustered(centroids.kept_vectors(d, "vec_id", "embedding"))
           for d in (wide, vectors)))
    items = table(spark, SF_SMALL, "benchmark")
    same(*(decontam.contamination(d, i) for d, i in (
        (clashing(docs)[0], clashing(items)[0]), (docs, items))))
    rows = table(spark, SF_SMALL, "conversations")
    said = [chat.collected_turns(d) for d in (clashing(rows)[0], rows)]
    turns = [chat.turns_from_columns(d, ["conv_id"]) for d in said]
    turns[0] = clashing(turns[0], ("mapping",))[0]
    same(*(chat.digests(chat.format_turns(d)) for d in turns))


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages(spark, docs, name):
    stage = dict(P.STAGES)[name]
    wide, extra = clashing(docs)
    plain, found = stage(spark, docs, SF_SMALL), stage(spark, wide, SF_SMALL)
    same(found.select(*docs.columns), plain.select(*docs.columns))
    made = set(plain.columns) - set(docs.columns)
    kept = [c for c in extra if c not in made]
    first = found.select("doc_id", *kept).first()
    assert all(first[c] == f"{c} of {first['doc_id']}" for c in kept)
