"""Queries of the training-data operators, each over its whole table.

``QUERIES`` maps a query name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` has the oracle
text of those that SQL can express.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lateflow.llm import (centroids, chat, decontam, langid, lm_score, mixing, phrases,
                          secret_scan, sharding, token_count, topk)
from lateflow.llm.near_dup import near_duplicates
from lateflow.llm.shared import held, table
from lateflow.llm.simhash import simhash_duplicates

#: public vocabulary files
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: a shard's byte limit, fit for the sizes of the given tables
SHARD_BYTES = 1 << 20

QUERIES, SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark, sf_dir, *columns):
    return table(spark, sf_dir, "documents").select(*columns)


@query
def op4_grammar_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return secret_scan.scan(docs, secret_scan.fit(docs))


@query
def op5_transducer_tokens(spark, sf_dir):
    return token_count.token_counts(documents(spark, sf_dir, "doc_id", "text"), TOKENIZER)


@query
def op7_marginal_langid(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(held("doc_id", 4) == 2, F.lit(False)))
    model = langid.fit(docs.filter("not held_out"), PIECES)
    return langid.predict(docs.drop("lang"), model).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op9_circulant_minhash(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query
def op10_lattice_lm(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "text")
    return lm_score.lm_scores(docs, held("doc_id", 10) == 0, PIECES)


@query
def op3_fingerprint_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = chat.collected_turns(rows)
    steering = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.array(*[
        F.struct(F.lit(r).alias("role"), F.lit(steering).alias("content"))
        for r in ("user", "assistant")]).alias("messages"))  # a layout of its own
    turns = chat.turns_from_columns(said, ["conv_id"]).union(
        chat.turns_from_columns(extra, ["conv_id"]))
    return chat.digests(chat.format_turns(turns))


SQL["op3_fingerprint_chat"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc AS (
  SELECT *,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
      '&(amp|lt|lsq|nl);', '&amp;\1;', 'g'),
      '<(/?s>|</?SYS>>)', '&lt;\1', 'g'),
      '<(\|(?:turn|end|im_start|im_end|system|user|assistant|endoftext)\|>)', '&lt;\1', 'g'),
      '\[(/?INST\])', '&lsq;\1', 'g') AS etext
  FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(17 + length(role) + length(etext))::BIGINT AS formatted_chars
FROM esc GROUP BY conv_id"""


@query
def op1_pfair_mix(spark, sf_dir):
    return mixing.pfair_mix(documents(spark, sf_dir, "doc_id", "source"))


@query
def op2_impact_topk(spark, sf_dir):
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.exact_top_k(vectors, F.col("vec_id") % 100 == 0)


SQL["op2_impact_topk"] = """
WITH fine AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM fine q JOIN fine c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query
def op6_extendible_shards(spark, sf_dir):
    return sharding.extendible_shards(
        documents(spark, sf_dir, "doc_id", "text"), SHARD_BYTES).select(
        "doc_id", "n_bytes", "depth", "prefix", "page", "shard", "shard_bytes")


SQL["op6_extendible_shards"] = f"""
WITH rows AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM documents),
levels AS (
  SELECT doc_id, n_bytes, h, d, h >> ({sharding.BITS} - d) AS prefix,
    sum(n_bytes) OVER (PARTITION BY d, h >> ({sharding.BITS} - d)) AS total
  FROM rows, range(0, {sharding.BITS + 1}) AS r(d)),
fits AS (
  SELECT doc_id, n_bytes, d::INT AS depth, prefix, total::BIGINT AS shard_bytes,
    row_number() OVER (PARTITION BY doc_id ORDER BY d) AS k
  FROM levels WHERE total <= {SHARD_BYTES})
SELECT doc_id, n_bytes, depth, prefix, 0::BIGINT AS page, shard_bytes,
  CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END || '-0' AS shard
FROM fits WHERE k = 1"""


@query
def op8_template_decontam(spark, sf_dir):
    return decontam.contamination(documents(spark, sf_dir, "doc_id", "text"),
                                  table(spark, sf_dir, "benchmark")).drop("key")


@query
def op11_fingerprint_phrases(spark, sf_dir):
    return phrases.collocations(documents(spark, sf_dir, "doc_id", "text", "lang"))


SQL["op11_fingerprint_phrases"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
said AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws
  FROM pieces),
words AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM said GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
    lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM said, range(1, {phrases.LONGEST + 1}) AS s(k) WHERE len(ws) >= k),
freq AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM freq
         WHERE k >= 2 AND f >= {phrases.LEAST}),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r,
    ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y
        FROM cand, range(1, {phrases.LONGEST}) AS t(j) WHERE j < k) c
  JOIN freq l ON l.lang = c.lang AND l.phrase = c.x
  JOIN freq r ON r.lang = c.lang AND r.phrase = c.y),
lowest AS (SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT DISTINCT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM cand, range(2, {phrases.LONGEST}) AS s(m), range(1, {phrases.LONGEST}) AS t(i)
  WHERE m < k AND i + m - 1 <= k),
covered AS (SELECT lang, phrase, max(a) AS f FROM inside GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM lowest b LEFT JOIN covered v ON v.lang = b.lang AND v.phrase = b.phrase
  WHERE v.f IS NULL OR 100 * v.f < {phrases.COVERED} * b.a)
SELECT e.lang, row_number() OVER (PARTITION BY e.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM kept e JOIN words w ON w.lang = e.lang
QUALIFY rank <= {phrases.TOP}"""


@query
def op12_equal_average_clusters(spark, sf_dir):
    return centroids.clustered(centroids.kept_vectors(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))


def _rounds_sql(rounds: int) -> str:
    """CTEs c0, a0, m0, c1, ... of the assignments and means of each round."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS (
  SELECT vec_id, v, cluster, distance FROM (
    SELECT f.vec_id, f.v, c.cluster, list_sum(list_transform(list_zip(f.v, c.c),
      lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM fine f CROSS JOIN c{r} c) d
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if r < rounds:
            parts.append(f"""m{r} AS (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS c FROM (
    SELECT cluster, j, sum(v[j])::HUGEINT AS s, count(*)::HUGEINT AS n
    FROM a{r}, range(1, {centroids.COMPONENTS + 1}) AS p(j) GROUP BY cluster, j) t
  GROUP BY cluster),
c{r + 1} AS (SELECT o.cluster, coalesce(m.c, o.c) AS c
  FROM c{r} o LEFT JOIN m{r} m ON o.cluster = m.cluster)""")
    return ",\n".join(parts)


SQL["op12_equal_average_clusters"] = f"""
WITH fine AS (
  SELECT vec_id, list_transform(embedding,
    lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {centroids.COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS c FROM (
    SELECT sha256('1:' || vec_id::VARCHAR) AS h, v FROM fine ORDER BY h
    LIMIT {centroids.CENTROIDS}) t),
{_rounds_sql(centroids.ROUNDS)}
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance,
  (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(a.distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} a JOIN c{centroids.ROUNDS} c ON a.cluster = c.cluster"""


@query
def op13_pigeonring_simhash(spark, sf_dir):
    return simhash_duplicates(documents(spark, sf_dir, "doc_id", "text"))
