"""Registered queries of the text operators, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillwise.llm import ann, bpe, common, language, lexical, mixing, quality, sampling, secrets, simhash, tokens, toxicity, trie, urls
from tillwise.llm.common import read

TOXIC, GOOD = 0.3, 0.7


def op1_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=50, k=5)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return judged(toxicity.score(docs, model), TOXIC)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(read(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.score(read(spark, sf_dir, "documents"))


def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.against_next(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")), GOOD)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.grafted_nodes(read(spark, sf_dir, "conversations"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


def judged(scores: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score and predicted."""
    return scores.select(
        "doc_id",
        (common.remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_block_neighbours, op2_toxicity, op3_secrets, op4_simhash, op5_url_filter,
        op6_mixing, op7_byte_bpe, op8_language_model, op9_weighted_sampling, op10_quality,
        op11_prefix_trie, op12_token_counts, op13_lexical_search, pipeline,
    )
}

_PATTERN_CASES = "\n".join(
    f"      WHEN regexp_matches(low, '{urls.regex_of(p)}', 's') THEN '{p}'" for p in urls.PATTERNS
)
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

CHECKS: dict[str, str] = {
    "op1_block_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda x, y: x + y)) AS norm FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]), lambda x, y: x + y) / (q.norm * c.norm) AS score
  FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op5_url_filter": f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, replace(translate(coalesce(url, ''), {_AZ}), chr(10), ' ') AS low FROM pages),
h AS (
  SELECT page_id, low, translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), {_AZ}) AS host,
    regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
r AS (
  SELECT *, '.' || host AS dotted,
    CASE{_PATTERN_CASES}
    END AS pattern FROM h),
l AS (
  SELECT *, CASE
    WHEN suffix(dotted, '.example.net') AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN suffix(dotted, '.example.com') AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN suffix(dotted, '.org') AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN suffix(dotted, '.net') AND prefix(path, '/') THEN 'net/' END AS rule FROM r)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, pattern
FROM l""",
    "op11_prefix_trie": """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, conv_id - conv_id % 100 AS stem, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1))))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
g AS (
  SELECT h.conv_id, 0 AS part, o.pos, o.role, o.text FROM h JOIN o ON o.conv_id = h.stem AND o.pos <= h.h
  UNION ALL SELECT h.conv_id, 1, o.pos, o.role, o.text FROM h JOIN o ON o.conv_id = h.conv_id AND o.pos > h.h),
p AS (
  SELECT h.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (WHERE pos IS NOT NULL), []) AS path
  FROM h LEFT JOIN g USING (conv_id) GROUP BY ALL),
m AS (SELECT conv_id, len(path) AS turns, d AS depth, path[1:d] AS path FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM p)),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth > 0 THEN (count(*) - 1) * length(path[depth].text) ELSE 0 END AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
  FROM m GROUP BY path, depth),
c AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (path, depth)),
s AS (
  SELECT path[1:d] AS path, d AS depth, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM v) GROUP BY ALL)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN s USING (path, depth) LEFT JOIN n u ON u.depth = v.depth - 1 AND u.path = v.path[1:v.depth - 1]""",
    "op13_lexical_search": f"""
WITH t AS (
  SELECT rowid_, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
    '{_TERM}')) AS term FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
p AS (SELECT rowid_, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT rowid_, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY ALL),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
f AS (SELECT term, count(*) AS df FROM p GROUP BY ALL),
q AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
      '{_TERM}')) AS term FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY ALL),
w AS (SELECT q.*, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN f USING (term), s),
r AS (
  SELECT item, item_id, rowid_, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM w JOIN p USING (term) JOIN d USING (rowid_), s GROUP BY ALL HAVING score > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20""",
}
if corpus_pipeline.ORACLE_SQL is not None:
    CHECKS["pipeline"] = corpus_pipeline.ORACLE_SQL
