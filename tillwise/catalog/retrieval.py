"""Sections, vector search and reply scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query, view
from tillwise.operators import inverted, ranking, replies, retrieval
from tillwise.session import materialise

view(
    "marked",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '# doc ' || CAST(doc_id AS VARCHAR) || chr(10) ELSE '' END
  || array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN i % 3 = 0 THEN '## ' || x ELSE x END), chr(10)) AS md
  FROM documents""",
)
view(
    "mdlines",
    """SELECT doc_id, ln, i, SUM(CASE WHEN starts_with(ln, '## ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS sec
  FROM (SELECT doc_id, unnest(string_split(md, chr(10))) AS ln, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM marked)""",
)


@query(
    "r01_markdown_sections",
    r"""SELECT doc_id, CAST(sec AS BIGINT) AS section, title, content FROM (
  SELECT doc_id, sec, coalesce(any_value(regexp_replace(substr(ln, 4), '^\s+|\s+$', '', 'g')) FILTER (starts_with(ln, '## ')), 'Overview') AS title,
    regexp_replace(coalesce(string_agg(ln, chr(10) ORDER BY i) FILTER (NOT starts_with(ln, '## ') AND NOT starts_with(ln, '# ')), ''), '^\s+|\s+$', '', 'g') AS content
  FROM mdlines GROUP BY doc_id, sec) WHERE content <> ''""",
)
def r01(t):
    return retrieval.markdown_sections(t.markdown, "Overview")


view(
    "centre",
    """SELECT label AS query_id, list(m ORDER BY pos) AS c FROM (SELECT label, pos, AVG(x::DOUBLE) AS m FROM (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1""",
)


@query(
    "r02_cosine",
    """SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 8) AS similarity
  FROM embeddings JOIN centre ON label = query_id""",
)
def r02(t):
    centres = t.query_vectors.select(F.col("query_id").alias("label"), F.col("embedding").alias("centre"))
    pairs = retrieval.similarity(t.vectors.join(centres, "label"), "embedding", "centre")
    return pairs.select("vec_id", F.round("similarity", 8).alias("similarity"))


@query(
    "r03_search",
    """SELECT query_id, CAST(vec_id AS BIGINT) AS vec_id, rank, round(s, 8) AS similarity FROM (
  SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (
   SELECT query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], c) AS s FROM embeddings, centre)) WHERE rank <= 2 AND s >= 0.3""",
)
def r03(t):
    found = retrieval.search(t.query_vectors, t.vectors)
    return found.select("query_id", "vec_id", "rank", F.round("similarity", 8).alias("similarity"))


@query(
    "r04_indexed_search",
    """SELECT CAST(query_id AS BIGINT) AS query_id, arg_min(vec_id, (-s, vec_id)) AS exact_hit, round(MAX(s), 8) AS exact_similarity, true AS not_above_exact FROM (
   SELECT query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 12) AS s FROM embeddings, centre) GROUP BY 1""",
)
def r04(t):
    exact = retrieval.search(t.query_vectors, t.vectors, n=1, threshold=-1.0)
    indexed = retrieval.indexed_search(t.query_vectors, t.vectors)
    compared = retrieval.compare_searches(exact, indexed)
    below = F.col("indexed_similarity") <= F.col("exact_similarity") + 1e-9
    return compared.select(
        "query_id",
        "exact_hit",
        F.round("exact_similarity", 8).alias("exact_similarity"),
        F.coalesce(below, F.lit(True)).alias("not_above_exact"),
    )


@query(
    "r04_inverted_file",
    """SELECT COUNT(*) FILTER (vec_id % 50 = 0) AS n_queries, true AS first_found, true AS five_found, true AS few_compared FROM embeddings""",
)
def r04_inverted(t):
    """Every fiftieth vector against all others: recall of the nearest and of the nearest five, and the share compared in full."""
    probe = t.vectors.where(F.col("vec_id") % 50 == 0).withColumnRenamed("vec_id", "query_id")
    found = materialise(inverted.search(inverted.build(t.vectors), probe, n=5, keep=60, skip_self=True), "found")
    pairs = retrieval.search(probe, t.vectors, n=6, threshold=-1.0).where("query_id <> vec_id")
    exact = materialise(ranking.top_per_group(pairs.drop("rank"), ["query_id"], 5, F.desc("similarity"), F.asc("vec_id"), name="rank"), "exact")
    shares = [inverted.recall(exact, found, n) for n in (1, 5)]
    row = (probe.count(), shares[0] >= 0.9, shares[1] >= 0.9, 60 / t.vectors.count() <= 0.15)
    return t.spark.createDataFrame([row], "n_queries BIGINT, first_found BOOLEAN, five_found BOOLEAN, few_compared BOOLEAN")


# replies as the binding builds them from the conversation turns
view(
    "repl",
    """SELECT ['m-small', 'm-mid', 'm-large'][conv_id % 3 + 1] AS model_id, num AS query_id,
  CASE WHEN num % 13 = 0 THEN NULL WHEN num % 7 = 0 THEN 'search' ELSE chosen END AS expected_tool, chosen, text AS said, num % 10 AS form,
  length(text) % 97 / 20.0::DOUBLE AS ttft_s, 2 + length(text) % 31 / 2.0::DOUBLE AS tokens_per_s
  FROM (SELECT *, conv_id * 8 + turn AS num, ['profile', 'history', 'search', 'predict'][(conv_id * 8 + turn) % 4 + 1] AS chosen FROM conversations)""",
)
view(
    "toolscore",
    """SELECT model_id, COUNT(*) AS total_queries, COUNT(*) FILTER (form <> 3) AS valid_json, COUNT(*) FILTER (form NOT IN (3, 4)) AS valid_structure,
  COUNT(expected_tool) AS scorable, COUNT(*) FILTER (form NOT IN (3, 4) AND chosen = expected_tool) AS correct_tool,
  round(AVG(ttft_s), 3) AS ttft_avg, round(AVG(tokens_per_s), 1) AS throughput_avg,
  round(COUNT(*) FILTER (form <> 3) * 100 / COUNT(*), 1) AS valid_json_pct,
  round(COUNT(*) FILTER (form NOT IN (3, 4)) * 100 / COUNT(*), 1) AS valid_structure_pct,
  round(COUNT(*) FILTER (form NOT IN (3, 4) AND chosen = expected_tool) * 100 / COUNT(expected_tool), 1) AS correct_tool_pct
  FROM repl GROUP BY model_id""",
)


@query(
    "r05_json_replies",
    """SELECT query_id, form <> 3 AS valid_json, CASE WHEN form <> 3 THEN chosen END AS tool, form NOT IN (3, 4) AS valid_structure,
  CASE WHEN form NOT IN (3, 4) THEN said END AS said FROM repl""",
)
def r05(t):
    parsed = replies.parsed_replies(t.replies)
    said = F.when(F.col("valid_structure"), F.get_json_object("cleaned", "$.parameters.q"))
    return parsed.select("query_id", "valid_json", "tool", "valid_structure", said.alias("said"))


@query("r06_tool_scores", "SELECT * FROM toolscore")
def r06(t):
    return replies.tool_scores(t.replies)


@query(
    "r06_first_errors",
    """SELECT model_id, query_id, reason, rn FROM (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY query_id) AS rn FROM (
  SELECT model_id, query_id, CASE WHEN form = 3 THEN 'invalid_json' WHEN expected_tool IS NULL THEN NULL
    WHEN form = 4 THEN 'missing_tool_or_parameters' WHEN chosen <> expected_tool THEN 'wrong_tool' END AS reason FROM repl)
  WHERE reason IS NOT NULL) WHERE rn <= 10""",
)
def r06_errors(t):
    return replies.first_errors(t.replies).select("model_id", "query_id", "reason", "rn")


RIGHT = {"clients": ["en", "la"], "vip_share": ["de", "the"]}
WRONG = {"clients": ["eau", "ing"], "vip_share": ["ung"]}
NEGATED = r"(^|[^\w])(non|pas|jamais|point|aucune?|ne|incorrect|faux|erron[ée]?)($|[^\w])"


def _affirmed(markers):
    named = " OR ".join(f"contains(x, '{m}')" for m in markers)
    return (
        f"len(list_filter(regexp_split_to_array(lower(text), '[.!?\\n]'), lambda x: ({named}) AND NOT regexp_matches(x, '{NEGATED}'))) > 0"
    )


def _named(markers):
    return "(" + " OR ".join(f"contains(lower(text), '{m}')" for m in markers) + ")"


view(
    "claims",
    f"""SELECT conv_id, turn, ['m-small', 'm-mid', 'm-large'][conv_id % 3 + 1] AS model_id,
  {_named(RIGHT["clients"])} AS mentions_clients, {_named(RIGHT["vip_share"])} AS mentions_vip_share,
  {_affirmed(WRONG["clients"])} AS invented_clients, {_affirmed(WRONG["vip_share"])} AS invented_vip_share FROM conversations""",
)
view(
    "verdict",
    """SELECT model_id, COUNT(*) AS n_runs, COUNT(*) FILTER (ok) AS pass_count,
  round(COUNT(*) FILTER (ok) * 100 / COUNT(*), 1) AS pass_rate_pct, COUNT(*) FILTER (ok) * 2 > COUNT(*) AS hallucination_free FROM (
  SELECT model_id, mentions_clients AND mentions_vip_share AND NOT invented_clients AND NOT invented_vip_share AS ok FROM claims) GROUP BY 1""",
)


def _checked(t):
    turns = t.raw("conversations").withColumn(
        "model_id",
        F.element_at(F.array(F.lit("m-small"), F.lit("m-mid"), F.lit("m-large")), (F.col("conv_id") % 3 + 1).cast("int")),
    )
    return replies.claim_checks(turns, "text", RIGHT, WRONG)


@query(
    "r07_claim_checks",
    """SELECT conv_id, turn, mentions_clients, mentions_vip_share, invented_clients, invented_vip_share,
  mentions_clients AND mentions_vip_share AND NOT invented_clients AND NOT invented_vip_share AS claim_free FROM claims""",
)
def r07(t):
    return _checked(t).drop("role", "text", "model_id")


@query("r07_verdict", "SELECT * FROM verdict")
def r07_verdict(t):
    return replies.majority_verdict(_checked(t))


_EVEN = "CAST(round_even({0}, 0) AS BIGINT)"


@query(
    "r08_model_ranking",
    f"""SELECT *, place = 1 AS winner FROM (SELECT *, row_number() OVER (ORDER BY score_100 DESC, model_id) AS place FROM (
  SELECT model_id, ttft_points, throughput_points, json_points, tool_points, claim_points,
   ttft_points + throughput_points + json_points + tool_points + claim_points AS score_100, recommended FROM (
  SELECT model_id, CASE WHEN ttft_avg <= 5 THEN 20 WHEN ttft_avg <= 8 THEN 10 ELSE 0 END::BIGINT AS ttft_points,
   CASE WHEN throughput_avg >= 8 THEN 20 WHEN throughput_avg >= 3 THEN 10 ELSE 0 END::BIGINT AS throughput_points,
   {_EVEN.format("valid_json_pct * 20 / 100")} AS json_points, {_EVEN.format("correct_tool_pct * 25 / 100")} AS tool_points,
   CASE WHEN hallucination_free THEN 15 ELSE 0 END::BIGINT AS claim_points,
   ttft_avg <= 5 AND throughput_avg >= 3 AND valid_json_pct >= 90 AND hallucination_free AS recommended
  FROM toolscore JOIN verdict USING (model_id))))""",
)
def r08(t):
    scores = replies.tool_scores(t.replies).join(replies.majority_verdict(_checked(t)), "model_id")
    ranked = replies.ranking(replies.model_scores(scores))
    return ranked.select(
        "model_id",
        "ttft_points",
        "throughput_points",
        "json_points",
        "tool_points",
        "claim_points",
        "score_100",
        "recommended",
        "place",
        "winner",
    )
