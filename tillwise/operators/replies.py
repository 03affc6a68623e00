"""Scoring of logged model replies: JSON extraction, tool choice, unsupported claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.columns import stripped
from tillwise.operators.ranking import top_per_group

# Points per criterion and thresholds per hardware profile.
POINTS = {"ttft": 20, "throughput": 20, "json": 20, "tool": 25, "claims": 15}
TTFT_SOFT_FACTOR = 1.6
THRESHOLDS = {
    "gpu": {"ttft_max": 1.5, "tps_min": 20.0, "tps_hard_min": 10.0, "json_min_pct": 95.0},
    "cpu": {"ttft_max": 5.0, "tps_min": 8.0, "tps_hard_min": 3.0, "json_min_pct": 90.0},
}

# The marker texts of the claim check and the French negation words.
RIGHT_CLIENTS = ["1 371 980", "1,371,980", "1371980", "1.37 million", "1,37 million"]
RIGHT_SHARE = ["75.7", "75,7"]
WRONG_CLIENTS = ["5 million", "5,000,000", "5 000 000"]
WRONG_SHARE = ["10%"]
NEGATION = r"\b(non|pas|jamais|point|aucune?|ne|incorrect|faux|erron[ée]?)\b"


def json_part(reply: Column) -> Column:
    """The JSON object inside a reply: the first fenced block that starts with a brace (an
    optional ``json`` tag aside), else everything from the first to the last brace, else the
    reply itself."""
    text = stripped(reply)
    blocks = F.transform(
        F.split(text, "```"), lambda part: stripped(F.regexp_replace(stripped(part), r"^json", ""))
    )
    fenced = F.get(F.filter(blocks, lambda part: part.startswith("{")), F.lit(0))
    braces = F.regexp_substr(text, F.lit(r"(?s)\{.*\}"))
    return F.when(text.contains("```"), F.coalesce(fenced, braces, text)).otherwise(F.coalesce(braces, text))


def parsed_replies(replies: DataFrame) -> DataFrame:
    """Adds cleaned text, validity, the chosen tool and whether tool and parameters are there."""
    # inside brackets, so that text after the first value makes it invalid
    cleaned = replies.withColumn("cleaned", json_part(F.col("reply")))
    listed = F.try_parse_json(F.concat(F.lit("["), F.col("cleaned"), F.lit("]")))

    def at(path: str, kind: str) -> Column:
        return F.try_variant_get("_v", path, kind)

    tool, parameters = at("$[0].tool", "string"), at("$[0].parameters", "variant")
    return (
        cleaned.withColumn("_v", listed)
        .withColumn("valid_json", at("$[0]", "variant").isNotNull() & at("$[1]", "variant").isNull())
        .withColumn("tool", F.when(F.col("valid_json"), tool))
        .withColumn(
            "valid_structure",
            F.col("valid_json")
            & (F.coalesce(F.col("tool"), F.lit("")) != "")
            & parameters.isNotNull()
            & ~F.is_variant_null(parameters),
        )
        .drop("_v")
    )


def tool_scores(replies: DataFrame) -> DataFrame:
    """Per model: percent of valid JSON, valid structure and right tool.

    A reply without an expected tool does not count for the right tool; an unusable reply
    with one does.
    """
    scorable = F.col("expected_tool").isNotNull()
    right = scorable & F.col("valid_structure") & (F.col("tool") == F.col("expected_tool"))
    n = F.count("*")
    return (
        parsed_replies(replies)
        .groupBy("model_id")
        .agg(
            n.alias("total_queries"),
            F.count_if("valid_json").alias("valid_json"),
            F.count_if("valid_structure").alias("valid_structure"),
            F.count_if(scorable).alias("scorable"),
            F.count_if(right).alias("correct_tool"),
            F.avg("ttft_s").alias("ttft_avg"),
            F.avg("tokens_per_s").alias("throughput_avg"),
        )
        .withColumns(
            {
                "valid_json_pct": F.round(F.col("valid_json") * 100 / F.col("total_queries"), 1),
                "valid_structure_pct": F.round(F.col("valid_structure") * 100 / F.col("total_queries"), 1),
                "correct_tool_pct": F.round(F.try_divide(F.col("correct_tool") * 100, F.col("scorable")), 1),
                "ttft_avg": F.round("ttft_avg", 3),
                "throughput_avg": F.round("throughput_avg", 1),
            }
        )
    )


def first_errors(replies: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` faulty replies of each model, with the reason."""
    wrong = (
        F.when(~F.col("valid_json"), "invalid_json")
        .when(F.col("expected_tool").isNull(), None)
        .when(~F.col("valid_structure"), "missing_tool_or_parameters")
        .when(F.col("tool") != F.col("expected_tool"), "wrong_tool")
    )
    faulty = parsed_replies(replies).withColumn("reason", wrong).where(F.col("reason").isNotNull())
    return top_per_group(faulty, ["model_id"], n, F.asc("query_id"))


def affirmed(text: Column, markers: list[str]) -> Column:
    """Whether a marker occurs in a sentence without a negation word."""
    def holds(sentence: Column) -> Column:
        named = F.lit(False)
        for marker in markers:
            named = named | sentence.contains(marker)
        return named & ~sentence.rlike(NEGATION)

    return F.exists(F.split(text, r"[.!?\n]"), holds)


def mentions(text: Column, markers: list[str]) -> Column:
    found = F.lit(False)
    for marker in markers:
        found = found | text.contains(marker)
    return found


def claim_checks(
    answers: DataFrame,
    text: str,
    right: dict[str, list[str]] | None = None,
    wrong: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Adds one flag per fact and ``claim_free``: every right fact named, no wrong one affirmed."""
    right = right or {"clients": RIGHT_CLIENTS, "vip_share": RIGHT_SHARE}
    wrong = wrong or {"clients": WRONG_CLIENTS, "vip_share": WRONG_SHARE}
    lowered = F.lower(text)
    flags = {f"mentions_{k}": mentions(lowered, v) for k, v in right.items()}
    flags.update({f"invented_{k}": affirmed(lowered, v) for k, v in wrong.items()})
    ok = F.lit(True)
    for k in right:
        ok = ok & F.col(f"mentions_{k}")
    for k in wrong:
        ok = ok & ~F.col(f"invented_{k}")
    return answers.withColumns(flags).withColumn("claim_free", ok)


def majority_verdict(checked: DataFrame) -> DataFrame:
    """Per model: passed runs, and whether more than half of them passed."""
    return (
        checked.groupBy("model_id")
        .agg(F.count("*").alias("n_runs"), F.count_if("claim_free").alias("pass_count"))
        .withColumn("pass_rate_pct", F.round(F.col("pass_count") * 100 / F.col("n_runs"), 1))
        .withColumn("hallucination_free", F.col("pass_count") * 2 > F.col("n_runs"))
    )


def model_scores(scores: DataFrame, profile: str = "cpu") -> DataFrame:
    """Score out of 100 and recommendation; ``scores`` joins tool scores and verdicts.

    Percent-based points round half to even.
    """
    limit = THRESHOLDS["gpu" if profile == "gpu" else "cpu"]
    ttft, tps = F.col("ttft_avg"), F.col("throughput_avg")
    half = {k: v // 2 for k, v in POINTS.items()}
    soft = limit["ttft_max"] * TTFT_SOFT_FACTOR
    points = {
        "ttft_points": F.when(ttft <= limit["ttft_max"], POINTS["ttft"]).when(ttft <= soft, half["ttft"]).otherwise(0),
        "throughput_points": F.when(tps >= limit["tps_min"], POINTS["throughput"])
        .when(tps >= limit["tps_hard_min"], half["throughput"])
        .otherwise(0),
        "json_points": F.bround(F.col("valid_json_pct") * POINTS["json"] / 100).cast("int"),
        "tool_points": F.coalesce(F.bround(F.col("correct_tool_pct") * POINTS["tool"] / 100).cast("int"), F.lit(0)),
        "claim_points": F.when(F.col("hallucination_free"), POINTS["claims"]).otherwise(0),
    }
    total = F.lit(0)
    for name in points:
        total = total + F.col(name)
    recommended = (
        (ttft <= limit["ttft_max"])
        & (tps >= limit["tps_hard_min"])
        & (F.col("valid_json_pct") >= limit["json_min_pct"])
        & F.col("hallucination_free")
    )
    return scores.withColumns(points).withColumn("score_100", total).withColumn("recommended", recommended)


def ranking(scored: DataFrame) -> DataFrame:
    """Models by score; one row per model, so one window holds them all."""
    place = Window.orderBy(F.desc("score_100"), F.asc("model_id"))
    return scored.withColumn("place", F.row_number().over(place)).withColumn("winner", F.col("place") == 1)
