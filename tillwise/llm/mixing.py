"""Rates at which documents are taken, so that each domain's expected share of the tokens meets its target.

A document belongs to each domain in part: a classifier learnt from labelled rows gives the parts. Nonnegative rates
start at one; projected gradient steps bring the expected tokens of the domains to their targets in the least squares sense. A step is scaled by
the matrix of tokens that domains share in documents whose rate is free to move, and its length is the best of a few, tried in one pass.
DataFrame functions alone: no Python runs on the executors; what reaches the driver are sums for each domain and pair of domains.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import common
from tillwise.session import materialise

#: Labelled documents that the classifier reads, about, and words that it knows, at most.
SAMPLE, VOCABULARY = 20_000, 2_000
#: A document's evidence counts as that of so many words at most, so that long texts stay members of several domains.
EVIDENCE = 20.0
#: Gradient steps at most, and the largest miss of a target, as a share of it, that ends them.
STEPS, CLOSE = 60, 1e-4
#: Lengths of scaled and of plain steps that are tried at once; the gain of a step, as a share of the loss, below which nothing more is to be had.
LENGTHS, PLAIN, GAIN = (1.0, 0.5, 0.1, 0.01), (1.0, 4.0, 16.0), 1e-9


def words_in(text: Column) -> Column:
    """The words of a text, with some empty strings between."""
    return F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ")


def add(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def vocabulary(docs: DataFrame, labelled: DataFrame, domain: str) -> tuple[list[str], list[float], DataFrame]:
    """The domains, the logarithms of their smoothed shares, and for each known word its log likelihoods.

    Domains are the values of ``domain`` in labelled documents; there should be tens of them, as each is a column.
    """
    ids = labelled.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    if (n := ids.count()) > SAMPLE:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * SAMPLE / n))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(domain).cast("string").alias("domain"), "text")
    sample = materialise(rows.where(F.col("domain").isNotNull()).join(F.broadcast(ids), "doc_id"), "labelled")
    sizes = sorted((r["domain"], r["count"]) for r in sample.groupBy("domain").count().collect())
    names, total = [d for d, _ in sizes], sum(n for _, n in sizes)
    prior = [math.log((n + 1) / (total + len(sizes))) for _, n in sizes]
    found = sample.select("domain", F.explode(words_in(F.coalesce("text", F.lit("")))).alias("word")).where("word <> ''")
    each = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"n{i}") for i, d in enumerate(names)]
    counted = materialise(found.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *each), "words")
    known = materialise(common.largest(counted, F.col("n"), VOCABULARY), "vocabulary")
    sums = known.agg(*[F.sum(f"n{i}") for i in range(len(names))]).first() if names else ()
    likelihoods = [F.log((F.col(f"n{i}") + 1) / F.lit(float((s or 0) + VOCABULARY))).alias(f"l{i}") for i, s in enumerate(sums)]
    return names, prior, known.select("word", *likelihoods)


def posteriors(docs: DataFrame, labelled: DataFrame, domain: str) -> tuple[list[str], DataFrame]:
    """The domains, and for each doc_id its number of words ``n_tokens`` and its parts ``p0``, ``p1``, ... of the domains.

    Rows that share an id (or have none) are pooled as one document. Texts without known words, empty and null ones among
    them, have the domains' shares. Every word of every text counts; the words known are a table of bounded size.
    """
    names, prior, known = vocabulary(docs, labelled, domain)
    k = range(len(names))
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode_outer(words_in("text")).alias("word"))
    hits = words.join(F.broadcast(known), "word", "left")
    pooled = hits.groupBy("doc_id").agg(
        F.sum(F.when(F.col("word") != "", 1).otherwise(0)).alias("n_tokens"),
        F.count(F.col("l0") if names else F.lit(None)).alias("met"),
        *[F.coalesce(F.sum(f"l{i}"), F.lit(0.0)).alias(f"l{i}") for i in k],
    )
    weight = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest("met", F.lit(1)))
    pooled = pooled.select("doc_id", "n_tokens", *[(F.lit(prior[i]) + weight * F.col(f"l{i}")).alias(f"z{i}") for i in k])
    # F.greatest wants two columns at least
    top = F.greatest(*[f"z{i}" for i in k], F.lit(-1e300)) if names else F.lit(0.0)
    pooled = pooled.select("doc_id", "n_tokens", *[F.exp(F.col(f"z{i}") - top).alias(f"e{i}") for i in k])
    whole = add([F.col(f"e{i}") for i in k]) if names else F.lit(1.0)
    return names, pooled.select("doc_id", "n_tokens", *[(F.col(f"e{i}") / whole).alias(f"p{i}") for i in k])


def misses(reached: list[float], goal: list[float]) -> list[float]:
    """By which share each target is missed; a target of nothing counts as one token."""
    return [abs(r - g) / max(g, 1.0) for r, g in zip(reached, goal)]


def fitted(table: DataFrame, goal: list[float]) -> tuple[DataFrame, list[float]]:
    """``table`` (n_tokens, p0, p1, ... and rate, which is 1) with nonnegative rates, and the tokens that the domains then have.

    The rates are the least squares fit of the domains' tokens to ``goal``, so a target that can't be met is missed as little as the others allow.
    """
    k = range(len(goal))
    tokens = F.col("n_tokens") * 1.0

    def reached_by(tried: list[Column]) -> list[list[float]]:
        sums = [F.sum(tokens * r * F.col(f"p{i}")) for r in tried for i in k]
        found = [float(x or 0) for x in table.agg(*sums).first()]
        return [found[n * len(goal) : (n + 1) * len(goal)] for n in range(len(tried))]

    def loss(reached: list[float]) -> float:
        return sum((r - g) ** 2 for r, g in zip(reached, goal))

    rate = F.col("rate")
    [reached] = reached_by([rate])
    for step in range(STEPS):
        if max(misses(reached, goal), default=0.0) <= CLOSE:
            break
        over = np.array(reached) - np.array(goal)

        def along(x: np.ndarray) -> Column:
            return add([F.col(f"p{i}") * F.lit(float(x[i])) for i in k])

        # a rate of zero that would fall stays; only the others share in the scaled step
        free = (rate > 0) | (along(over) < 0)
        pairs = [(i, j) for i in k for j in range(i + 1)]
        of = table.where(free).agg(*[F.sum(tokens * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in pairs]).first()
        shared = np.zeros((len(goal), len(goal)))
        for (i, j), x in zip(pairs, of):
            shared[i, j] = shared[j, i] = float(x or 0)
        scaled, steepest = np.linalg.lstsq(shared, over, rcond=1e-12)[0], np.linalg.eigvalsh(shared)[-1]
        if not steepest:
            break
        zero = F.lit(0.0)
        tried = [F.when(free, F.greatest(zero, rate - along(s * scaled))).otherwise(zero) for s in LENGTHS]
        tried += [F.greatest(zero, rate - along(s * over / steepest)) for s in PLAIN]
        found = reached_by(tried)
        best = min(range(len(tried)), key=lambda n: loss(found[n]))
        if loss(found[best]) >= (1 - GAIN) * loss(reached):
            break
        rate, reached = tried[best], found[best]
        if step % 4 == 3:  # keeps the expression short
            table = materialise(table.withColumn("rate", rate), "rates")
            rate = F.col("rate")
    return table.withColumn("rate", rate), reached


def rates(
    docs: DataFrame, labelled: DataFrame, domain: str = "lang", targets: dict[str, float] | None = None, evenness: float = 0.5
) -> DataFrame:
    """doc_id, n_tokens, domain (the likeliest), belongs (its part of it), rate (>= 0), copies, and its domain's target_tokens and reached_tokens.

    ``targets`` are weights by domain (missing ones are zero); by default each domain's share to the power 1 - ``evenness``,
    so that small domains gain. They are scaled to the tokens that there are. ``copies`` is the rate's whole part,
    and one more where a hash of doc_id is below the rest. Without labelled rows, or tokens, every rate is one.
    """
    names, parts = posteriors(docs, labelled, domain)
    table = materialise(parts.withColumn("rate", F.lit(1.0)), "posteriors")
    k = range(len(names))
    goal = reached = [0.0 for _ in k]
    if names:
        mass = [float(x or 0) for x in table.agg(*[F.sum(F.col("n_tokens") * F.col(f"p{i}")) for i in k]).first()]
        total = sum(mass)
        share = [(targets.get(d, 0.0) if targets else (m / total) ** (1 - evenness)) if total else 0.0 for d, m in zip(names, mass)]
        goal = [total * s / sum(share) if sum(share) else 0.0 for s in share]
        reached = mass
        if total:
            table, reached = fitted(table, goal)
    best = F.greatest(*[f"p{i}" for i in k], F.lit(0.0)) if names else F.lit(1.0)

    def of_likeliest(values: list) -> Column:
        out = F.lit(None)
        for i in reversed(k):
            out = F.when(F.col(f"p{i}") == best, F.lit(values[i])).otherwise(out)
        return out

    chance = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return table.select(
        "doc_id",
        "n_tokens",
        of_likeliest(names).cast("string").alias("domain"),
        best.alias("belongs"),
        "rate",
        copies.alias("copies"),
        of_likeliest(goal).cast("double").alias("target_tokens"),
        of_likeliest(reached).cast("double").alias("reached_tokens"),
    )


def mix(docs: DataFrame, labelled: DataFrame, domain: str = "lang", targets: dict[str, float] | None = None) -> DataFrame:
    """Every row as many times as its document's ``copies``, with all its columns; see ``rates``."""
    name, time = common.fresh(docs, "mixed_id"), common.fresh(docs, "time")
    count = common.fresh(docs, "copies")
    taken = rates(docs, labelled, domain, targets).select(F.col("doc_id").alias(name), F.col("copies").alias(count))
    joined = docs.join(taken.where(F.col(count) > 0).hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col(name)))
    repeated = joined.withColumn(time, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
