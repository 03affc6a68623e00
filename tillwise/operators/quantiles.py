"""Exact quantiles of a table or of each group, without collecting a group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one hash map. That is
right for ages; it is not for amounts, whose distinct values grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.session import materialise, small_side

# The sketch is off by n / ACCURACY ranks at most; brackets reach MARGIN times as far. Groups
# so small that this reach is only a few ranks are bracketed by their extremes instead.
ACCURACY = 50_000
MARGIN = 5
FEW_RANKS = 10
# Values that one task may order for one quantile.
WINDOW_ROWS = 1_000_000


def same_groups(groups: list[str], mark: str) -> Column:
    """Equality of ``groups`` with their copies that end in ``mark``; NULL is a group like others."""
    condition = F.lit(True)
    for group in groups:
        condition = condition & F.col(group).eqNullSafe(F.col(group + mark))
    return condition


def _summed_upto(cells: DataFrame, keys: list[str], sliced: bool) -> DataFrame:
    """Adds ``_end``, the rows up to and including each value of its quantile.

    ``sliced``: the values are range-partitioned, and a value's sum is that of its slice plus
    those of all earlier slices, so no task orders more than a slice.
    """
    ordered = F.asc_nulls_first("_v")
    if not sliced:
        upto = Window.partitionBy(*keys).orderBy(ordered).rowsBetween(Window.unboundedPreceding, 0)
        return cells.withColumn("_end", F.sum("_n").over(upto))
    slices = cells.repartitionByRange(*keys, ordered).withColumn("_slice", F.spark_partition_id())
    slices = materialise(slices, "slices")
    sums = slices.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    copies = [F.col(k).alias(f"{k}_of") for k in [*keys, "_slice"]]
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).select(*copies, "_start")
    upto = Window.partitionBy(*keys, "_slice").orderBy(ordered).rowsBetween(Window.unboundedPreceding, 0)
    joined = slices.join(small_side(starts), same_groups([*keys, "_slice"], "_of"))
    return joined.withColumn("_end", F.col("_start") + F.sum("_n").over(upto)).select(*cells.columns, "_end")


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: list[str] | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles, one column per entry of ``quantiles``.

    1. A sketch of bounded size brackets every quantile between two values that are a tiny
    share of the rows apart. 2. Rows below a bracket are counted, equal values inside it
    collapse to (value, count); this combines before the shuffle, so neither a hot group nor
    a value that fills a third of the table moves as rows. 3. Only the bracket's values are
    ordered, slice by slice where a bracket may hold more than ``window_rows`` of them. A bracket
    that missed its rank would be an error, never a wrong number.

    ``df`` is read twice; hand in a stored table if it is costly to derive. NULL values are left
    out; NULL is a group of its own.
    """
    groups = by or []
    names = list(quantiles)
    rows = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    reach = MARGIN / ACCURACY
    ends = [end for q in quantiles.values() for end in (max(0.0, q - reach), min(1.0, q + reach))]
    brackets = rows.groupBy(*groups).agg(
        F.percentile_approx("_v", ends, ACCURACY).alias("_near"),
        F.array(*[F.min("_v"), F.max("_v")] * len(names)).alias("_whole"),
        F.count("*").alias("_rows"),
    )
    small = F.col("_rows") * reach <= FEW_RANKS
    ends_of = F.when(small, F.col("_whole")).otherwise(F.col("_near"))
    copies = [F.col(group).alias(f"{group}_of") for group in groups]
    brackets = materialise(brackets.select(*copies, ends_of.alias("_ends"), "_rows"), "brackets")
    # values between the ends of a bracket: its reach on both sides and the error of either end
    most = (brackets.agg(F.max("_rows")).first()[0] or 0) * 2 * (MARGIN + 1) / ACCURACY

    # the bracket ends and the group's size travel with the row, so both come from one pass
    if groups:
        bracketed = rows.join(small_side(brackets), same_groups(groups, "_of")).drop(*[f"{g}_of" for g in groups])
    else:
        both = brackets.select(F.struct("_ends", "_rows").alias("_b")).scalar()
        bracketed = rows.withColumn("_b", both).select("_v", "_b._ends", "_b._rows")

    def cell(i: int) -> Column:
        """(index, NULL) below the bracket, (index, value) inside it, NULL above it."""
        low, high = F.col("_ends")[2 * i], F.col("_ends")[2 * i + 1]
        inside = F.when(F.col("_v") >= low, F.col("_v"))
        return F.when(F.col("_v") <= high, F.struct(F.lit(i).alias("i"), inside.alias("v")))

    cells = (
        bracketed.select(*groups, "_rows", F.explode(F.array(*[cell(i) for i in range(len(names))])).alias("_c"))
        .where("_c IS NOT NULL")
        .groupBy(*groups, "_rows", F.col("_c.i").alias("_i"), F.col("_c.v").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )

    probability = F.get(F.array(*[F.lit(float(q)) for q in quantiles.values()]), F.col("_i"))
    ranked = (
        _summed_upto(cells, [*groups, "_i"], most > window_rows)
        .withColumn("_at", probability * (F.col("_rows") - 1))
        .where(F.col("_v").isNotNull())
    )

    def holds(rank: Column) -> Column:
        return (rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_n"))

    def interpolated(i: int) -> Column:
        x = F.when(F.col("_i") == i, F.col("_v").cast("double"))
        low = F.max(F.when(holds(F.floor("_at")), x))
        high = F.max(F.when(holds(F.ceil("_at")), x))
        part = F.max(F.when(F.col("_i") == i, F.col("_at") - F.floor("_at")))
        missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
        return F.coalesce(low + (high - low) * part, F.when(F.count("*") > 0, missed))

    return ranked.groupBy(*groups).agg(*[interpolated(i).alias(name) for i, name in enumerate(names)])
