"""Order-based operators that never sort a whole table, or a hot group, in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwise.functions.columns import sample_order
from tillwise.session import materialise, small_side

_SLICE_BITS = 33


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Zero-based position of every row in the total order ``order``.

    The rows are range-partitioned and sorted inside each slice; a row's position is its
    place in the slice plus the size of all earlier slices. ``order`` must end in a unique
    key, so that many equal values still spread over slices. Only the slice sizes, one row
    per partition, are summed in one place.
    """
    slices = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    slices = materialise(
        slices.withColumn("_place", place), "ranked"
    ).withColumns(
        {
            "_slice": F.shiftright("_place", _SLICE_BITS),
            "_within": F.col("_place").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)),
        }
    )
    sizes = slices.groupBy("_slice").agg((F.max("_within") + 1).alias("_size"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    return (
        slices.join(F.broadcast(starts), "_slice")
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_place", "_slice", "_within", "_start")
    )


def running_sum(df: DataFrame, measure: str, *order: Column, name: str = "running", rows: int = 4096) -> DataFrame:
    """The sum of ``measure`` up to each row in the total order ``order``, which must end in a unique key.

    Sums run inside slices of ``rows`` ranks; only the slices' totals, one row each, are summed in one place.
    """
    ranked = global_rank(df, *order, name="_rank").withColumn("_part", F.floor(F.col("_rank") / rows))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranked.groupBy("_part").agg(F.sum(measure).alias("_sum"))
    before = totals.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    # nulls add nothing, as in a sum
    upto = F.coalesce(F.sum(measure).over(inside), F.lit(0)) + F.col("_before")
    return ranked.join(before, "_part").withColumn(name, upto).drop("_rank", "_part", "_before")


def equal_count_tiles(df: DataFrame, tiles: int, *order: Column, name: str = "tile") -> DataFrame:
    """``ntile`` over the whole table: tiles 1..n whose sizes differ by one row at most."""
    ranked = global_rank(df, *order, name="_rank")
    total = F.col("_total")
    small, extra = F.floor(total / tiles), total % tiles
    in_large = extra * (small + 1)
    tile = F.when(
        F.col("_rank") < in_large, F.floor(F.col("_rank") / (small + 1))
    ).otherwise(extra + F.floor(F.try_divide(F.col("_rank") - in_large, small)))
    counted = ranked.withColumn("_total", ranked.agg(F.count("*")).scalar())
    return counted.withColumn(name, (tile + 1).cast("int")).drop("_rank", "_total")


def top_per_group(df: DataFrame, groups: list[str], n: int, *order: Column, name: str = "rn") -> DataFrame:
    """First ``n`` rows of each group. Spark cuts every map task to ``n`` rows per group
    before the shuffle, so a hot group never travels whole."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) in a fixed pseudo-random order.

    Ordering all rows for a small sample would send ``n`` candidates of every partition to
    one task. So only rows whose hash lies below a bound are ordered; the bound is set for a
    few more than ``n`` rows, and raised in the unlikely case that fewer lie below it.
    """
    order = sample_order(F.col(key), seed)
    place = F.conv(F.substring(order, 1, 13), 16, 10).cast("double") / float(16**13)
    total = df.count()
    bound = (n + 10 * math.sqrt(n) + 100) / total if total > 4 * n else 1.0
    chosen = df
    while bound < 1.0:
        chosen = df.where(place < bound)
        if chosen.count() >= n:
            break
        bound *= 4
        chosen = df
    return chosen.orderBy(order, F.col(key)).limit(n)


def _ranked_in_strata(df: DataFrame, stratum: str, key: str, seed: int) -> DataFrame:
    order = sample_order(F.col(key), seed)
    ranked = global_rank(df.where(F.col(stratum).isNotNull()), F.col(stratum), order, F.col(key), name="_rank")
    strata = ranked.groupBy(stratum).agg(F.min("_rank").alias("_first"), F.count("*").alias("_rows"))
    return ranked.join(small_side(strata), stratum).withColumn("_rank", F.col("_rank") - F.col("_first")).drop("_first")


def stratified_split(
    df: DataFrame, stratum: str, key: str, test_share: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same share of every stratum (rounded half up)."""
    ranked = _ranked_in_strata(df, stratum, key, seed)
    marked = ranked.withColumn("_test", F.col("_rank") < F.round(F.col("_rows") * test_share)).drop("_rank", "_rows")
    return marked.where(~F.col("_test")).drop("_test"), marked.where("_test").drop("_test")


def cap_per_stratum(df: DataFrame, stratum: str, key: str, cap: int, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows of every stratum, chosen in the fixed pseudo-random order."""
    return _ranked_in_strata(df, stratum, key, seed).where(F.col("_rank") < cap).drop("_rank", "_rows")
