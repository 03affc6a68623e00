"""Sums behind the marts, kept up to date by what each merge adds.

Three tables of sums hold all that the marts need of the sales: per customer and category, per article, and per day. A sum of
parts is the sum of the whole (days by least and greatest), so a merge adds rows for its own batches, from its own batches
alone, and a read adds up what is there. The sums follow one version of the fact and of the articles: a load that replaces
either, which is how late or corrected sales of the past come in, makes the next upkeep build them anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.operators import features, star
from tillwise.sources.warehouse import Warehouse
from tillwise.streaming.merge import FACT, PIPELINE, fact_increments, last_merged, merged_fact

CONTROL = "sums_control"
#: Keys of each table of sums, and how its columns are added up.
SUMS = {
    "sums_customer": (["customer_key", "product_group_name"], {"spend": F.sum, "n": F.sum, "first": F.min, "last": F.max}),
    "sums_article": (["article_key"], {"n_sales": F.sum}),
    "sums_day": (["t_dat"], {"revenue": F.sum, "n_transactions": F.sum}),
}
#: Batches of sums from which on they are added up into a table of their own.
FOLD = 64


def _parts(warehouse: Warehouse, fact: DataFrame, *more: str) -> dict[str, DataFrame]:
    """The sums of some sales, by table."""
    groups = warehouse.read("dim_article").select("article_key", "product_group_name")
    dated = fact.withColumn("t_dat", star.key_date(F.col("date_key")))
    return {
        "sums_customer": features.category_sums(dated.join(groups, "article_key", "left"), "customer_key", *more),
        "sums_article": dated.groupBy("article_key", *more).agg(F.count("*").alias("n_sales")),
        "sums_day": dated.groupBy("t_dat", *more).agg(F.sum("price").alias("revenue"), F.count("*").alias("n_transactions")),
    }


def _added_up(name: str, rows: DataFrame) -> DataFrame:
    keys, columns = SUMS[name]
    kinds = dict(rows.dtypes)
    return rows.groupBy(*keys).agg(*[f(c).cast(kinds[c]).alias(c) for c, f in columns.items()])


def _state(warehouse: Warehouse) -> tuple[str, int] | None:
    """The versions that the sums follow, and the last batch in them."""
    if not warehouse.exists(CONTROL):
        return None
    row = warehouse.read(CONTROL).first()
    return row.source, row.upto


def _source(warehouse: Warehouse) -> str:
    return f"{warehouse.path(FACT)} {warehouse.path('dim_article')}"


def _record(warehouse: Warehouse, upto: int) -> None:
    row = warehouse.spark.createDataFrame([(_source(warehouse), upto)], "source STRING, upto BIGINT")
    warehouse.overwrite(CONTROL, row.coalesce(1))


def sums(warehouse: Warehouse, name: str) -> DataFrame:
    """A table of sums as of the last upkeep, one row per key."""
    base, upto = warehouse.read(name), _state(warehouse)[1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    later = warehouse.read_batches(name, schema, after=warehouse.holds_upto(name), upto=upto).drop("batch_id")
    return _added_up(name, base.unionByName(later))


def upkeep(warehouse: Warehouse, pipeline: str = PIPELINE, fold: int = FOLD) -> str:
    """Bring the sums up to the last merged batch: "built", "added", "folded" or "kept".

    Sums of batches are stored per batch and replaced on a repeat, and the control row is written last, so an upkeep that
    dies half-way is invisible and its repeat overwrites what it left.
    """
    state, upto = _state(warehouse), last_merged(warehouse, pipeline)[1]
    if state is None or state[0] != _source(warehouse) or state[1] > upto:
        for name, rows in _parts(warehouse, merged_fact(warehouse, pipeline)).items():
            warehouse.overwrite(name, rows, holds_upto=upto)
        _record(warehouse, upto)
        return "built"
    if state[1] == upto:
        return "kept"
    for name, rows in _parts(warehouse, fact_increments(warehouse, state[1], upto), "batch_id").items():
        warehouse.write_batches(name, rows)
    _record(warehouse, upto)
    if upto - min(warehouse.holds_upto(name) for name in SUMS) < fold:
        return "added"
    for name in SUMS:
        warehouse.overwrite(name, sums(warehouse, name), holds_upto=upto)
    return "folded"


def moved(warehouse: Warehouse, before: str) -> None:
    """Let the sums follow new versions that hold the same sales as those of ``before``, as after a compaction."""
    state = _state(warehouse)
    if state and state[0] == before:
        _record(warehouse, state[1])


def source(warehouse: Warehouse) -> str:
    """What the sums have to follow at present; for ``moved``."""
    return _source(warehouse)
