"""Files, warehouse versions and the JDBC connector's requests."""

import pytest
from pyspark.sql import functions as F

from tillwise import model
from tillwise.session import shared_folder
from tillwise.sources import files, jdbc, streams


class Recorder:
    """Stands in for a session whose reader only writes down what it is asked."""

    def __init__(self, bounds=None):
        self.calls, self.bounds = [], bounds
        self.read = self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.bounds


def test_jdbc_table_and_query():
    recorder = Recorder()
    jdbc.read_table(recorder, "jdbc:x", "t", {"user": "u"})
    jdbc.read_query(recorder, "jdbc:x", "SELECT 1", {})
    assert [c[0] for c in recorder.calls] == ["t", "(SELECT 1) t"]


def test_jdbc_ranges_ask_for_the_bounds_first():
    recorder = Recorder((3, 99))
    jdbc.read_ranges(recorder, "jdbc:x", "fact", "k", {}, 8, source="SELECT k FROM fact")
    assert recorder.calls[0][0] == "(SELECT MIN(k) AS low, MAX(k) AS high FROM fact) t"
    table, options = recorder.calls[1]
    assert table == "(SELECT k FROM fact) t"
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("k", 3, 99, 8)


def test_jdbc_ranges_of_an_empty_table():
    recorder = Recorder((None, None))
    jdbc.read_ranges(recorder, "jdbc:x", "fact", "k", {})
    assert recorder.calls[1] == ("fact", {"properties": {}})


def test_kafka_options():
    class Reader:
        def __init__(self):
            self.options, self.readStream = {}, self

        def format(self, name):
            self.options["format"] = name
            return self

        def option(self, key, value):
            self.options[key] = value
            return self

        def load(self):
            return self

        def select(self, *columns):
            return self.options

    got = streams.kafka_messages(Reader(), "host:1", "sales")
    assert got["format"] == "kafka" and got["subscribe"] == "sales"
    assert got["startingOffsets"] == "latest" and got["failOnDataLoss"] == "false"


def test_csv_keeps_bad_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("t_dat,customer_id,article_id,price,sales_channel_id\n2020-01-01,c,1,2.5,1\n2020-01-02,d,x,oops,2\n")
    rows = files.read_csv(spark, str(path), model.TRANSACTIONS, keep_bad=True).collect()
    assert rows[0]._bad_record is None and rows[0].price == 2.5
    assert rows[1].article_id is None and rows[1].price is None and rows[1].customer_id == "d"
    assert rows[1]._bad_record == "2020-01-02,d,x,oops,2"


def test_inferred_csv_respects_overrides(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,day,n\n0012,2020-01-01,5\n0013,never,6\n")
    frame = files.read_csv_inferred(spark, str(path), {"id": "string"}, dates=("day",))
    assert dict(frame.dtypes) == {"id": "string", "day": "date", "n": "int"}
    assert [r.id for r in frame.orderBy("id").collect()] == ["0012", "0013"]
    assert frame.where("day IS NULL").count() == 1


def test_sales_schemas_have_the_input_columns(spark):
    frame = spark.createDataFrame([], model.ARTICLES)
    assert len(frame.columns) == 25
    assert len(spark.createDataFrame([], model.CUSTOMERS).columns) == 7


def test_features_from_file_or_table(spark, tmp_path):
    with pytest.raises(ValueError):
        spark.createDataFrame([], "customer_id STRING").write.parquet(str(tmp_path / "empty"))
        files.read_features(spark, path=str(tmp_path / "empty"))
    spark.range(3).createOrReplaceTempView("some_features")
    assert files.read_features(spark, table="some_features").count() == 3


def test_failed_overwrite_leaves_the_old_version(spark, warehouse):
    warehouse.overwrite("t", spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception):
        warehouse.overwrite("t", broken)
    assert warehouse.read("t").count() == 3
    warehouse.overwrite("t", spark.range(5))
    assert warehouse.read("t").count() == 5


def test_overwrite_may_read_what_it_replaces(spark, warehouse):
    warehouse.overwrite("t", spark.range(3))
    warehouse.overwrite("t", warehouse.read("t").where("id > 0"))
    assert warehouse.read("t").count() == 2


def test_missing_table(warehouse):
    with pytest.raises(LookupError):
        warehouse.read("nothing")
    assert warehouse.read_batches("nothing", "a INT").count() == 0


def test_partitioned_fact_prunes_by_month(spark, warehouse):
    rows = spark.range(100).select((F.col("id") % 4 + 202001).cast("int").alias("month_key"), "id")
    warehouse.overwrite("fact", rows, partition_by="month_key")
    one = warehouse.read("fact").where("month_key = 202002")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan
    assert one.count() == 25


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_types_hold_for_late_rows(spark, tmp_path):
    from tillwise.sources import files

    lines = ["id,price", *(f"{i},{i}" for i in range(5000)), *(f"{i},1.5" for i in range(5000, 5010))]
    (tmp_path / "late.csv").write_text("\n".join(lines))
    frame = files.read_csv_inferred(spark, str(tmp_path / "late.csv"), {})
    assert dict(frame.dtypes)["price"] == "double"
    assert frame.where("price IS NULL").count() == 0 and frame.where("price = 1.5").count() == 10
