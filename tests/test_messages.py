"""Messages are decoded once, whatever is asked of their columns."""

from pyspark.sql import functions as F

from tillwise.operators.cleaning import split_valid
from tillwise.streaming.messages import parse_messages

GOOD = '{"t_dat": "2024-01-02", "customer_id": "7", "article_id": 3, "price": 2.5, "sales_channel_id": 1}'


def sent(spark, *texts):
    rows = [(None, None if t is None else bytearray(t, "utf-8")) for t in texts]
    return spark.createDataFrame(rows, "key STRING, value BINARY").withColumn("timestamp", F.lit("2024-01-02 03:04:05").cast("timestamp"))


def test_conditions_do_not_decode_again(spark):
    for part in split_valid(parse_messages(sent(spark, GOOD))):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_every_message_gives_one_row(spark):
    texts = [GOOD, GOOD[:-9], "no json", "", None, "[]", "null"]
    rows = parse_messages(sent(spark, *texts))
    assert rows.columns == ["t_dat", "customer_id", "article_id", "price", "sales_channel_id", "kafka_timestamp", "raw_value"]
    got = rows.collect()
    assert sorted(str(r.raw_value) for r in got) == sorted(map(str, texts))
    assert [r.raw_value for r in got if r.article_id is not None and r.sales_channel_id is not None] == [GOOD]
    valid, rejected = split_valid(rows)
    assert valid.count() == 1 and rejected.count() == len(texts) - 1
