"""Retail tables derived from a folder of order, customer, part, event and text tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.operators import cleaning, features, marts, star
from tillwise.sources.streams import encode_messages

AS_OF = "2001-11-04"

# Yearly holidays and sale periods as (month, day) and (month, day, following years, month, day).
HOLIDAYS = [(1, 1), (5, 1), (12, 1)]
PERIODS = [(11, 20, 0, 12, 2), (12, 27, 1, 1, 15), (6, 25, 0, 7, 15), (7, 10, 0, 7, 20)]


class Tables:
    """Lazy frames over one folder; nothing is read before a query asks for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def sales(self) -> DataFrame:
        items, orders = self.raw("lineitem"), self.raw("orders")
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
            F.col("l_shipdate").cast("date").alias("t_dat"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").alias("article_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
            F.when(urgent, 1).otherwise(2).alias("sales_channel_id"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        return self.raw("customer").select(
            key.cast("string").alias("customer_id"),
            F.when(key % 83 != 0, (14 + (key * 7) % 90).cast("double")).alias("age"),
            F.when(key % 251 == 0, None)
            .when(F.col("c_mktsegment") == "MACHINERY", "PRE-CREATE")
            .when(key % 50 == 7, "LEFT CLUB")
            .otherwise("ACTIVE")
            .alias("club_member_status"),
            F.when(key % 97 == 0, None)
            .when(nation % 3 == 0, "Regularly")
            .when(nation == 1, "Monthly")
            .otherwise("NONE")
            .alias("fashion_news_frequency"),
            nation.cast("string").alias("postal_code"),
            F.when(F.col("c_acctbal") > 5000, "1").alias("FN"),
            F.when(F.col("c_acctbal") > 8000, "1").alias("Active"),
        )

    @cached_property
    def articles(self) -> DataFrame:
        words, size = F.split("p_name", " "), F.col("p_size")
        return self.raw("part").select(
            F.col("p_partkey").alias("article_id"),
            F.col("p_name").alias("prod_name"),
            F.col("p_type").alias("product_group_name"),
            F.get(words, 1).alias("product_type_name"),
            F.col("p_brand").alias("department_name"),
            F.get(words, 0).alias("colour_group_name"),
            F.when(size <= 15, "small").when(size <= 35, "medium").otherwise("large").alias("index_name"),
        )

    @cached_property
    def customers_clean(self) -> DataFrame:
        return cleaning.clean_customers(self.customers)

    @cached_property
    def named_sales(self) -> DataFrame:
        """Sales with the article group."""
        return self.sales.join(self.articles.select("article_id", "product_group_name"), "article_id", "left")

    @cached_property
    def features(self) -> DataFrame:
        return features.customer_features(self.named_sales, self.customers_clean, AS_OF)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.daily_sales(self.sales)

    @cached_property
    def segment_summary(self) -> DataFrame:
        return marts.segment_summary(self.features)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.customers_clean)

    @cached_property
    def dim_article(self) -> DataFrame:
        return star.dim_article(self.articles)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_transaction(self.sales)

    @cached_property
    def _years(self) -> DataFrame:
        return self.sales.select(F.year("t_dat").alias("y")).distinct()

    @cached_property
    def holidays(self) -> DataFrame:
        days = F.array(*[F.make_date(F.col("y"), F.lit(m), F.lit(d)) for m, d in HOLIDAYS])
        return self._years.select(F.explode(days).alias("date"))

    @cached_property
    def sale_periods(self) -> DataFrame:
        def day(year, month, dom):
            return F.make_date(year, F.lit(month), F.lit(dom))

        spans = [
            F.struct(
                day(F.col("y"), m1, d1).alias("period_start"), day(F.col("y") + later, m2, d2).alias("period_end")
            )
            for m1, d1, later, m2, d2 in PERIODS
        ]
        return self._years.select(F.inline(F.array(*spans)))

    @cached_property
    def weather(self) -> DataFrame:
        """One reading per sale day, except every 11th day of the year."""
        place = F.dayofyear("date")
        return (
            self.sales.select(F.col("t_dat").alias("date"))
            .distinct()
            .where(place % 11 != 0)
            .select(
                "date",
                (10 + 12.0 * (place % 30) / 30).alias("temp_mean"),
                ((place % 7) / 2).alias("precipitation"),
            )
        )

    @cached_property
    def raw_messages(self) -> DataFrame:
        """Sale messages from the events, some with a defect: key, value, timestamp."""
        number = F.col("event_id")
        price = (
            F.when(number % 17 == 0, None)
            .when(number % 19 == 0, 0.0)
            .when(number % 23 == 0, -1.0)
            .when(number % 41 == 0, float("nan"))
            .otherwise(F.col("value"))
        )
        unseen = F.when(number % 43 == 0, 1_000_000).otherwise(0)
        sales = self.raw("events").select(
            F.when(number % 37 == 0, "not-a-date")
            .otherwise(F.date_format("ts", "yyyy-MM-dd"))
            .alias("t_dat"),
            F.when(number % 29 != 0, (F.col("user_id") + unseen).cast("string")).alias("customer_id"),
            (number % 2000).alias("article_id"),
            price.cast("double").alias("price"),
            F.when(F.col("event_type") == "click", 1).otherwise(2).alias("sales_channel_id"),
            number.alias("_number"),
            F.col("ts").cast("timestamp").alias("timestamp"),
        )
        columns = ["t_dat", "customer_id", "article_id", "price", "sales_channel_id"]
        text = F.to_json(F.struct(*columns))
        whole = F.when(F.col("_number") % 31 == 0, F.left(text, F.length(text) - 9)).otherwise(text)
        return sales.select(
            F.col("customer_id").alias("key"), whole.cast("binary").alias("value"), "timestamp"
        )

    @cached_property
    def event_sales(self) -> DataFrame:
        """Well-formed sales from the events, before encoding."""
        return self.raw("events").select(
            F.date_format("ts", "yyyy-MM-dd").alias("t_dat"),
            F.col("user_id").cast("string").alias("customer_id"),
            (F.col("event_id") % 2000).alias("article_id"),
            F.col("value").alias("price"),
            F.when(F.col("event_type") == "click", 1).otherwise(2).alias("sales_channel_id"),
        )

    def encoded_sales(self) -> DataFrame:
        return encode_messages(self.event_sales)

    @cached_property
    def markdown(self) -> DataFrame:
        """Documents with a heading mark before every third line and a title line on top of
        every third document."""
        lines = F.split("text", "\n")
        marked = F.transform(
            lines, lambda line, i: F.when((i + 1) % 3 == 0, F.concat(F.lit("## "), line)).otherwise(line)
        )
        body = F.array_join(marked, "\n")
        return self.raw("documents").select(
            "doc_id",
            F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("# doc "), F.col("doc_id").cast("string"), F.lit("\n"), body))
            .otherwise(body)
            .alias("text"),
        )

    @cached_property
    def vectors(self) -> DataFrame:
        return self.raw("embeddings")

    @cached_property
    def query_vectors(self) -> DataFrame:
        """One query per label: the mean vector of its members."""
        parts = self.vectors.select("label", F.posexplode("embedding").alias("pos", "x"))
        means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
        ordered = F.array_sort(F.collect_list(F.struct("pos", "m"))).getField("m")
        return means.groupBy("label").agg(ordered.alias("embedding")).withColumnRenamed("label", "query_id")

    @cached_property
    def replies(self) -> DataFrame:
        """Model replies from the conversation turns: wrapped JSON, plain JSON or only text."""
        number = F.col("conv_id") * 8 + F.col("turn")
        tools = F.array(*[F.lit(t) for t in ("profile", "history", "search", "predict")])
        chosen = F.get(tools, (number % 4).cast("int"))
        call = F.concat(
            F.lit('{"tool": "'), chosen, F.lit('", "parameters": '), F.to_json(F.struct(F.col("text").alias("q"))), F.lit("}")
        )
        no_parameters = F.concat(F.lit('{"tool": "'), chosen, F.lit('"}'))
        reply = (
            F.when(number % 10 == 3, F.col("text"))
            .when(number % 10 == 4, no_parameters)
            .when(number % 10 == 5, F.concat(F.lit("```json\n"), call, F.lit("\n```")))
            .when(number % 10 == 6, F.concat(F.lit("Here you are: "), call, F.lit(" - done.")))
            .when(number % 10 == 7, F.concat(F.lit("```\nno data\n```\n```json"), call, F.lit("```")))
            .otherwise(call)
        )
        expected = F.when(number % 13 == 0, None).when(number % 7 == 0, "search").otherwise(chosen)
        return self.raw("conversations").select(
            F.element_at(F.array(F.lit("m-small"), F.lit("m-mid"), F.lit("m-large")), (F.col("conv_id") % 3 + 1).cast("int")).alias(
                "model_id"
            ),
            number.alias("query_id"),
            expected.alias("expected_tool"),
            reply.alias("reply"),
            (F.length("text") % 97 / 20.0).alias("ttft_s"),
            (2 + F.length("text") % 31 / 2.0).alias("tokens_per_s"),
        )
