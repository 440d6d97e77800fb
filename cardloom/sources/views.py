"""Card-shaped views over the supplied star-schema tables.

No join is hinted: part, supplier and customer grow with the data, so Spark broadcasts them only while
they stay below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles them beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.session import remove_path, stage_path
from cardloom.sources.tables import spread, stage

TXN_ORDER = ["purchase_date", "o_orderkey", "l_linenumber", "l_partkey", "merchant_id", "purchase_amount"]
EVENT_ORDER = ["purchase_date", "event_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, stepwise: bool = False) -> DataFrame:
    """Order lines as card transactions; sentinels and missing codes are planted by the mapping.

    Orders come last: the joins before carry none of their columns, and where they shuffle, the lines of an order, hence of a card,
    leave together, so that sums by card combine before their own shuffle. ``stepwise`` writes the lines after each join and drops what
    it shuffled and read, so that the disk holds one join's rows at a time.
    """
    lineitem = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    paths: list[str] = []

    def step(df: DataFrame) -> DataFrame:
        if not stepwise:
            return df
        paths.append(stage_path(spark, "lines"))
        written = stage(df, "lines", paths[-1], freed=True)
        for path in paths[:-1]:
            remove_path(spark, path)
        del paths[:-1]
        return written

    lines = step(lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")))
    lines = step(lines.join(supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")), F.col("l_suppkey") == F.col("s_suppkey")))
    joined = step(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    return joined.select(
        F.col("o_custkey").alias("card_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("p_type").alias("merchant_category_id"),
        F.col("s_nationkey").alias("city_id"),
        F.col("n_regionkey").alias("state_id"),
        (F.col("p_size") % 10).alias("subsector_id"),
        F.col("o_orderdate").alias("purchase_date"),
        F.col("l_extendedprice").alias("purchase_amount"),
        F.when(line == 7, 999).when(line == 6, -1).otherwise(line).alias("installments"),
        F.when(flag == "R", "N").otherwise("Y").alias("authorized_flag"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("category_1"),
        F.nullif(F.substring("o_orderpriority", 1, 1).cast("double"), F.lit(5.0)).alias("category_2"),
        F.when(flag == "A", "A").when(flag == "N", "B").alias("category_3"),
        ((F.year("o_orderdate") - 2001) * 12 + F.month("o_orderdate") - 6).alias("month_lag"),
        "o_orderkey", "l_linenumber", "l_partkey")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as transactions with a time of day; the only view where hours and seconds vary."""
    return spread(table(spark, sf_dir, "events")).select(
        F.col("user_id").alias("card_id"),
        F.get_json_object("props", "$.k").alias("merchant_id"),
        F.col("event_type").alias("merchant_category_id"),
        F.col("ts").alias("purchase_date"),
        F.col("value").alias("purchase_amount"),
        "event_id")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cards; a customer without orders keeps a missing first month."""
    first = (table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("card_id"))
             .agg(F.trunc(F.min("o_orderdate"), "MM").alias("first_active_month")))
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("card_id"),
        (F.col("c_nationkey") % 5 + 1).alias("feature_1"),
        (F.col("c_nationkey") % 3 + 1).alias("feature_2"),
        (F.col("c_custkey") % 2).cast("int").alias("feature_3"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("target"),
        (F.col("c_acctbal") < 0).cast("int").alias("outlier"),
        (F.col("c_custkey") % 5 == 0).cast("int").alias("is_test"))
    return customer.join(first, "card_id", "left")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select(
        F.col("s_suppkey").alias("merchant_id"),
        F.when(F.col("s_acctbal") < 0, "Y").otherwise("N").alias("category_4"),
        F.col("s_nationkey").alias("merchant_group_id"),
        F.col("s_nationkey").alias("city_id"))


def monthly_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per card and calendar month, in long form."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("card_id"),
                     (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("year_month"))
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
                 .alias("old_purchase_amount_sum")))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", "lang"))
    return documents.join(table(spark, sf_dir, "labels"), "doc_id")
