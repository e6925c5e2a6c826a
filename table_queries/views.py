"""The driver's tables in the roles of till data.

orders = invoice, lineitem with part = line, customer = guest, supplier = employee,
``o_custkey % 5`` = store, events = order log with (user, day) = bill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions import scalars as s
from tillflow.operators.groups import lookup
from tillflow.options import CHANGE, MERGE, SPLIT

# Every column of a line; no two lines agree in all of them.
LINE = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def billed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order."""
    line, order = (table(spark, sf_dir, n) for n in ("lineitem", "orders"))
    order = order.withColumn("l_orderkey", F.col("o_orderkey"))
    return lookup(line, order, ["l_orderkey"], "inner", nulls_match=False)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order and part."""
    line, part = billed_lines(spark, sf_dir), table(spark, sf_dir, "part")
    return lookup(line, part.withColumnRenamed("p_partkey", "l_partkey"), ["l_partkey"], "inner", nulls_match=False)


def phone(key: str):
    return F.when(F.col(key) % 7 == 0, None).when(F.col(key) % 7 == 1, "").otherwise(
        F.concat(F.lit("09"), F.col(key).cast("string"))
    )


def tier(key: str):
    return (
        F.when(F.col(key) % 4 == 0, None)
        .when(F.col(key) % 4 == 1, "")
        .when(F.col(key) % 4 == 2, "Thành viên mặc định")
        .otherwise("Gold")
    )


def sales(spark: SparkSession, sf_dir: str, items: bool = True) -> DataFrame:
    """Lines as final sales lines; without ``items`` the part table is not read."""
    df = lines(spark, sf_dir) if items else billed_lines(spark, sf_dir)
    return df.select(
        *[c.alias(n) for n, c in s.calendar(F.col("o_orderdate")).items()],
        F.concat(F.lit("S"), F.col("o_custkey") % 5).alias("store"),
        F.concat(F.lit("N"), F.col("l_orderkey")).alias("number"),
        (F.col("o_orderkey") % 4 + 1).cast("int").alias("guests"),
        s.customer_class(phone("o_custkey"), tier("o_custkey")).alias("customer_class"),
        F.concat(F.lit("E"), F.col("l_suppkey")).alias("employee"),
        phone("o_custkey").alias("phone"),
        *([F.col("p_name").alias("item"), F.col("p_type").alias("category")] if items else []),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("revenue"),
        F.col("l_returnflag").alias("flag"),
    )


def cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines as removed items."""
    return sales(spark, sf_dir, items=False).where(F.col("flag") == "R")


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log rows of a bill per user and day."""
    kinds = F.create_map(
        *[F.lit(v) for v in ("view", CHANGE, "click", MERGE, "signup", SPLIT, "purchase", "-", "error", "SALE_PRINT")]
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.concat_ws("/", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("number"),
        kinds[F.col("event_type")].alias("log_type"),
        "value",
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of stores: fixed size whatever the scale."""
    return table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("store_uid"), F.col("r_name").alias("store"))

