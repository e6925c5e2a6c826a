"""Figures for the sales, loyalty and staff dashboards, computed from the published tables.

All first aggregate to a small grain, which Spark does partly before the shuffle; windows
run over the aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions import scalars as s
from tillflow.operators.groups import lookup
from tillflow.options import NEW_GUEST, RETURNING_GUEST, GroupLimits


def revenue_trend(daily: DataFrame) -> DataFrame:
    """Net revenue, invoices and average order value per store and day."""
    df = daily.groupBy("store", "date").agg(s.money(F.sum("net")).alias("net"), F.count("*").alias("invoices"))
    return df.withColumn("order_value", s.round2(F.col("net") / F.col("invoices")))


def peak_hours(daily: DataFrame) -> DataFrame:
    """Invoices per store and hour of arrival, busiest hour first in rank."""
    df = daily.groupBy("store", "hour_in").agg(F.count("*").alias("invoices"))
    w = Window.partitionBy("store").orderBy(F.desc("invoices"))
    return df.withColumn("busy_rank", F.rank().over(w))


def item_velocity(sales: DataFrame, days: int = 7) -> DataFrame:
    """Units per store, item and day, and their mean per selling day of the last ``days`` days."""
    df = sales.groupBy("store", "item", "date").agg(F.sum("qty").alias("units"))
    w = Window.partitionBy("store", "item").orderBy(F.unix_date("date")).rangeBetween(1 - days, 0)
    return df.withColumn("mean_units", s.round2(F.sum("units").over(w) / F.count("units").over(w)))


def guest_shares(customers: DataFrame) -> DataFrame:
    """Share of new and returning guests per store and month."""

    def share(label: str) -> Column:
        return s.round2(F.count(F.when(F.col("customer_class") == label, 1)) / F.count("*"))

    return customers.groupBy("store", "month").agg(
        F.count("*").alias("invoices"),
        share(NEW_GUEST).alias("new_share"),
        share(RETURNING_GUEST).alias("returning_share"),
    )


def preferred_category(lines: DataFrame) -> DataFrame:
    """The category each customer class buys most units of; on a tie the first in the alphabet."""
    df = lines.groupBy("customer_class", "category").agg(F.sum("qty").alias("units"))
    best = F.min_by(F.struct("category", "units"), F.struct(-F.col("units"), F.col("category")))
    return df.groupBy("customer_class").agg(best.alias("b")).select("customer_class", "b.*")


def staff_checkouts(orders: DataFrame, period: str = "month") -> DataFrame:
    """Revenue and bills per employee and period."""
    return orders.groupBy("employee", period).agg(
        s.money(F.sum("revenue")).alias("revenue"), F.count_distinct("number").alias("checkouts")
    )


def cancel_outliers(orders: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Cancellations per order of each employee, against the other employees of the store."""
    df = orders.groupBy("store", "employee").agg(
        F.count("*").alias("orders"), F.sum("cancel_count").cast("bigint").alias("cancelled")
    )
    df = df.withColumn("cancel_rate", F.col("cancelled") / F.col("orders"))
    usual = df.groupBy("store").agg(F.avg("cancel_rate").alias("_mean"), F.stddev_pop("cancel_rate").alias("_sd"))
    df = df.join(usual, "store", "left")
    z = F.round(s.ratio(F.col("cancel_rate") - F.col("_mean"), F.col("_sd")), 4)
    df = df.withColumns({"cancel_rate": F.round("cancel_rate", 4), "z": z})
    return df.withColumn("outlier", F.col("z") > threshold).drop("_mean", "_sd")


def usual_price(lines: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """The price most often charged; on a tie the lowest."""
    counts = lines.where(F.col(price).isNotNull()).groupBy(*keys, price).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(price, F.struct(-F.col("_n"), F.col(price))).alias("usual_price"))


def price_overrides(
    lines: DataFrame, keys: Sequence[str] = ("store", "item"), price: str = "price", limits: GroupLimits | None = None
) -> DataFrame:
    """Lines that were charged another price than the usual one of their store and item."""
    df = lookup(lines, usual_price(lines, keys, price), list(keys), "inner", limits)
    return df.where(F.col(price) != F.col("usual_price"))


def close_counts(lines: DataFrame) -> DataFrame:
    """Lines per category and whole minutes from order to closing: of a day, what any period's figures need."""
    return lines.where(F.col("minutes").isNotNull()).groupBy("category", "minutes").agg(F.count("*").alias("lines"))


def close_summary(counts: DataFrame) -> DataFrame:
    """Mean and median minutes per category, from the counts of one or more days."""
    return counts.groupBy("category").agg(
        F.sum("lines").alias("lines"),
        F.round(F.sum(F.col("minutes") * F.col("lines")) / F.sum("lines"), 4).alias("mean_minutes"),
        F.expr("percentile(minutes, 0.5, lines)").alias("median_minutes"),
    )


def order_to_close(lines: DataFrame) -> DataFrame:
    """Minutes from order to closing per category: mean and median.

    Counting the lines per minute value first keeps the state of the exact median small.
    """
    return close_summary(close_counts(lines))


def with_category(lines: DataFrame, categories: DataFrame) -> DataFrame:
    """Lines with the category of their item, the first in the alphabet if it has several."""
    return lookup(lines, categories.groupBy("item").agg(F.min("category").alias("category")), ["item"], "left")


def minutes_to_close(sales: DataFrame, customers: DataFrame, categories: DataFrame) -> DataFrame:
    """Sales lines with category and minutes from order to closing, the input of ``order_to_close``."""
    df = lookup(sales, customers.select("number", F.col("time").alias("closed")), ["number"], "inner")
    df = with_category(df, categories)
    return df.withColumn("minutes", F.timestamp_diff("MINUTE", F.col("time"), F.col("closed")))


def upsell_rate(sales: DataFrame, is_upsell: Column) -> DataFrame:
    """Share of an employee's bills with at least one line for which ``is_upsell`` holds."""
    bills = sales.groupBy("employee", "number").agg(F.max(is_upsell.cast("int")).alias("_hit"))
    df = bills.groupBy("employee").agg(F.count("*").alias("bills"), F.sum("_hit").alias("upsold"))
    return df.withColumn("upsell_rate", s.round2(F.col("upsold") / F.col("bills")))
