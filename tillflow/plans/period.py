"""The report job: what is kept of each day, and the dashboard figures of a period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.plans import reports
from tillflow.sinks.history import from_sheet, publish, read_history
from tillflow.sources.business_day import read_business_day

#: What is kept of each day for the periods it lies in.
KEPT = ("close_minutes", "item_category")


def published(spark: SparkSession, out: str, table: str, first: dt.date, last: dt.date) -> DataFrame:
    return from_sheet(read_history(spark, f"{out}/{table}", first, last), table)


def keep_day(spark: SparkSession, snapshots: str, out: str, day: dt.date, opens_at_hour: int = 0) -> dict[str, int]:
    """Publish a day's counts of lines per category and minutes, and the categories of its items.

    They are as large as the menu, however many lines the day has, so a period reads no lines for them.
    """
    sales, customers = (published(spark, out, t, day, day) for t in ("sales_lines", "customer_invoice"))
    items = read_business_day(spark, snapshots, "invoice_line", day, opens_at_hour, ["item_name", "item_type_name"])
    items = items.select(F.col("item_name").alias("item"), F.col("item_type_name").alias("category"))
    items = items.where(F.col("category").isNotNull()).groupBy("item", "category").agg(F.count("*").alias("lines"))
    minutes = reports.close_counts(reports.minutes_to_close(sales, customers, items))
    return publish({"close_minutes": minutes, "item_category": items}, out, day, clean=False)


def period_figures(
    spark: SparkSession, out: str, first: dt.date, last: dt.date, upsell: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """All dashboard figures from the tables published for the days ``first`` to ``last``.

    ``upsell`` names the categories that count as sold on top.
    """
    day_tables = ("sales_lines", "customer_invoice", "staff_order", "daily_invoice")
    sales, customers, orders, daily = (published(spark, out, t, first, last) for t in day_tables)
    minutes, items = (read_history(spark, f"{out}/{t}", first, last) for t in KEPT)
    lines = reports.with_category(sales, items)
    return {
        "revenue_trend": reports.revenue_trend(daily),
        "peak_hours": reports.peak_hours(daily),
        "item_velocity": reports.item_velocity(sales),
        "guest_shares": reports.guest_shares(customers),
        "preferred_category": reports.preferred_category(lines),
        "staff_checkouts": reports.staff_checkouts(orders),
        "cancel_outliers": reports.cancel_outliers(orders),
        "price_overrides": reports.price_overrides(sales),
        "close_time": reports.close_summary(minutes),
        "upsell_rate": reports.upsell_rate(lines, F.coalesce(F.col("category").isin(*upsell), F.lit(False))),
    }
