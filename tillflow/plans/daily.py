"""Daily invoice report: one row per invoice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import options as o
from tillflow.functions import scalars as s
from tillflow.operators import nested
from tillflow.schemas import DAILY_INVOICE, HEADINGS


def with_store(invoices: DataFrame, stores: DataFrame, uid: str, default: str = o.UNKNOWN_STORE) -> DataFrame:
    """Add ``store`` from the table of stores ``(store_uid, store)``; unknown ids get ``default``.

    Spark broadcasts the table of stores when its size allows.
    """
    stores = stores.select(F.col("store_uid").alias(uid), "store")
    return invoices.join(stores, uid, "left").withColumn("store", F.coalesce("store", F.lit(default)))


def daily_columns(df: DataFrame) -> DataFrame:
    """Derive the report columns from clocks, day, table text and amounts."""
    clocks = [F.col(c) for c in ("start_hour", "start_minute", "end_hour", "end_minute")]
    day = s.business_date(F.col("created_at"), F.col("end_hour"))
    return df.withColumn("date", day).withColumns(
        {
            "month_year": s.month_label_short(F.col("date")),
            "week_year": s.week_label_short(F.col("date")),
            "hour_in": F.col("start_hour"),
            "hour_out": F.col("end_hour"),
            "time_in": s.clock_text(*clocks[:2]),
            "time_out": s.clock_text(*clocks[2:]),
            "table": s.table_of(F.col("table_name")),
            "area": s.area_of(F.col("table_name")),
            "hours_used": s.stay_hours(*clocks),
            "gross": F.col("net") + F.col("discount"),
        }
    )


def daily_report(invoices: DataFrame, stores: DataFrame, literal_payload: bool = False) -> DataFrame:
    df = invoices.select(*DAILY_INVOICE)
    df = df.withColumn("_guest", nested.parse(F.col("extra_data"), nested.GUEST, literal_payload))
    df = df.withColumns(nested.guest_fields(F.col("_guest"), with_count=True))
    df = df.withColumnsRenamed({"tran_no": "number", "total_amount": "net", "amount_discount_detail": "discount"})
    return with_store(daily_columns(df), stores, "_store_uid").select(*HEADINGS["daily_invoice"])


def invoices_per_store(report: DataFrame) -> DataFrame:
    return report.groupBy("store").agg(F.count("*").alias("invoices"))
