"""Daily snapshots: Parquet, one partition per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import PROVENANCE, RECORDS


def run_day(text: str | None = None, now: dt.datetime | None = None) -> dt.date:
    """The day given on the command line, else yesterday at UTC+7."""
    if text:
        return dt.date.fromisoformat(text)
    now = now or dt.datetime.now(dt.timezone.utc)
    return (now.astimezone(dt.timezone(dt.timedelta(hours=7))) - dt.timedelta(days=1)).date()


def in_day(ts: Column, day: Column, opens_at_hour: int = 0) -> Column:
    """The business day that starts on ``day`` at the opening hour, session time zone."""
    start = day.cast("timestamp_ntz") + F.make_interval(hours=F.lit(opens_at_hour))
    end = F.date_add(day, 1).cast("timestamp_ntz") + F.make_interval(hours=F.lit(opens_at_hour))
    return (ts >= start) & (ts < end)


def latest_day(df: DataFrame, day_col: str, day: str) -> Column:
    """``day`` if there is data for it, else the last day there is, as a scalar subquery."""
    asked = F.lit(day).cast(df.schema[day_col].dataType)
    found = df.agg(F.coalesce(F.max(F.when(F.col(day_col) == asked, asked)), F.max(day_col)).alias("d"))
    return found.scalar()


def read_snapshot(
    spark: SparkSession, root: str, dataset: str, day: dt.date, columns: Sequence[str] | None = None
) -> DataFrame:
    """The snapshot of ``day``, else the newest one. Only its partition and columns are read."""
    fields = RECORDS[dataset].fields
    df = spark.read.option("basePath", f"{root}/{dataset}").parquet(f"{root}/{dataset}")
    df = df.withColumn("_date", F.col("_date").cast("string"))
    wanted = day.isoformat()
    if df.where(F.col("_date") == wanted).isEmpty():
        wanted = df.agg(F.max("_date")).first()[0]
    if wanted is None:
        raise FileNotFoundError(f"no snapshot of {dataset} under {root}")
    keep = list(columns or [f.name for f in fields]) + [f.name for f in PROVENANCE.fields]
    return df.where(F.col("_date") == wanted).select(*keep)


def write_snapshot(df: DataFrame, root: str, dataset: str) -> None:
    """Replace the days that ``df`` holds; days without rows are left alone."""
    (
        df.hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_date")
        .parquet(f"{root}/{dataset}")
    )
