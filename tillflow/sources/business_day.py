"""Business days that open at another hour than midnight, read from snapshots of landed days.

Snapshots hold what was landed under a calendar day. A business day takes its rows from there and from the days around.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.groups import lookup
from tillflow.options import GroupLimits
from tillflow.schemas import PROVENANCE, RECORDS
from tillflow.sources.pages import event_time
from tillflow.sources.snapshots import read_snapshot

#: The column with the time of a row without an invoice.
OWN_TIME = {"order_log": "created_at", "removed_item": "updated_at"}


def business_day_of(ts: Column, opens_at_hour: int) -> Column:
    return F.to_date(ts - F.make_interval(hours=F.lit(opens_at_hour)))


def _landed(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return spark.read.option("basePath", f"{root}/{dataset}").parquet(f"{root}/{dataset}").withColumn("_date", F.col("_date").cast("string"))


def _around(df: DataFrame, day: dt.date, before: int, after: int) -> DataFrame:
    """The partitions of the days around ``day``; no others are read."""
    return df.where(F.col("_date").isin(*[str(day + dt.timedelta(days=i)) for i in range(-before, after + 1)]))


def _near(day: Column, landed: Column) -> Column:
    return F.abs(F.date_diff(day, landed)) <= 1


def last_landed(spark: SparkSession, root: str, day: dt.date) -> dt.date:
    """``day`` if its invoices were landed, else the newest day that was."""
    days = _landed(spark, root, "invoice").agg(F.max(F.when(F.col("_date") == str(day), F.col("_date"))), F.max("_date")).first()
    if days[1] is None:
        raise FileNotFoundError(f"no snapshot of invoice under {root}")
    return dt.date.fromisoformat(days[0] or days[1])


def read_business_day(
    spark: SparkSession,
    root: str,
    dataset: str,
    day: dt.date,
    opens_at_hour: int = 0,
    columns: Sequence[str] | None = None,
    limits: GroupLimits | None = None,
) -> DataFrame:
    """The rows of a feed that belong to the business day ``day``, else to the newest one.

    An invoice belongs to the day in which it was created. Lines, log rows and removals belong to the day of their
    invoice, by bill id, if it is that of their landed day or of a neighbour (the earliest, if there are several); else
    to the day of their own time, on the same condition; else to the day they were landed. So every row belongs to
    one business day, which is its landed day or a neighbour. An invoice without a time, or further off, belongs to its
    landed day. Bills that were merged away have no invoice: their log goes by its own time.
    """
    if not opens_at_hour:
        return read_snapshot(spark, root, dataset, day, columns)
    day = last_landed(spark, root, day)
    keep = list(columns or [f.name for f in RECORDS[dataset].fields]) + [f.name for f in PROVENANCE.fields]
    landed = F.col("_date").cast("date")
    rows = _around(_landed(spark, root, dataset), day, 1, 1)
    if dataset == "invoice":
        own = business_day_of(F.col("created_at"), opens_at_hour)
        return rows.where(F.coalesce(F.when(_near(own, landed), own), landed) == F.lit(day)).select(*keep)
    # Rows landed a day away may follow an invoice of another day away, which was landed up to a day away from it.
    invoices = _around(_landed(spark, root, "invoice"), day, 3, 3).select("tran_id", "origin_tran_id", "created_at", "_date")
    own = business_day_of(F.col("created_at"), opens_at_hour)
    invoices = invoices.withColumn("_day", F.coalesce(F.when(_near(own, landed), own), landed))
    bills = invoices.select(F.explode(F.array("tran_id", "origin_tran_id")).alias("tran_id"), "_day").where("tran_id IS NOT NULL")
    # At most nine days.
    bills = bills.groupBy("tran_id").agg(F.collect_set("_day").alias("_days"))
    rows = lookup(rows, bills, ["tran_id"], "left", limits, nulls_match=False)
    of_bill = F.array_min(F.filter("_days", lambda d: _near(d, landed)))
    choices = [of_bill, landed]
    if dataset in OWN_TIME:
        own = business_day_of(event_time(F.col(OWN_TIME[dataset])), opens_at_hour)
        choices.insert(1, F.when(_near(own, landed), own))
    return rows.where(F.coalesce(*choices) == F.lit(day)).select(*keep)


def not_landed(spark: SparkSession, root: str, day: dt.date, opens_at_hour: int) -> list[str]:
    """Feeds whose next day, into which a business day runs, was not landed."""
    if not opens_at_hour:
        return []
    following = last_landed(spark, root, day) + dt.timedelta(days=1)
    return [d for d in RECORDS if _around(_landed(spark, root, d), following, 0, 0).isEmpty()]
