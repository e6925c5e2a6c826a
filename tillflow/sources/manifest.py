"""The manifest of a feed: one row for each page that was landed, and what follows from them for a day.

It is written next to the snapshot, after it, so a day with a manifest has a whole snapshot. A page that was fetched
twice, one that came late, one that changed and one that never came each have one outcome:

* of pages with one cursor on one day the first counts, the others are repeats;
* a page that isn't in the stored manifest, or has another digest there, makes the day be built again;
* where a page is missing, or fewer rows came than were announced, the day is incomplete.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.operators.groups import lookup
from tillflow.options import GroupLimits
from tillflow.sources.pages import PER_STORE

#: A feed's pages of one day are numbered for each store, or all together.
DAY = ["_date", "_store_uid"]
MANIFEST = "_date string, _store_uid string, page bigint, cursor string, next_cursor string, rows bigint, announced bigint, digest string, repeat boolean"


def _tags(dataset: str) -> list[Column]:
    store = F.col("_store_uid") if dataset in PER_STORE else F.lit(None).cast("string")
    return [F.col("_date"), store.alias("_store_uid")]


def manifest(pages: DataFrame, dataset: str) -> DataFrame:
    """One row for each landed page; ``repeat`` marks all but the first with one cursor.

    Only page numbers and cursors are shuffled, not the pages.
    """
    seen = pages.select(
        *_tags(dataset),
        F.col("_page").alias("page"),
        "cursor",
        "next_cursor",
        F.coalesce(F.size("data"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.nullif("total", F.lit(0)), F.col("meta.total")).alias("announced"),
        F.md5(F.coalesce(F.to_json("data"), F.lit(""))).alias("digest"),
    )
    asked = Window.partitionBy(*DAY, "cursor")
    return seen.withColumn("repeat", F.col("cursor").isNotNull() & (F.col("page") > F.min("page").over(asked)))


def without_repeats(pages: DataFrame, found: DataFrame, dataset: str, limits: GroupLimits | None = None) -> DataFrame:
    """The pages that count."""
    repeats = found.where("repeat").select(*DAY, F.col("page").alias("_page"))
    if dataset not in PER_STORE:
        return lookup(pages, repeats.drop("_store_uid"), ["_date", "_page"], "left_anti", limits)
    return lookup(pages, repeats, [*DAY, "_page"], "left_anti", limits)


def day_report(found: DataFrame) -> DataFrame:
    """For each day and store: pages, repeats, rows landed and announced, missing pages, and whether it is complete.

    In a feed with page numbers, a number below the largest that did not come is a missing page. In a feed with cursors,
    a page that no other page leads to, but for the first one, comes after a missing page. A cursor at the end that
    nobody followed is no proof of a missing page, since an empty answer isn't landed; it is told in ``open_end``.
    """
    counted = found.where(~F.col("repeat"))
    led_to = counted.where(F.col("next_cursor").isNotNull()).select(*DAY, F.col("next_cursor").alias("cursor"), F.lit(True).alias("_led")).distinct()
    begun = Window.partitionBy(*DAY)
    asked = counted.withColumn("_first", F.min("page").over(begun))
    asked = lookup(asked, led_to, [*DAY, "cursor"], "left").withColumn("_led", F.coalesce("_led", F.lit(False)))
    followed = counted.where(F.col("cursor").isNotNull()).select(*DAY, F.col("cursor").alias("next_cursor"), F.lit(True).alias("_followed")).distinct()
    asked = lookup(asked, followed, [*DAY, "next_cursor"], "left")
    has_next = F.col("next_cursor").isNotNull() & ~F.col("next_cursor").eqNullSafe(F.col("cursor"))
    orphan = F.col("cursor").isNotNull() & ~F.col("_led") & (F.col("page") > F.col("_first"))
    by_cursor = F.max(F.col("cursor").isNotNull() | F.col("next_cursor").isNotNull())
    report = asked.groupBy(*DAY).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("rows").alias("landed"),
        F.max("announced").alias("announced"),
        F.when(by_cursor, F.count_if(orphan)).otherwise(F.max("page") - F.count_distinct("page")).cast("bigint").alias("missing"),
        F.count_if(has_next & F.col("_followed").isNull()).alias("open_end"),
    )
    repeats = found.where("repeat").groupBy(*DAY).agg(F.count(F.lit(1)).alias("repeats"))
    report = lookup(report, repeats, DAY, "left").withColumn("repeats", F.coalesce("repeats", F.lit(0).cast("bigint")))
    enough = F.col("announced").isNull() | (F.col("landed") >= F.col("announced"))
    return report.withColumn("complete", (F.col("missing") == 0) & enough)


def path_of(root: str, dataset: str) -> str:
    return f"{root}/manifest/{dataset}"


def read_manifest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The stored manifest; empty before the first ingest."""
    try:
        return spark.read.schema(MANIFEST).parquet(path_of(root, dataset))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def write_manifest(found: DataFrame, root: str, dataset: str) -> None:
    """Replace the manifests of the days that ``found`` holds."""
    found.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_date").parquet(path_of(root, dataset))


def changes(stored: DataFrame, found: DataFrame) -> DataFrame:
    """Pages that are ``late`` (not stored for a day that is), ``changed`` or ``gone``; days not stored at all are new.

    Returns ``_date, _store_uid, page, change``. ``stored`` may hold more days than ``found``; those are left alone.
    """
    days = found.select("_date").distinct()
    known = stored.join(days, "_date", "left_semi").select(*DAY, "page", F.col("digest").alias("_stored"))
    old_days = known.select("_date", F.lit(True).alias("_old")).distinct()
    now, then = found.select(*DAY, "page", "digest"), known
    same = (now["_date"] == then["_date"]) & now["_store_uid"].eqNullSafe(then["_store_uid"]) & (now["page"] == then["page"])
    both = now.join(then, same, "full").select(
        F.coalesce(now["_date"], then["_date"]).alias("_date"),
        F.coalesce(now["_store_uid"], then["_store_uid"]).alias("_store_uid"),
        F.coalesce(now["page"], then["page"]).alias("page"),
        "digest",
        "_stored",
    )
    both = both.join(old_days, "_date", "left")
    change = (
        F.when(F.col("digest").isNull(), "gone")
        .when(F.col("_old").isNull(), "new")
        .when(F.col("_stored").isNull(), "late")
        .when(F.col("digest") != F.col("_stored"), "changed")
    )
    return both.withColumn("change", change).where(F.col("change").isNotNull()).select(*DAY, "page", "change")
