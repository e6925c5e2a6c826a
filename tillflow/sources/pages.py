"""Landed response pages of the till's reporting feeds.

One file per page: ``<root>/<dataset>/_date=2024-03-01[/_store_uid=...]/page-0001.json``; a job that lands pages may
give each a folder ``_page=1`` instead. Where a file for each page would be too many, pages are landed in bundles: JSON
lines, one page each, which names its number ``_page``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schemas import RECORDS, columns

# Feeds that are fetched once per store, so that the folder names the store.
PER_STORE = ("invoice", "removed_item")
TIME_COLUMNS = {"invoice": ("created_at",), "order_log": ("created_at",), "removed_item": ("updated_at",)}
FIRST_DAY = dt.date(2020, 1, 1)
#: Pages of a bundle that follow each other.
BUNDLE = 1024


def page_schema(dataset: str, bundled: bool = False) -> T.StructType:
    """A page of records. All is read as text: feeds send times as seconds or formatted, and numbers as text too."""
    fields = [
        T.StructField(f.name, T.StringType())
        for f in RECORDS[dataset].fields
        if not (f.name == "_store_uid" and dataset in PER_STORE)
    ]
    folders = ("_page bigint, " if bundled else "") + "_date string" + (", _store_uid string" if dataset in PER_STORE else "")
    return T.StructType(
        [
            T.StructField("data", T.ArrayType(T.StructType(fields))),
            T.StructField("meta", columns("total bigint")),
            *columns(f"total bigint, cursor string, next_cursor string, {folders}").fields,
        ]
    )


def _numbered(pages: DataFrame) -> DataFrame:
    if "_page" in pages.columns:
        return pages.withColumn("_page", F.col("_page").cast("bigint"))
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json", 1)
    unnumbered = F.raise_error(F.concat(F.lit("page file without a number: "), F.col("_metadata.file_name"))).cast("bigint")
    return pages.withColumn("_page", F.when(number == "", unnumbered).otherwise(number.try_cast("bigint")))


def write_bundles(pages: DataFrame, root: str, dataset: str) -> None:
    """Land pages of JSON text, ``value``, in bundles: a day's or store's pages in a few files, however many there are."""
    folders = ["_date", "_store_uid"] if dataset in PER_STORE else ["_date"]
    lines = pages.repartition(*folders, F.floor(F.col("_page") / BUNDLE)).select(*folders, "value")
    lines.write.partitionBy(*folders).text(f"{root}/{dataset}")


def read_pages(spark: SparkSession, root: str, dataset: str, bundled: bool = False) -> DataFrame:
    """All pages of a feed; every store and day folder is read in parallel."""
    folder = f"{root}/{dataset}"
    reader = spark.read.schema(page_schema(dataset, bundled)).option("multiLine", not bundled).option("basePath", folder)
    return _numbered(reader.json(folder))


def stream_pages(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    reader = spark.readStream.schema(page_schema(dataset)).option("multiLine", True)
    return _numbered(reader.json(f"{root}/{dataset}"))


def place_in_feed() -> Column:
    """Day, page and position packed into one number that sorts in feed order."""
    day = F.date_diff(F.col("_date").cast("date"), F.lit(FIRST_DAY)).cast("bigint")
    return F.shiftleft(F.shiftleft(day, 17) + F.col("_page"), 32) + F.col("_pos")


def event_time(c: Column) -> Column:
    """Epoch seconds or formatted text to a timestamp in the session's zone."""
    return F.coalesce(
        F.timestamp_seconds(c.try_cast("bigint")),
        F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm")),
        F.try_to_timestamp(c),
    )


def records(pages: DataFrame, dataset: str) -> DataFrame:
    """One row per record with its day, its store where the folder names one, and its place."""
    tags = ["_date"] + (["_store_uid"] if dataset in PER_STORE else [])
    df = pages.select(*tags, "_page", F.posexplode("data").alias("_pos", "_record"))
    return df.select(
        *tags,
        *[_typed(F.col(f"_record.{f.name}"), f, dataset).alias(f.name) for f in RECORDS[dataset].fields if f.name not in tags],
        place_in_feed().alias("seq"),
    )


def _typed(c: Column, field: T.StructField, dataset: str) -> Column:
    """Text of a record as the field's type; null where it doesn't parse."""
    if field.name in TIME_COLUMNS.get(dataset, ()):
        return event_time(c)
    if isinstance(field.dataType, T.NumericType):
        # By way of a double, as whole numbers come as "2.0" too.
        return c.try_cast("double").try_cast(field.dataType)
    return c
