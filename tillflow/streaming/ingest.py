"""Incremental ingest: bring snapshots up to date with newly landed pages, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.options import GroupLimits
from tillflow.session import written
from tillflow.sources import manifest, pages
from tillflow.sources.snapshots import write_snapshot


def ingest_new_pages(
    spark: SparkSession, landed: str, snapshots: str, dataset: str, progress: str, limits: GroupLimits | None = None
) -> StreamingQuery:
    """Rewrite the snapshot of every day that got new pages; ``progress`` remembers the pages seen.

    A day is always built from all its pages, by the rules of the batch ingest. So a page
    that was fetched twice, even days apart, does not count twice, and a batch that is run
    again after a failure gives the same snapshot.
    """

    def refresh(new: DataFrame, _batch: int) -> None:
        # As many values as calendar days were touched.
        days = [r["_date"] for r in new.select("_date").distinct().collect()]
        touched = written(pages.read_pages(spark, landed, dataset).where(F.col("_date").isin(days)))
        found = written(manifest.manifest(touched, dataset))
        write_snapshot(pages.records(manifest.without_repeats(touched, found, dataset, limits), dataset), snapshots, dataset)
        manifest.write_manifest(found, snapshots, dataset)

    return (
        pages.stream_pages(spark, landed, dataset)
        .select("_date")
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", f"{progress}/{dataset}")
        .trigger(availableNow=True)
        .start()
    )
