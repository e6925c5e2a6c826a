"""Exact deduplication against a persistent index of digests, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import written

#: The white space that does not tell texts apart.
BLANKS = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


class DigestIndex:
    """Digests of all texts seen so far: a Parquet table bucketed and sorted by digest.

    ``location`` keeps the table between sessions. A look-up is a sort-merge join whose index side is neither
    shuffled nor sorted again; only the new rows move.
    """

    def __init__(self, spark: SparkSession, name: str, location: str, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, keep_chars INT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, winners: DataFrame) -> None:
        """Add rows whose digests the index does not have yet."""
        (
            winners.select("digest", "keep_id", "keep_chars")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.name)
        )


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, the SHA-256 of the normalised text and the length of the original one, for every row."""
    text = F.col("text")
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(F.encode(normalized(text), "UTF-8"), 256)).alias("digest"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
    )


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Classes of equal texts, and which row of each stays; new texts enter the index.

    Texts are equal when identical without their white space; a null text is empty. Of equal texts that the index
    does not know, the row with the most characters stays, then the smallest ``doc_id`` (a null id last). If the
    index knows the text, the row it holds stays and all new ones go. Rows that repeat a ``doc_id`` are one document
    and stay or go together. Other columns are ignored. An empty table gives no rows and leaves the index as it is.

    Returns ``doc_id, keep_id, group_size, kept, digest``, one row per row of ``docs``; ``group_size`` counts the
    rows of ``docs``. Copies are counted where they are read, so a text with a third of all rows moves as one row
    per task; joining the classes back to the rows is left to the skew handling of adaptive execution, for which
    both sides are written tables.
    """
    rows = written(digests(docs))
    # The longest text first, then the smallest id: the greatest (chars, -id).
    groups = written(
        rows.groupBy("digest").agg(
            F.max(F.struct("chars", (-F.col("doc_id")).alias("minus_id"))).alias("best"),
            F.count(F.lit(1)).alias("group_size"),
        )
    ).select(
        "digest",
        (-F.col("best.minus_id")).alias("keep_id"),
        F.col("best.chars").alias("keep_chars"),
        "group_size",
    )
    known = index.read().select("digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("known"))
    classes = written(
        groups.join(known.hint("merge"), "digest", "left").select(
            "digest",
            F.when(F.col("known"), F.col("known_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            "keep_chars",
            "group_size",
        )
    )
    index.append(written(groups.join(index.read().hint("merge"), "digest", "left_anti")))
    return rows.join(classes.hint("merge"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )
