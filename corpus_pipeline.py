"""From raw documents to token ids: the stages of the corpus pipeline, in order.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. A stage finds the ids of the
documents that go, writes these few to the shared folder, and takes them away from ``docs`` unchanged; so a stage that
drops little moves little, since Spark broadcasts the list if its size allows and joins by shuffle otherwise. A
document without an id can't be named and stays; rows that share an id are one document and go together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import decontaminate, language
from tillflow.llm.dedup import deduplicate
from tillflow.llm.jaccard import Join, near_classes
from tillflow.llm.pieces import PieceModel, encode
from tillflow.llm.queries import PIECE_MODEL, new_index, table
from tillflow.session import written

#: Near copies share four fifths of their five-word shingles.
NEAR = Join(n=5, percent=80)


def _without(docs: DataFrame, found: DataFrame, goes: Column) -> DataFrame:
    """Documents but for those of ``found`` for which ``goes`` holds."""
    gone = written(found.where(goes).select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, which are of no language. All documents with a language teach the model."""
    model = language.train(docs)
    # Without labels there is no language to tell, but there are letters.
    found = language.identify(docs, model if model.languages else language.any_language())
    return _without(docs, found, F.col("lang_pred") == "und")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of equal texts."""
    return _without(docs, deduplicate(docs, new_index(spark)), ~F.col("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that near copies link."""
    return _without(docs, near_classes(docs, NEAR), F.col("doc_id") != F.col("component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in passages of the benchmark."""
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found, decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``exact`` says that decoding them gives the text back."""
    found = encode(docs, PieceModel.load(PIECE_MODEL))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "exact", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", tokens),
]

#: Language scores, FM-index and token ids have no SQL; the tests compare with a version in plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; the result of each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
