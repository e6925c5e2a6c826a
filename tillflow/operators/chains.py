"""Following links between bills (merged into, split from) to the last one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.groups import lookup, order_key
from tillflow.operators.ordered import first_value, last_value
from tillflow.options import GroupLimits
from tillflow.session import written


def latest_links(df: DataFrame, src: str, dst: str, order: Sequence[str]) -> DataFrame:
    """One link per ``src``: the one on its last row; none if that row has no ``dst``."""
    links = df.where(F.col(src).isNotNull()).groupBy(src).agg(last_value(dst, order).alias(dst))
    return links.where(F.col(dst).isNotNull())


def latest_new_links(df: DataFrame, src: str, dst: str, order: Sequence[str]) -> DataFrame:
    """One link per ``src``: of its distinct targets, the one that turned up last."""
    pairs = df.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    seen = pairs.groupBy(src, dst).agg(F.min(order_key(order)).alias("_seen"))
    return seen.groupBy(src).agg(F.max_by(dst, "_seen").alias(dst))


def resolve(links: DataFrame, src: str, dst: str, limits: GroupLimits | None = None) -> DataFrame:
    """Follow links to the end: ``(src, dst)`` with ``dst`` the last id of the chain.

    ``links`` has one row per ``src``. Every round doubles the number of links a row has
    followed, so a chain of n links takes log2(n) rounds. Ids on a cycle, and ids that
    lead into one, resolve to the smallest id on the cycle.
    """
    open_rows = written(links.select(F.col(src).alias("id"), F.col(dst).alias("to"), F.col(dst).alias("low")))
    done, still_open, followed = None, None, 1
    while True:
        # A row is done once its target has no link of its own. It stays where it was
        # written; only the others join again.
        known = open_rows if done is None else open_rows.unionByName(done)
        step = known.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("low").alias("_low"))
        moved = written(
            lookup(open_rows, step, ["to"], "left", limits, nulls_match=False).select(
                "id",
                F.coalesce("_to", "to").alias("to"),
                F.least("low", "_low").alias("low"),
                F.col("_to").isNull().alias("ended"),
            )
        )
        ended, open_rows = (moved.where(c).drop("ended") for c in (F.col("ended"), ~F.col("ended")))
        done = ended if done is None else done.unionByName(ended)
        followed *= 2
        count = open_rows.count()
        # As long as a chain is unfinished, every round finishes some row. If none was, all
        # open rows are caught in cycles, and once as many links were followed as there are
        # open rows, ``to`` is on the cycle and its ``low`` has seen all of it.
        if count == 0 or (count == still_open and followed >= count):
            break
        still_open = count
    done = done.select("id", "to")
    if count:
        on_cycle = open_rows.select(F.col("id").alias("to"), F.col("low").alias("_smallest"))
        caught = lookup(open_rows.select("id", "to"), on_cycle, ["to"], "inner", limits, nulls_match=False)
        done = done.unionByName(caught.select("id", F.col("_smallest").alias("to")))
    return done.select(F.col("id").alias(src), F.col("to").alias(dst))


def with_end(df: DataFrame, id_col: str, links: DataFrame, out: str, limits: GroupLimits | None = None) -> DataFrame:
    """Add ``out``: the end of the chain that starts at ``id_col``, or the id itself."""
    src, dst = links.columns
    ends = resolve(links, src, dst, limits).select(F.col(src).alias(id_col), F.col(dst).alias("_end"))
    joined = lookup(df, ends, [id_col], "left", limits, nulls_match=False)
    return joined.withColumn(out, F.coalesce("_end", id_col)).drop("_end")


def first_number(df: DataFrame, id_col: str, number: str, order: Sequence[str]) -> DataFrame:
    """Per id the invoice number on its first row."""
    return df.groupBy(id_col).agg(first_value(number, order).alias(number))


def last_number(df: DataFrame, id_col: str, number: str, order: Sequence[str]) -> DataFrame:
    """Per id the invoice number on its last row."""
    return df.groupBy(id_col).agg(last_value(number, order).alias(number))
