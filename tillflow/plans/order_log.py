"""Order log to final order lines: who ordered what, once merges, splits and voids are settled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import options as o
from tillflow.functions import notes
from tillflow.functions import scalars as s
from tillflow.operators import chains, nested
from tillflow.operators.groups import lookup
from tillflow.operators.ordered import fill, last_value, net_latest_first, occurrence_number
from tillflow.operators.replay import replay_splits
from tillflow.options import Options
from tillflow.session import written

# A line's place in its own bill; with the columns before it, the order in which ties resolve.
PLACE = ["seq", "line_no"]
FAMILY_ORDER = ["time", "suffix", "number", "source_no"]
# Columns of the flat log that the steps up to the final lines read.
READ = ["seq", "time", "log_type", "id", "number", "note", "line_no", "item", "price", "qty"]


def flat_log(log: DataFrame, literal_payload: bool = False) -> DataFrame:
    """One row per item and topping of the relevant log rows.

    The type is a column of its own, so other rows are gone before any payload is parsed.
    """
    is_text = dict(log.dtypes)["created_at"] == "string"
    df = log.where(F.col("log_type").isin(*o.LOG_TYPES))
    df = df.withColumn("_data", nested.parse(F.col("change_data"), nested.CHANGE_DATA, literal_payload))
    return nested.flatten_order_log(
        df,
        F.col("_data.sale_detail"),
        [
            "seq",
            s.parse_time(F.col("created_at"), is_text).alias("time"),
            "log_type",
            F.col("table_name").alias("log_table"),
            F.col("_data.employee_name").alias("employee"),
            F.col("_data.store_uid").alias("log_store_uid"),
            F.col("_data.tran_id").alias("id"),
            F.col("_data.origin_tran_id").alias("origin_id"),
            F.col("_data.tran_no").alias("number"),
            F.col("_data.extra_data.message_modify_table").alias("note"),
        ],
    )


def changed_only(lines: DataFrame, number: str, log_type: str, options: Options) -> DataFrame:
    """Lines of the bills whose log has nothing but changes."""
    others = lines.where(F.col(log_type) != o.CHANGE).select(number).distinct()
    return lookup(lines, others, [number], "left_anti", options.limits)


def with_types(lines: DataFrame, number: str, log_type: str, types: list[str], options: Options) -> DataFrame:
    """Lines of the bills whose log has one of ``types``."""
    wanted = lines.where(F.col(log_type).isin(*types)).select(number).distinct()
    return lookup(lines, wanted, [number], "left_semi", options.limits)


def follow_merges(lines: DataFrame, options: Options) -> DataFrame:
    """Give the lines of merged bills the id and number of the bill they ended up on."""
    limits = options.limits
    order = ["time", *PLACE]
    seen = ["number", *order]
    df = with_types(lines, "number", "log_type", [o.MERGE, o.SPLIT], options)
    df = written(df.withColumn("target", notes.merged_into(F.col("note"))))
    named = df.where(F.col("target").isNotNull()).select(*seen, "target", F.lit(0).alias("_asks"))
    df = df.where(~notes.is_merge_note(F.col("note")))
    # The last row of a bill says where it went. It takes that from the rows that name a bill; no others are ordered.
    last = df.where(F.col("id").isNotNull()).groupBy("id").agg(last_value(F.struct(*seen, "target"), seen).alias("_last"))
    asking = last.select("id", "_last.*", F.lit(1).alias("_asks"))
    told = fill(asking.unionByName(named, allowMissingColumns=True), ["number"], [*order, "_asks"], ["target"], limits=limits)
    links = chains.latest_links(told, "id", "target", seen)
    df = chains.with_end(df, "id", links, "end", limits)
    numbers = chains.first_number(df, "id", "number", seen).withColumnsRenamed({"id": "end", "number": "_number"})
    df = lookup(df, numbers, ["end"], "left", limits)
    return df.withColumnsRenamed({"number": "source_no"}).select(
        *[c for c in df.columns if c not in ("id", "number", "target", "end", "_number")],
        "source_no",
        F.col("end").alias("id"),
        F.coalesce("_number", "source_no").alias("number"),
    )


def split_families(merged: DataFrame, options: Options) -> DataFrame:
    """Log rows of split bills with root, child id and child number, ready for the replay."""
    limits = options.limits
    before = ["time", "number", "source_no", *PLACE]
    is_split = F.coalesce(F.col("log_type") == o.SPLIT, F.lit(False))
    df = with_types(merged, "number", "log_type", [o.SPLIT], options)
    df = df.withColumn("child_id", notes.split_into(F.col("note")))
    # Split rows take a child id from the rows that name one; no others are ordered.
    concerned = is_split | F.col("child_id").isNotNull()
    named = fill(df.where(concerned), ["id"], before, ["child_id"], limits=limits)
    named = named.withColumn("child_id", F.when(is_split, F.col("child_id")))
    links = chains.latest_new_links(named, "child_id", "id", before)
    links = links.select("child_id", F.col("id").alias("parent_id"))
    df = written(chains.with_end(df.where(~concerned).unionByName(named), "id", links, "root", limits))
    numbers = chains.last_number(df, "id", "number", ["time", "root", "number", "source_no", *PLACE])
    numbers = numbers.withColumnsRenamed({"id": "child_id", "number": "child_no"})
    has_child = F.col("child_id").isNotNull()
    splits = written(lookup(df.where(has_child), numbers, ["child_id"], "left", limits, nulls_match=False))
    none = F.lit(None).cast("string")
    df = df.where(~has_child).withColumns({"child_id": none, "child_no": none}).unionByName(splits)
    df = df.withColumn("child_no", F.when(is_split, F.col("child_no")))
    df = df.where(~(is_split & F.col("child_no").isNull()) & ~notes.is_new_bill_note(F.col("note")))
    text = ["employee", "log_store_uid", "id", "number", "log_table", "note", "unit", "origin_id", "child_id", "child_no"]
    text = [c for c in text if c in df.columns]
    return df.withColumns(
        {
            "suffix": s.sort_suffix(F.col("child_id")),
            "qty": s.number_or_zero(F.col("qty")),
            "item": s.clean_text(F.trim("item")),
            **{c: s.clean_text(F.col(c)) for c in text},
        }
    )


def final_lines(
    log: DataFrame, options: Options | None = None, literal_payload: bool = False, drop: Sequence[str] = ()
) -> DataFrame:
    """The lines that were finally ordered, with calendar columns and occurrence ``mark``.

    Columns to ``drop`` are not carried along; what a step reads goes after the last step that does.
    """
    options = options or Options()
    limits = options.limits
    lines = written(flat_log(log, literal_payload).drop(*[c for c in drop if c not in READ]))
    merged = written(follow_merges(lines, options))
    replayed = replay_splits(split_families(merged, options), FAMILY_ORDER, limits).withColumn("branch", F.lit(1))

    plain = changed_only(lines, "number", "log_type", options).withColumn("source_no", F.col("number"))
    if options.include_merge_only:
        splits = merged.where(F.col("log_type") == o.SPLIT).select("number").distinct()
        merge_only = lookup(merged, splits, ["number"], "left_anti", limits).where(F.col("log_type") == o.CHANGE)
        plain = plain.unionByName(merge_only)
    plain = plain.withColumn("suffix", s.sort_suffix(F.lit(None).cast("string"))).withColumns(
        {"branch": F.lit(2), "at_end": F.lit(0), "line_at": F.struct(*FAMILY_ORDER, *PLACE)}
    )
    ties = ["time", "branch", "root", "at_end", "emit", "line_at"]
    df = replayed.unionByName(plain, allowMissingColumns=True).drop("suffix", "source_no")
    df = df.drop(*[c for c in drop if c not in (*ties, "price", "qty", "id", "item")])
    df = written(df.withColumns({"time": s.to_minute(F.col("time")), "qty": s.number_or_zero(F.col("qty"))}))
    # Within a bill's item the order is found once.
    unused = [c for c in drop if c in ties and c != "time"]
    df = net_latest_first(df, ["id", "item"], ties, "qty", limits, unused, "_place")
    if options.reprice_after_netting:
        df = df.withColumn("revenue", F.col("price") * F.col("qty"))
    df = occurrence_number(df, ["id", "item", "qty"], ["_place"], limits=limits, drop=["_place"])
    # Made at the end, as they follow from the time.
    return df.where(~s.has_no_topping_mark(F.col("item"))).withColumns(s.calendar(F.col("time")))


def cancellations(removed: DataFrame, literal_payload: bool = False) -> DataFrame:
    """One row per removed item."""
    is_text = dict(removed.dtypes)["updated_at"] == "string"
    df = nested.flatten_removed(
        removed,
        nested.parse(F.col("sale_detail"), nested.REMOVED, literal_payload),
        [
            s.parse_time(F.col("updated_at"), is_text).alias("time"),
            F.col("tran_no").alias("number"),
            F.col("employee_name").alias("employee"),
        ],
    )
    return df.withColumns(s.calendar(F.col("time")) | {"store": s.store_by_code_anywhere(F.col("number"))}).select(
        "date", "week", "month", "year", "store", "number", "employee", "item", "qty", "reason", "time"
    )
