"""Invoices with their lines and the class of the customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import scalars as s
from tillflow.operators import nested
from tillflow.operators.groups import lookup, null_safe_join
from tillflow.operators.ordered import occurrence_number
from tillflow.options import GroupLimits, Options
from tillflow.schemas import STAFF_INVOICE


def join_lines(invoices: DataFrame, lines: DataFrame, on: Sequence[str], limits: GroupLimits | None = None) -> DataFrame:
    """Every invoice with its lines; one row of nulls for an invoice without any.

    An invoice may have very many lines. So the lines lead the join, as only the leading
    side can be spread, and the invoices without lines are added.
    """
    out = [*invoices.columns, *[c for c in lines.columns if c not in on]]
    matched = lookup(lines, invoices, on, "inner", limits)
    without = null_safe_join(invoices, lines.select(*on).distinct(), on, "left_anti")
    return matched.select(*out).unionByName(without, allowMissingColumns=True)


def invoice_lines(
    invoices: DataFrame, lines: DataFrame, options: Options | None = None, literal_payload: bool = False
) -> DataFrame:
    """One row per invoice line with guest, class and occurrence number ``mark``.

    Both inputs need ``seq``, the place of the row in its feed.
    """
    options = options or Options()
    head = invoices.select(*STAFF_INVOICE, F.col("seq").alias("invoice_seq"))
    head = head.withColumn("_guest", nested.parse(F.col("extra_data"), nested.GUEST, literal_payload))
    head = head.withColumns(nested.guest_fields(F.col("_guest"))).select(
        s.invoice_id(F.col("origin_tran_id"), F.col("tran_id")).alias("id"),
        F.col("_store_uid").alias("store_uid"),
        F.col("table_name").alias("table"),
        F.col("tran_no").alias("number"),
        "created_at",
        s.clock_text(F.col("start_hour"), F.col("start_minute")).alias("time_in"),
        s.clock_text(F.col("end_hour"), F.col("end_minute")).alias("time_out"),
        "end_hour",
        "end_minute",
        F.col("discount_extra_amount").alias("discount"),
        F.col("total_amount").alias("total"),
        "phone",
        "name",
        "tier",
        "invoice_seq",
    )
    line = lines.select(
        F.col("tran_id").alias("id"),
        F.col("store_uid"),
        F.col("table_name").alias("table"),
        F.col("tran_no").alias("number"),
        F.col("peo_count").alias("guests"),
        F.col("item_name").alias("item"),
        F.col("item_type_name").alias("category"),
        F.col("quantity").alias("qty"),
        F.col("price").alias("line_price"),
        F.col("amount_origin").alias("line_amount"),
        F.col("store_name").alias("store"),
        F.col("seq").alias("line_seq"),
    )
    df = join_lines(head, line, ["id", "store_uid", "table", "number"], options.limits)
    df = df.where(~s.has_no_topping_mark(F.col("item")))
    df = df.withColumn("customer_class", s.customer_class(F.col("phone"), F.col("tier")))
    return occurrence_number(
        df,
        ["number", "item", "qty"],
        ["created_at", "invoice_seq", "line_seq"],
        limits=options.limits,
    )
