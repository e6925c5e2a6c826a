"""Payload cells of the till: typed parsing and flattening."""

from __future__ import annotations

import ast
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schemas import columns

# Feeds send numbers as text, too; they are cast after parsing.
TOPPING = columns("item_name string, price string, quantity string, unit_id string")
ITEM = T.StructType(TOPPING.fields + [T.StructField("toppings", T.ArrayType(TOPPING))])
GUEST = columns(
    "peo_count int, customer_phone string, customer_name string, Membership_Type_Name string"
)
CHANGE_DATA = T.StructType(
    [
        *columns(
            "employee_name string, store_uid string, tran_id string, origin_tran_id string, tran_no string"
        ).fields,
        T.StructField("extra_data", columns("message_modify_table string")),
        T.StructField("sale_detail", T.ArrayType(ITEM)),
    ]
)
REMOVED = T.ArrayType(columns("item_name string, quantity string, unit_id string, note string"))


@F.pandas_udf(T.StringType())
def literal_to_json(cells: pd.Series) -> pd.Series:
    """Old snapshots hold Python literals; rewrite them as JSON, null if they are none."""

    def one(cell):
        try:
            return json.dumps(ast.literal_eval(cell), ensure_ascii=False)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    return cells.map(one, na_action="ignore")


def parse(cell: Column, schema: T.DataType, literal: bool = False) -> Column:
    """Typed payload, null where the cell does not parse."""
    return F.from_json(literal_to_json(cell) if literal else cell, schema)


def guest_fields(payload: Column, with_count: bool = False) -> dict[str, Column]:
    fields = {"phone": "customer_phone", "name": "customer_name", "tier": "Membership_Type_Name"}
    if with_count:
        fields = {"guests": "peo_count", **fields}
    return {out: payload[field] for out, field in fields.items()}


def order_lines(items: Column) -> Column:
    """Items and their toppings as one array: each item, then its toppings.

    A topping without a quantity takes that of its item.
    """

    def line(kind: str, x: Column, qty: Column, parent: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            x["item_name"].alias("item"),
            parent.alias("parent_item"),
            x["price"].try_cast("double").alias("price"),
            qty.alias("qty"),
            x["unit_id"].alias("unit"),
        )

    def qty_of(x: Column) -> Column:
        return x["quantity"].try_cast("double")

    def lines(i: Column) -> Column:
        main = F.array(line("MAIN", i, qty_of(i), F.lit(None).cast("string")))
        extra = F.transform(
            i["toppings"], lambda t: line("TOPPING", t, F.coalesce(qty_of(t), qty_of(i)), i["item_name"])
        )
        return F.when(i["toppings"].isNotNull(), F.concat(main, extra)).otherwise(main)

    return F.flatten(F.transform(items, lines))


def flatten_order_log(log: DataFrame, items: Column, keep: Sequence[str | Column]) -> DataFrame:
    """One row per ordered item or topping, numbered by ``line_no`` within its log row.

    Log rows without items, or whose payload did not parse, give no rows.
    """
    rows = log.select(*keep, F.posexplode(order_lines(items)).alias("line_no", "_line"))
    rows = rows.select("*", "_line.*").drop("_line")
    return rows.withColumn("revenue", F.col("price") * F.col("qty"))


def flatten_removed(log: DataFrame, items: Column, keep: Sequence[str | Column]) -> DataFrame:
    """One row per removed item; the removed quantity is turned positive.

    Rows with a positive or missing quantity are no removals and are dropped.
    """
    rows = log.select(*keep, F.explode(items).alias("_line"))
    rows = rows.select(
        *[c for c in rows.columns if c != "_line"],
        F.col("_line.item_name").alias("item"),
        F.col("_line.quantity").try_cast("double").alias("qty"),
        F.col("_line.unit_id").alias("unit"),
        F.col("_line.note").alias("reason"),
    )
    return rows.where(F.col("qty") <= 0).withColumn("qty", F.abs("qty"))
