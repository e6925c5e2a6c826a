"""Hand-worked cases of single rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillflow.functions import notes
from tillflow.functions import scalars as s
from tillflow.operators import nested
from tillflow.plans import kpi, reports
from tillflow.plans.daily import with_store
from tillflow.sinks.history import appended, zero_filled
from tillflow.sources.pages import event_time


def values(spark, schema, rows, **cols):
    out = spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in cols.items()]).collect()
    return [tuple(r) if len(r) > 1 else r[0] for r in out]


def test_customer_class(spark):
    rows = [
        (None, None), ("", ""), ("", None), ("0901", None), ("0901", ""), ("0901", "Thành viên mặc định"),
        ("0901", "Gold"), (None, "Gold"), (None, "Thành viên mặc định"),
    ]
    got = values(spark, "p string, t string", rows, c=s.customer_class(F.col("p"), F.col("t")))
    assert got == ["Khách lẻ"] * 3 + ["Khách mới"] * 3 + ["Khách quay lại"] * 3


def test_stay_hours(spark):
    rows = [(23, 30, 1, 15), (10, 0, 10, 0), (9, 5, 9, 25), (25, 0, 10, 0), (None, 0, 10, 0), (9, 0, 9, 61)]
    got = values(spark, "a int, b int, c int, d int", rows, h=s.stay_hours(*map(F.col, "abcd")))
    assert got == [1.75, 0.0, 0.33, None, None, None]


def test_clock_text(spark):
    rows = [(0, 5), (23, 59), (None, 1)]
    assert values(spark, "h int, m int", rows, t=s.clock_text(F.col("h"), F.col("m"))) == ["00:05", "23:59", None]


def test_business_date(spark):
    day = dt.date(2024, 3, 1)
    rows = [(day, 0), (day, 1), (day, None)]
    d = s.business_date(F.col("d"), F.col("h"))
    got = values(spark, "d date, h int", rows, d=d, m=s.month_label_short(d))
    assert got == [(dt.date(2024, 2, 29), "2-2024"), (day, "3-2024"), (day, "3-2024")]


def test_week_labels(spark):
    rows = [(dt.date(2024, 12, 30),), (dt.date(2021, 1, 3),), (dt.date(2024, 1, 8),), (None,)]
    got = values(spark, "d date", rows, w=s.week_label(F.col("d")), u=s.week_label_short(F.col("d")))
    assert [w for w, _ in got] == ["01-2025", "53-2020", "02-2024", None]
    assert [u for _, u in got][:3] == ["1-2025", "53-2020", "2-2024"]


def test_round_half_to_even_and_ratio(spark):
    rows = [(0.125, 1.0), (0.375, 1.0), (1.0, 0.0), (None, 2.0)]
    got = values(spark, "a double, b double", rows, r=s.round2(s.ratio(F.col("a"), F.col("b"))))
    assert got == [0.12, 0.38, 0.0, 0.0]


def test_numbers_from_text(spark):
    rows = [("1.9",), ("-2",), ("x",), (None,), ("",)]
    got = values(spark, "t string", rows, a=s.number_or_zero(F.col("t")), b=s.number_or_zero(F.col("t"), "int"))
    assert got == [(1.9, 1), (-2.0, -2), (0.0, 0), (0.0, 0), (0.0, 0)]


def test_stores(spark):
    rows = [("CVGTN1",), ("1TN",), ("THU1",), ("xRC",), (None,), ("?",)]
    got = values(spark, "n string", rows, s=s.store_by_code_anywhere(F.col("n")))
    assert got == ["Chạng Vạng Trần Não", "Trăng Non", "Thương", "Ráng Chiều", "Ráng Chiều", "Khác"]
    rows = [(None, "RC1"), (" ", "CHV1"), ("0", "TN1"), ("Quán", "RC1"), (None, "?")]
    got = values(spark, "s string, n string", rows, s=s.store_by_code_at_start(F.col("s"), F.col("n")))
    assert got == ["Ráng Chiều", "Chênh Vênh", "0", "Quán", None]
    stores = spark.createDataFrame([("u1", "RC")], "store_uid string, store string")
    df = with_store(spark.createDataFrame([("u1",), ("u2",), (None,)], "uid string"), stores, "uid")
    assert [r["store"] for r in df.orderBy("uid").collect()] == ["Chi nhánh là", "RC", "Chi nhánh là"]


def test_notes(spark):
    rows = [
        ("[Gộp đơn] hóa đơn bị hủy bởi vì gộp vào AB12 - bàn",), ("hóa đơn bị hủy bởi vì gộp vào AB12x",),
        ("hóa đơn bị hủy bởi vì gộp vào  a b  - c - d",), ("gộp vào AB12 -",), (None,),
    ]
    got = values(spark, "n string", rows, m=notes.merged_into(F.col("n")), t=notes.is_merge_note(F.col("n")))
    assert got == [("AB12", True), ("AB12", False), ("a b", False), (None, False), (None, False)]
    rows = [("[TÁCH ĐƠN] CÁC MÓN ĐƯỢC TÁCH VÀ TẠO THÀNH HÓA ĐƠN X1 - a",), ("[Tách đơn] Hóa đơn được tạo mới",)]
    got = values(spark, "n string", rows, m=notes.split_into(F.col("n")), t=notes.is_new_bill_note(F.col("n")))
    # The phrase is found in any case, the id only after the phrase as the till writes it.
    assert got == [(None, False), (None, True)]


def test_toppings_take_the_quantity_of_their_item(spark):
    cell = (
        '{"sale_detail": [{"item_name": "Coffee", "price": 30, "quantity": 2, "toppings": '
        '[{"item_name": "Pearl", "price": 5}, {"item_name": "Jelly", "price": 4, "quantity": 1}]}, {"item_name": "Tea"}]}'
    )
    df = spark.createDataFrame([(1, cell), (2, "no json"), (3, "{}"), (4, None)], "seq int, cell string")
    df = df.withColumn("d", nested.parse(F.col("cell"), nested.CHANGE_DATA))
    out = nested.flatten_order_log(df, F.col("d.sale_detail"), ["seq"]).orderBy("line_no").collect()
    assert [(r["kind"], r["item"], r["parent_item"], r["qty"], r["revenue"]) for r in out] == [
        ("MAIN", "Coffee", None, 2.0, 60.0),
        ("TOPPING", "Pearl", "Coffee", 2.0, 10.0),
        ("TOPPING", "Jelly", "Coffee", 1.0, 4.0),
        ("MAIN", "Tea", None, None, None),
    ]


def test_epoch_seconds_and_text_times(spark):
    rows = [("1709227800",), ("01/03/2024 00:30",), ("2024-03-01 00:30:00",), ("soon",), (None,)]
    got = values(spark, "t string", rows, t=F.date_format(event_time(F.col("t")), "yyyy-MM-dd HH:mm"))
    assert got == ["2024-03-01 00:30"] * 3 + [None] * 2


DAY = dt.date(2024, 3, 1)


def orders(spark, rows):
    """(store, number, class, employee, phone, revenue, guests) as sales lines."""
    df = spark.createDataFrame(
        rows, "store string, number string, customer_class string, employee string, phone string, revenue double, guests int"
    )
    sales = df.withColumns(s.calendar(F.lit(DAY)))
    schema = "date date, employee string, number string, store string, qty double"
    return sales, spark.createDataFrame([(DAY, "An", "N1", "S1", 2.0), (DAY, "An", "N1", "S1", 1.0)], schema)


FOUR = [
    ("S1", "N1", "Khách mới", "An", "1", 10.0, 2),
    ("S1", "N2", "Khách quay lại", "An", "2", 10.0, 2),
    ("S1", "N3", "Khách quay lại", "An", "3", 10.0, 2),
    ("S1", "N4", "Khách lẻ", "An", "", 10.0, 2),
]


@pytest.mark.parametrize("classes,rate", [(None, 0.5), (("Khách mới", "Khách quay lại"), 0.75)])
def test_identification_rate(spark, classes, rate):
    from tillflow.options import Options

    table = kpi.staff_order(*orders(spark, FOUR))
    row = kpi.staff_kpi(table, classes or Options().identified_classes).first()
    assert (row["identified_rate"], row["staff_invoices"], row["cancel_count"], row["cancel_qty"]) == (rate, 4, 2, 3.0)


def test_null_phone_leaves_the_staff_tables(spark):
    rows = [("S1", "N1", "Khách lẻ", "An", None, 10.0, 1), ("S1", "N2", "Khách lẻ", "An", "", 5.0, 1)]
    sales, cancelled = orders(spark, rows)
    assert [r["number"] for r in kpi.staff_order(sales, cancelled).collect()] == ["N2"]
    assert kpi.staff_order(sales, cancelled, keep_null_phone=True).count() == 2


def test_two_stores_on_a_day_give_four_rows(spark):
    rows = [("S1", "N1", "Khách quay lại", "An", "1", 10.0, 0), ("S2", "N2", "Khách lẻ", "An", "", 30.0, 0),
            ("S2", "N3", "Khách lẻ", "An", "", 30.0, 0)]
    got = kpi.staff_kpi(kpi.staff_order(*orders(spark, rows)), ("Khách quay lại",)).collect()
    assert sorted((r["store"], r["identified_rate"]) for r in got) == [("S1", 0.5), ("S1", 1.0), ("S2", 0.5), ("S2", 1.0)]
    assert {r["revenue_per_guest"] for r in got} == {0.0}
    assert {r["store_day_revenue"] for r in got if r["store"] == "S2"} == {60.0}


def test_append_and_zero_fill(spark):
    old = spark.createDataFrame([(1, "a", None), (None, None, None)], "n int, t string, x double")
    new = spark.createDataFrame([(2, float("inf"), DAY)], "n int, x double, d date")
    got = appended(old, new).orderBy("n").collect()
    assert [tuple(r) for r in got] == [(1, "a", 0.0, None), (2, None, 0.0, DAY)]
    raw = appended(old, new, clean=False).orderBy("n").collect()
    assert [r["x"] for r in raw] == [None, float("inf")]
    assert zero_filled(old, text_too=True).where("t = '0'").count() == 1


def test_minutes_to_close(spark):
    at = dt.datetime(2024, 3, 1, 10, 0)
    sales = spark.createDataFrame([("N1", "Tea", at), ("N1", "Cake", at), ("N2", "Tea", at)], "number string, item string, time timestamp")
    closed = spark.createDataFrame([("N1", at + dt.timedelta(minutes=90))], "number string, time timestamp")
    kinds = spark.createDataFrame([("Tea", "Drinks"), ("Tea", "Drinks"), ("Cake", "Food")], "item string, category string")
    got = reports.order_to_close(reports.minutes_to_close(sales, closed, kinds)).orderBy("category").collect()
    assert [tuple(r) for r in got] == [("Drinks", 1, 90.0, 90.0), ("Food", 1, 90.0, 90.0)]
