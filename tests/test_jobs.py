"""The jobs end to end on landed pages of one hand-made day."""

import argparse
import datetime as dt
import json
import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillflow import jobs
from tillflow.options import Options
from tillflow.plans import kpi
from tillflow.schemas import HEADINGS, RECORDS
from tillflow.sinks import history
from tillflow.sources import pages, snapshots
from tillflow.streaming.ingest import ingest_new_pages

DAY = dt.date(2024, 3, 1)


def land(root, dataset, rows, page=1, store=None, day=DAY, **more):
    folder = f"{root}/{dataset}/_date={day}" + (f"/_store_uid={store}" if store else "")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/page-{page:04d}.json", "w", encoding="utf-8") as f:
        json.dump({"data": rows, **more}, f, ensure_ascii=False, indent=1)


def guest(phone=None, name=None, tier=None, count=2):
    return json.dumps(
        {"peo_count": count, "customer_phone": phone, "customer_name": name, "Membership_Type_Name": tier},
        ensure_ascii=False,
    )


def invoice(id_, number, table, total, payload, hours=(10, 0, 11, 30), origin=None, discount=0.0):
    at = int(dt.datetime(2024, 3, 1, 3, 0, tzinfo=dt.timezone.utc).timestamp())
    return {
        "tran_id": id_, "origin_tran_id": origin, "tran_no": number, "created_at": at, "start_hour": hours[0],
        "start_minute": hours[1], "end_hour": hours[2], "end_minute": hours[3], "table_name": table,
        "discount_extra_amount": discount, "amount_discount_detail": discount, "extra_data": payload,
        "total_amount": total,
    }


def line(id_, number, table, store, item, qty, price, guests=2, category="Drinks"):
    return {
        "tran_id": id_, "tran_no": number, "table_name": table, "store_uid": store, "peo_count": guests,
        "item_name": item, "item_type_name": category, "quantity": qty, "price": price, "unit_id": "cup",
        "amount_origin": qty * price, "store_name": "Thương",
    }


def log(time, id_, number, kind, employee, items, note=None):
    items = [
        {"item_name": i[0], "price": i[1], "quantity": i[2], "unit_id": "cup", **({"toppings": i[3]} if i[3:] else {})}
        for i in items
    ]
    return {
        "created_at": f"01/03/2024 {time}", "tran_id": id_, "log_type": kind, "table_name": "A1",
        "change_data": json.dumps(
            {
                "employee_name": employee, "store_uid": "s1", "tran_id": id_, "origin_tran_id": None,
                "tran_no": number, "extra_data": {"message_modify_table": note}, "sale_detail": items,
            },
            ensure_ascii=False,
        ),
    }


SPLIT_NOTE = "[Tách đơn] các món được tách và tạo thành hóa đơn C - bàn A2"
NEW_NOTE = "[Tách đơn] hóa đơn được tạo mới từ R"
MERGE_NOTE = "[Gộp đơn] hóa đơn bị hủy bởi vì gộp vào M2 - bàn A4"


def land_day(root):
    land(
        root, "invoice", store="s1", total=5,
        rows=[
            invoice("X", "THU010", "A1-Sân", 85.0, guest("", "", None)),
            invoice("R", "THU001", "A2-Nhà", 30.0, guest("0901", "Lan", "Gold"), (22, 50, 0, 10)),
            invoice("C", "THU002", "A3", 130.0, guest("0902", "Minh", "Thành viên mặc định")),
            invoice("M2", "THU004", "A4", 45.0, guest("0903", "Hoa", None), origin=None),
            invoice("N", "THU005", "A5", 1.0, "not json", origin="N0"),
        ],
    )
    land(
        root, "invoice_line", page=1, cursor="c0", next_cursor="c1",
        rows=[
            line("X", "THU010", "A1-Sân", "s1", "Coffee", 1, 30.0),
            line("X", "THU010", "A1-Sân", "s1", "Coffee", 1, 30.0),
            line("X", "THU010", "A1-Sân", "s1", "Không lấy Topping", 1, 0.0),
            line("X", "THU010", "A1-Sân", "s1", "Tea", 1, 25.0),
        ],
    )
    second = [
        line("R", "THU001", "A2-Nhà", "s1", "Coffee", 1, 30.0),
        line("C", "THU002", "A3", "s1", "Coffee", 1, 30.0),
        line("C", "THU002", "A3", "s1", "Tea", 2, 20.0),
        line("M2", "THU004", "A4", "s1", "Cake", 1, 45.0),
    ]
    land(root, "invoice_line", second, page=2, cursor="c1", next_cursor="c2")
    land(root, "invoice_line", second, page=3, cursor="c1", next_cursor="c2")
    land(
        root, "order_log",
        rows=[
            log("09:00", "X", "THU010", "SALE_CHANGE", "An", [("Coffee", 30.0, 2, [{"item_name": "Không lấy Topping", "price": 0.0}])]),
            log("09:05", "X", "THU010", "SALE_CHANGE", "An", [("Coffee", 30.0, 1), ("Coffee", 30.0, 1)]),
            log("09:06", "X", "THU010", "SALE_CHANGE", "An", [("Coffee", 30.0, -2)]),
            log("09:10", "X", "THU010", "SALE_CHANGE", "Bình", [("Tea", 25.0, 1)]),
            log("09:11", "X", "THU010", "SALE_PRINT", "Bình", [("Tea", 25.0, 9)]),
            {"created_at": "01/03/2024 09:12", "tran_id": "X", "log_type": "SALE_CHANGE", "table_name": "A1", "change_data": "{broken"},
            log("10:00", "R", "THU001", "SALE_CHANGE", "An", [("Coffee", 30.0, 3)]),
            log("10:01", "R", "THU001", "SALE_CHANGE", "An", [("Tea", 20.0, 2)]),
            log("10:02", "R", "THU001", "SALE_CHANGE", "An", [("Coffee", 30.0, -1)]),
            log("10:05", "R", "THU001", "SALE_SPLIT_ORDER", "An", [("Coffee", 30.0, 1)], SPLIT_NOTE),
            log("10:05", "C", "THU002", "SALE_SPLIT_ORDER", "An", [("Tea", 20.0, 2)], NEW_NOTE),
            log("11:00", "M1", "THU003", "SALE_CHANGE", "An", [("Cake", 45.0, 1)]),
            log("11:05", "M1", "THU003", "SALE_MERGE_ORDER", "An", [("Cake", 45.0, 1)], MERGE_NOTE),
            log("11:06", "M2", "THU004", "SALE_MERGE_ORDER", "An", [("Cake", 45.0, 1)], "nothing"),
        ],
    )
    land(
        root, "removed_item", store="s1", total=2,
        rows=[
            {
                "tran_id": "X", "tran_no": "THU010", "employee_name": "An", "table_name": "A1",
                "updated_at": "01/03/2024 09:06",
                "sale_detail": json.dumps([
                    {"item_name": "Coffee", "quantity": -2, "unit_id": "cup", "note": "đổi món"},
                    {"item_name": "Tea", "quantity": 1, "unit_id": "cup", "note": None},
                ]),
            },
            {
                "tran_id": "R", "tran_no": None, "employee_name": "An", "table_name": "A2",
                "updated_at": "nonsense", "sale_detail": json.dumps([{"item_name": "Coffee", "quantity": -1}]),
            },
        ],
    )


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("day")
    land_day(f"{root}/landed")
    reports = {
        d: jobs.ingest(spark, f"{root}/landed", f"{root}/snap", d, DAY, Options()).collect() for d in RECORDS
    }
    return root, reports


@pytest.fixture(scope="module")
def tables(spark, folders):
    return jobs.staff(spark, f"{folders[0]}/snap", DAY, Options())


def test_ingest_reports_and_repeated_cursor(spark, folders):
    root, reports = folders
    assert [(r["landed"], r["announced"], r["complete"]) for r in reports["invoice"]] == [(5, 5, True)]
    lines = snapshots.read_snapshot(spark, f"{root}/snap", "invoice_line", DAY)
    assert lines.count() == 8
    assert [r[0] for r in lines.orderBy("seq").select("tran_id").collect()] == list("XXXXRCC") + ["M2"]
    created = snapshots.read_snapshot(spark, f"{root}/snap", "invoice", DAY).select("created_at").first()[0]
    assert created == dt.datetime(2024, 3, 1, 10, 0)


def test_missing_day_reads_the_newest(spark, folders):
    root, _ = folders
    later = snapshots.read_snapshot(spark, f"{root}/snap", "invoice", dt.date(2024, 3, 9), ["tran_id"])
    assert later.columns == ["tran_id", "_date", "seq"] and later.count() == 5


def test_sales_lines(tables):
    got = sorted(
        (r["number"], r["item"], r["qty"], r["employee"], r["revenue"], r["phone"], r["customer_class"])
        for r in tables.sales_lines.collect()
    )
    assert got == [
        ("THU001", "Coffee", 1, "An", 90.0, "0901", "Khách quay lại"),
        ("THU002", "Coffee", 1, "An", 90.0, "0902", "Khách mới"),
        ("THU002", "Tea", 2, "An", 40.0, "0902", "Khách mới"),
        ("THU010", "Coffee", 2, "An", 60.0, "", "Khách lẻ"),
        ("THU010", "Tea", 1, "Bình", 25.0, "", "Khách lẻ"),
    ]
    assert tables.lines_without_number.count() == 0


def test_options_change_the_lines(spark, folders):
    options = Options(include_merge_only=True, reprice_after_netting=True)
    got = jobs.staff(spark, f"{folders[0]}/snap", DAY, options).sales_lines
    assert sorted((r["number"], r["item"], r["revenue"]) for r in got.collect()) == [
        ("THU001", "Coffee", 30.0),
        ("THU002", "Coffee", 30.0),
        ("THU002", "Tea", 40.0),
        ("THU004", "Cake", 45.0),
        ("THU010", "Coffee", 60.0),
        ("THU010", "Tea", 25.0),
    ]


def test_hot_groups_give_the_same_tables(spark, folders, tables, small_limits):
    limits = Options(limits=small_limits.__class__(**{**small_limits.__dict__, "max_rows": 1}))
    cut = jobs.staff(spark, f"{folders[0]}/snap", DAY, limits)
    for name in ("sales_lines", "staff_kpi", "customer_invoice"):
        key = lambda r: tuple(str(v) for v in r)
        assert sorted(map(key, getattr(cut, name).collect())) == sorted(map(key, getattr(tables, name).collect())), name


def test_cancellations(tables):
    got = [(r["number"], r["store"], r["qty"], r["week"]) for r in tables.cancellations.collect()]
    assert sorted(got, key=str) == [("THU010", "Thương", 2.0, "09-2024"), (None, "Ráng Chiều", 1.0, None)]


def test_staff_order_and_kpi(tables):
    orders = {(r["number"], r["employee"]): r for r in tables.staff_order.collect()}
    assert orders["THU010", "An"]["cancel_qty"] == 2.0 and orders["THU010", "An"]["cancel_count"] == 1
    assert orders["THU010", "Bình"]["cancel_qty"] == 0.0
    kpi = {r["employee"]: r for r in tables.staff_kpi.collect()}
    assert kpi["An"]["revenue"] == 280.0 and kpi["An"]["staff_invoices"] == 3 and kpi["An"]["guests"] == 6
    assert kpi["An"]["identified_rate"] == 0.33 and kpi["An"]["revenue_per_guest"] == 46.67
    assert kpi["Bình"]["store_day_revenue"] == 305.0 and kpi["Bình"]["store_day_invoices"] == 3


def test_customer_invoice(tables):
    got = {r["number"]: r for r in tables.customer_invoice.collect()}
    assert len(got) == 5
    assert got["THU001"]["date"] == dt.date(2024, 2, 29) and got["THU001"]["month"] == "03-2024"
    assert got["THU010"]["time"] == dt.datetime(2024, 3, 1, 11, 30)
    assert got["THU005"]["store"] == "Thương" and got["THU005"]["guests"] is None


def test_daily_report(spark, folders):
    stores = spark.createDataFrame([("s1", "THU")], "store_uid string, store string")
    got = {r["number"]: r for r in jobs.daily(spark, f"{folders[0]}/snap", stores, DAY).collect()}
    assert got["THU001"]["month_year"] == "2-2024" and got["THU001"]["hours_used"] == 1.33
    assert (got["THU010"]["table"], got["THU010"]["area"], got["THU010"]["store"]) == ("A1", "Sân", "THU")
    assert got["THU005"]["phone"] is None and got["THU005"]["guests"] is None


def test_publish_twice_keeps_one_copy(spark, folders, tables, tmp_path):
    out = str(tmp_path)
    for _ in range(2):
        rows = history.publish(tables.published(), out, DAY)
    history.publish({"staff_kpi": tables.staff_kpi}, out, DAY + dt.timedelta(days=1))
    assert rows == {"sales_lines": 5, "cancellations": 2, "staff_order": 4, "staff_kpi": 2, "customer_invoice": 5}
    kpi = history.read_history(spark, f"{out}/staff_kpi")
    assert kpi.count() == 4 and kpi.columns[:-1] == list(HEADINGS["staff_kpi"].values())
    day = spark.read.parquet(f"{out}/sales_lines/run_date={DAY}").collect()
    assert [(r["Số hoá đơn"], r["Món"]) for r in day] == sorted((r["Số hoá đơn"], r["Món"]) for r in day)
    revenue = [r[0] for r in spark.read.parquet(f"{out}/staff_kpi/run_date={DAY}").select("`Tổng giá trị order`").collect()]
    assert revenue == sorted(revenue, reverse=True)
    removed = history.read_history(spark, f"{out}/cancellations").where("`Ngày` is null").first()
    assert removed["Năm"] == 0 and removed["Tuần"] is None
    history.log_run(spark, out, "staff", DAY, rows)
    assert spark.read.json(f"{out}/run_log").select("status", "rows.staff_kpi").first() == ("success", 2)


def test_streaming_ingest(spark, tmp_path):
    root = str(tmp_path)

    def ingest():
        ingest_new_pages(spark, f"{root}/landed", f"{root}/snap", "order_log", f"{root}/progress").awaitTermination()
        return spark.read.parquet(f"{root}/snap/order_log").groupBy("_date").count().orderBy("_date").collect()

    tea = [log("09:00", "X", "T1", "SALE_CHANGE", "An", [("Tea", 1.0, 1)])]
    land(f"{root}/landed", "order_log", tea, cursor="a")
    assert [r["count"] for r in ingest()] == [1]
    assert [r["count"] for r in ingest()] == [1]
    land(f"{root}/landed", "order_log", tea, page=2, cursor="b")
    land(f"{root}/landed", "order_log", tea, page=3, cursor="a")
    land(f"{root}/landed", "order_log", tea * 3, day=DAY + dt.timedelta(days=1))
    assert [r["count"] for r in ingest()] == [2, 3]


def test_command_line(tmp_path):
    """Each job in a process of its own; afterwards no intermediate table is left."""
    root, scratch = str(tmp_path), tmp_path / "scratch"
    land_day(f"{root}/landed")
    os.makedirs(f"{root}/stores")
    pq.write_table(pa.table({"store_uid": ["s1"], "store": ["THU"]}), f"{root}/stores/stores.parquet")
    rows = {}
    for job in ("ingest", "staff", "daily"):
        args = ["--day", str(DAY), "--snapshots", f"{root}/snap", "--out", f"{root}/out", "--landed", f"{root}/landed"]
        settings = f"--master local[4] --conf spark.ui.enabled=false --conf spark.checkpoint.dir={scratch} pyspark-shell"
        done = subprocess.run(
            [sys.executable, "-m", "tillflow.jobs", job, *args, "--stores", f"{root}/stores"],
            env=os.environ | {"PYSPARK_SUBMIT_ARGS": settings}, cwd=os.path.dirname(os.path.dirname(__file__)),
            capture_output=True, text=True, timeout=300,
        )
        assert done.returncode == 0, done.stderr[-3000:]
        rows[job] = json.loads(done.stdout.strip().splitlines()[-1])["rows"]
    assert rows["ingest"] == {"invoice": 5, "invoice_line": 8, "order_log": 14, "removed_item": 2}
    assert rows["staff"] == {
        "sales_lines": 5, "cancellations": 2, "staff_order": 4, "staff_kpi": 2, "customer_invoice": 5,
        "lines_without_number": 0,
    }
    assert rows["daily"] == {"daily_invoice": 5}
    assert not list(scratch.glob("tillflow-*"))


def test_match_residuals_tell_the_rule(spark, folders, tables):
    got = {r["matched_by"]: r["lines"] for r in tables.match_residuals.collect()}
    assert sum(got.values()) == 5 and got["line"] >= 1 and "none" not in got


def test_own_rates_do_not_pair(spark):
    """An employee of two stores: four rows with paired rates, two without."""
    rows = [(DAY, s, f"{s}{i}", 2, c, "An", "09", 10.0, 0, 0.0) for s in "PQ" for i, c in enumerate(["Khách quay lại", "Khách lẻ"][: 2 if s == "P" else 1])]
    schema = "date date, store string, number string, guests int, customer_class string, employee string, phone string, revenue double, cancel_count long, cancel_qty double"
    orders = kpi.with_calendar(spark.createDataFrame(rows, schema))
    paired = kpi.staff_kpi(orders, ("Khách quay lại",)).collect()
    own = {r["store"]: r["identified_rate"] for r in kpi.staff_kpi(orders, ("Khách quay lại",), pair_rates=False).collect()}
    assert len(paired) == 4 and own == {"P": 1.0, "Q": 2.0}


def test_switches():
    parser = argparse.ArgumentParser()
    jobs.add_switches(parser)
    assert jobs.options_of(parser.parse_args([])) == Options()
    given = ["--include-merge-only", "--reprice-after-netting", "--keep-null-phone", "--no-pair-rates", "--zero-fill-text"]
    given += ["--day-opens-at-hour", "2", "--identified-classes", "a", "b", "--max-rows", "5"]
    assert jobs.options_of(parser.parse_args(given)) == Options(
        True, True, ("a", "b"), True, False, True, 2, Options().limits.__class__(5)
    )


def test_report(spark, folders, tables, tmp_path):
    """Two days published, then the figures of both; the second day's minutes are added to the first's."""
    out, snap, next_day = str(tmp_path), f"{folders[0]}/snap", DAY + dt.timedelta(days=1)
    stores = spark.createDataFrame([("s1", "THU")], "store_uid string, store string")
    for day in (DAY, next_day):
        history.publish(tables.published(), out, day)
        history.publish({"daily_invoice": jobs.daily(spark, snap, stores, day)}, out, day, clean=False)
    one = jobs.report(spark, snap, out, DAY, upsell=["Drinks"])
    assert set(one) == {
        "revenue_trend", "peak_hours", "item_velocity", "guest_shares", "preferred_category", "staff_checkouts",
        "cancel_outliers", "price_overrides", "close_time", "upsell_rate",
    }
    first = history.read_history(spark, f"{out}/reports/close_time", DAY, DAY).first()
    jobs.report(spark, snap, out, next_day, DAY, ["Drinks"])
    both = history.read_history(spark, f"{out}/reports/close_time", next_day, next_day).first()
    assert (first["category"], first["lines"]) == ("Drinks", 5) and both["lines"] == 10
    assert both["mean_minutes"] == first["mean_minutes"] and both["median_minutes"] == first["median_minutes"]
    checkouts = history.read_history(spark, f"{out}/reports/staff_checkouts", next_day, next_day).where("employee = 'An'").first()
    assert checkouts["revenue"] == 560.0 and checkouts["checkouts"] == 3
    upsell = history.read_history(spark, f"{out}/reports/upsell_rate", next_day, next_day)
    assert {r["employee"]: r["upsell_rate"] for r in upsell.collect()} == {"An": 1.0, "Bình": 1.0}


def test_run_day():
    assert snapshots.run_day("2024-03-05") == dt.date(2024, 3, 5)
    late = dt.datetime(2024, 3, 1, 17, 30, tzinfo=dt.timezone.utc)
    assert snapshots.run_day(now=late) == dt.date(2024, 3, 1)


def test_day_filter(spark):
    df = spark.sql("select explode(array('2024-03-01 00:00:00', '2024-03-01 23:59:59.9', '2024-03-02 01:00:00')) t")
    ts, day = F.col("t").cast("timestamp"), F.lit(DAY)
    assert df.where(snapshots.in_day(ts, day)).count() == 2
    assert df.where(snapshots.in_day(ts, day, 2)).count() == 2
