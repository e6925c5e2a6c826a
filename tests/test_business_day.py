"""A business day that opens at 02:00, over the landed days around it."""

import datetime as dt

import pytest
from test_jobs import guest, invoice, land, line, log

from tillflow import jobs
from tillflow.options import Options
from tillflow.schemas import RECORDS
from tillflow.sources import business_day

DAY = dt.date(2024, 3, 1)
DAYS = [DAY + dt.timedelta(days=i) for i in range(-1, 3)]


def at(day, clock):
    """Epoch seconds of a clock time in the tests' session zone, and the same as text."""
    hour, minute = map(int, clock.split(":"))
    return dt.datetime(day.year, day.month, day.day, hour, minute)


def bill(spark, id_, day, clock):
    seconds = spark.sql(f"SELECT unix_seconds(TIMESTAMP '{at(day, clock)}')").first()[0]
    return invoice(id_, f"THU{id_}", "A1", 10.0, guest()) | {"created_at": seconds}


def entry(id_, day, clock):
    return log("00:00", id_, f"THU{id_}", "SALE_CHANGE", "An", [("Tea", 10.0, 1)]) | {"created_at": f"{at(day, clock):%d/%m/%Y %H:%M}"}


def removal(id_, updated_at):
    return {"tran_id": id_, "tran_no": None, "employee_name": "An", "table_name": "A1", "updated_at": updated_at, "sale_detail": "[]"}


@pytest.fixture(scope="module")
def snap(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("business"))
    before, day, after, later = DAYS
    bills = {
        before: [], later: [],
        # Night belongs to the day before; N has no time; 02:00 itself is the new day.
        day: [bill(spark, "A", day, "01:59"), bill(spark, "B", day, "02:00"), bill(spark, "N", day, "12:00") | {"created_at": None}],
        after: [bill(spark, "C", after, "01:30"), bill(spark, "D", after, "02:10")],
    }
    lines = {before: [], day: ["A", "B", "N", "lost"], after: ["C", "D", "C"], later: []}
    logs = {
        before: [("A", before, "23:00")],
        day: [("A", day, "01:00"), ("B", day, "01:30"), ("C", day, "23:50"), ("merged", day, "01:00"), ("merged", day, "05:00")],
        after: [("C", after, "01:20"), ("D", after, "01:50"), ("merged", after, "01:59"), ("merged", after, "02:00")],
        later: [("merged", later, "00:30"), ("A", later, "00:31")],
    }
    removals = {before: [], day: [("A", "nonsense"), ("gone", "nonsense"), ("gone", f"{at(day, '00:10'):%d/%m/%Y %H:%M}"), (None, None)], after: [("C", None)], later: []}
    for d in DAYS:
        land(f"{root}/landed", "invoice", bills[d], store="s1", day=d)
        land(f"{root}/landed", "invoice_line", [line(i, f"THU{i}", "A1", "s1", "Tea", 1, 10.0) for i in lines[d]], day=d)
        land(f"{root}/landed", "order_log", [entry(*e) for e in logs[d]], day=d)
        land(f"{root}/landed", "removed_item", [removal(*r) for r in removals[d]], store="s1", day=d)
        for dataset in RECORDS:
            jobs.ingest(spark, f"{root}/landed", f"{root}/snap", dataset, d, Options(day_opens_at_hour=2))
    return f"{root}/snap"


def ids(spark, snap, dataset, day):
    rows = business_day.read_business_day(spark, snap, dataset, day, 2).collect()
    return sorted(str(r["tran_id"]) for r in rows)


def test_rows_follow_their_invoice(spark, snap):
    assert ids(spark, snap, "invoice", DAY) == ["B", "C", "N"]
    assert ids(spark, snap, "invoice_line", DAY) == ["B", "C", "C", "N", "lost"]
    # B's log began before opening, C's went on after midnight; a bill without invoice goes by the time of its rows.
    assert ids(spark, snap, "order_log", DAY) == ["B", "C", "C", "merged", "merged"]
    assert ids(spark, snap, "removed_item", DAY) == ["C", "None", "gone"]
    assert ids(spark, snap, "order_log", DAYS[2]) == ["A", "D", "merged", "merged"]


def test_no_row_is_lost_or_read_twice(spark, snap):
    for dataset in RECORDS:
        landed = sorted(r["seq"] for r in spark.read.parquet(f"{snap}/{dataset}").collect())
        days = sorted({str(r["_date"]) for r in spark.read.parquet(f"{snap}/invoice").select("_date").collect()})
        assert days == [str(DAYS[1]), str(DAYS[2])]
        # Days without invoices are asked for through the reader's own rule, so they are given one here.
        found = []
        for day in DAYS:
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(business_day, "last_landed", lambda spark, root, d: d)
                found += [r["seq"] for r in business_day.read_business_day(spark, snap, dataset, day, 2).collect()]
        assert sorted(found) == landed


def test_only_days_around_are_read(spark, snap, capsys):
    business_day.read_business_day(spark, snap, "order_log", DAY, 2).explain()
    plan = capsys.readouterr().out
    assert plan.count("PartitionFilters: [cast(_date") + plan.count("PartitionFilters: [_date") == 2


def test_missing_next_day_is_told(spark, snap):
    assert business_day.not_landed(spark, snap, DAY, 0) == []
    assert business_day.not_landed(spark, snap, DAY, 2) == []
    assert business_day.not_landed(spark, snap, DAYS[2], 2) == ["invoice", "invoice_line", "removed_item"]
