"""Pages that repeat, come late, change or never come."""

import datetime as dt
import glob
import json
import os
import subprocess
import sys

import pytest
from test_jobs import DAY, guest, invoice, land, line, log

from tillflow import jobs
from tillflow.options import Options
from tillflow.sources import manifest, pages, snapshots


def ingest(spark, root, dataset, **more):
    return [r.asDict() for r in jobs.ingest(spark, f"{root}/landed", f"{root}/snap", dataset, DAY, Options(), **more).collect()]


def bill(n):
    return invoice(f"X{n}", f"THU{n:03d}", "A1", 10.0 * n, guest())


def ids(spark, root, dataset="invoice"):
    return sorted(r[0] for r in snapshots.read_snapshot(spark, f"{root}/snap", dataset, DAY, ["tran_id"]).collect())


def test_a_missing_page_is_told_and_fails_when_strict(spark, tmp_path):
    land(f"{tmp_path}/landed", "invoice", [bill(1), bill(2)], page=1, store="s1", total=5)
    land(f"{tmp_path}/landed", "invoice", [bill(5)], page=3, store="s1", meta={"total": 5})
    land(f"{tmp_path}/landed", "invoice", [bill(9)], store="s2", total=1)
    with pytest.raises(jobs.IncompleteDay):
        ingest(spark, tmp_path, "invoice", strict=True)
    assert not os.path.exists(f"{tmp_path}/snap")
    got = {r["_store_uid"]: r for r in ingest(spark, tmp_path, "invoice")}
    assert [(got[s]["landed"], got[s]["announced"], got[s]["missing"], got[s]["complete"]) for s in ("s1", "s2")] == [(3, 5, 1, False), (1, 1, 0, True)]
    assert ids(spark, tmp_path) == ["X1", "X2", "X5", "X9"]

    # The page comes late: the day is built again.
    land(f"{tmp_path}/landed", "invoice", [bill(3), bill(4)], page=2, store="s1", total=5)
    stored = manifest.read_manifest(spark, f"{tmp_path}/snap", "invoice")
    found = manifest.manifest(pages.read_pages(spark, f"{tmp_path}/landed", "invoice"), "invoice")
    assert [tuple(r) for r in manifest.changes(stored, found).collect()] == [(str(DAY), "s1", 2, "late")]
    assert all(r["complete"] for r in ingest(spark, tmp_path, "invoice", strict=True))
    assert ids(spark, tmp_path) == ["X1", "X2", "X3", "X4", "X5", "X9"]

    # The same pages again write nothing; a changed page does.
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{tmp_path}/snap") for f in names}
    ingest(spark, tmp_path, "invoice")
    assert before == {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{tmp_path}/snap") for f in names}
    land(f"{tmp_path}/landed", "invoice", [bill(7)], store="s2", total=1)
    ingest(spark, tmp_path, "invoice")
    assert ids(spark, tmp_path)[-1] == "X7"


def test_a_day_after_another_keeps_both(spark, tmp_path):
    land(f"{tmp_path}/landed", "invoice", [bill(1)], store="s1")
    ingest(spark, tmp_path, "invoice")
    later = DAY + dt.timedelta(days=1)
    land(f"{tmp_path}/landed", "invoice", [bill(2)], store="s1", day=later)
    jobs.ingest(spark, f"{tmp_path}/landed", f"{tmp_path}/snap", "invoice", later, Options())
    stored = manifest.read_manifest(spark, f"{tmp_path}/snap", "invoice")
    assert sorted((r["_date"], r["page"], r["rows"]) for r in stored.collect()) == [(str(DAY), 1, 1), (str(later), 1, 1)]
    assert ids(spark, tmp_path) == ["X1"]


@pytest.mark.parametrize(
    ("chain", "missing", "open_end", "repeats"),
    [
        ([("c0", "c1"), ("c1", "c2"), ("c2", None)], 0, 0, 0),
        ([("c0", "c1"), ("c1", "c2"), ("c1", "c2"), ("c2", "c2")], 0, 0, 1),
        ([(None, "c1"), ("c1", "c2")], 0, 1, 0),
        ([("c0", "c1"), ("c2", "c3"), ("c3", None)], 1, 1, 0),
        ([("c0", None)], 0, 0, 0),
    ],
)
def test_cursors(spark, tmp_path, chain, missing, open_end, repeats):
    for n, (cursor, after) in enumerate(chain, 1):
        land(f"{tmp_path}/landed", "invoice_line", [line(f"L{cursor}", "T", "A", "s1", "Tea", 1, 2.0)], page=n, cursor=cursor, next_cursor=after)
    (report,) = ingest(spark, tmp_path, "invoice_line")
    assert (report["missing"], report["open_end"], report["repeats"], report["complete"]) == (missing, open_end, repeats, missing == 0)
    assert len(ids(spark, tmp_path, "invoice_line")) == len(chain) - repeats


def test_numbers_sent_as_text(spark, tmp_path):
    sent = line("X", "T", "A", "s1", "Tea", 1, 2.0)
    rows = [sent | {"quantity": q, "price": p, "peo_count": c} for q, p, c in [("2", " 1.5 ", "3"), (2, 1.5, 3), ("2.0", "x", "3.0"), (None, "", None)]]
    land(f"{tmp_path}/landed", "invoice_line", rows)
    ingest(spark, tmp_path, "invoice_line")
    got = snapshots.read_snapshot(spark, f"{tmp_path}/snap", "invoice_line", DAY).orderBy("seq")
    assert [(r["quantity"], r["price"], r["peo_count"]) for r in got.collect()] == [(2.0, 1.5, 3), (2.0, 1.5, 3), (2.0, None, 3), (None, None, None)]


def test_pages_in_folders(spark, tmp_path):
    for n in (1, 2, 11):
        folder = tmp_path / "landed" / "order_log" / f"_date={DAY}" / f"_page={n}"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text(json.dumps({"data": [log("10:00", f"B{n}", "T", "SALE_CHANGE", "An", [])]}))
    (report,) = ingest(spark, tmp_path, "order_log")
    assert (report["pages"], report["missing"], report["complete"]) == (3, 8, False)
    assert [r[0] for r in snapshots.read_snapshot(spark, f"{tmp_path}/snap", "order_log", DAY).orderBy("seq").select("tran_id").collect()] == ["B1", "B2", "B11"]


@pytest.mark.parametrize("strict", [False, True])
def test_command_line_tells_an_incomplete_day(tmp_path, strict):
    root = str(tmp_path)
    land(f"{root}/landed", "invoice", [bill(1)], store="s1", total=2)
    for dataset in ("invoice_line", "order_log"):
        land(f"{root}/landed", dataset, [])
    land(f"{root}/landed", "removed_item", [], store="s1")
    settings = f"--master local[2] --conf spark.ui.enabled=false --conf spark.checkpoint.dir={root}/scratch pyspark-shell"
    args = ["--day", str(DAY), "--snapshots", f"{root}/snap", "--out", f"{root}/out", "--landed", f"{root}/landed", *["--strict"] * strict]
    done = subprocess.run(
        [sys.executable, "-m", "tillflow.jobs", "ingest", *args], env=os.environ | {"PYSPARK_SUBMIT_ARGS": settings},
        cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True, timeout=300,
    )
    told = json.loads(done.stdout.strip().splitlines()[-1])
    (logged,) = [json.loads(x) for d, _, names in os.walk(f"{root}/out/run_log") for n in names if n.endswith(".json") for x in open(f"{d}/{n}")]
    assert told["status"] == logged["status"] == ("error" if strict else "incomplete")
    assert "invoice" in told["message"] and (done.returncode != 0) == strict


def test_pages_of_a_bundle_are_numbered_by_themselves(spark, tmp_path):
    sent = [(str(DAY), store, n, json.dumps({"_page": n, "data": [bill(n)], "total": 3})) for store in ("s1", "s2") for n in (1, 3, 1500)]
    pages.write_bundles(spark.createDataFrame(sent, "_date string, _store_uid string, _page bigint, value string"), str(tmp_path), "invoice")
    got = pages.read_pages(spark, str(tmp_path), "invoice", bundled=True)
    assert sorted((r["_store_uid"], r["_page"], r["data"][0]["tran_id"]) for r in got.collect()) == [
        (store, n, f"X{n}") for store in ("s1", "s2") for n in (1, 3, 1500)
    ]
    report = manifest.day_report(manifest.manifest(got, "invoice")).collect()
    assert sorted((r["_store_uid"], r["pages"], r["missing"], r["complete"]) for r in report) == [(s, 3, 1497, False) for s in ("s1", "s2")]


@pytest.mark.parametrize("query", ["page_ingest", "page_records", "page_manifest"])
def test_the_files_of_a_feed_do_not_grow_with_its_pages(spark, tmp_path, query):
    from table_queries.queries import REGISTERED
    from tillflow.session import scratch_dir

    events = spark.range(4000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 08:00:00' + make_dt_interval(0, 0, cast(id % 60 as int)) as ts", "id % 7 as user_id",
        "'view' as event_type", "id / 4.0d as value", "'{}' as props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    before = set(glob.glob(f"{scratch_dir(spark)}/landed-*"))
    REGISTERED[query](spark, str(tmp_path)).collect()
    (landed,) = set(glob.glob(f"{scratch_dir(spark)}/landed-*")) - before
    # 4,000 rows are 200 pages of 20, or 102 of 40.
    assert 0 < sum(not f.startswith((".", "_")) for _, _, files in os.walk(landed) for f in files) <= 12
