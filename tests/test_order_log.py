"""Order log to final lines, against a plain model over random logs."""

import datetime as dt
import json
import random
import re

import pytest
from test_replay import simulate

from tillflow.options import GroupLimits, Options
from tillflow.plans import order_log
from tillflow.plans.order_log import cancellations, final_lines

T0 = dt.datetime(2024, 2, 28, 22, 0)
MERGED = "[Gộp đơn] hóa đơn bị hủy bởi vì gộp vào {} - bàn 3"
MERGED_SOFT = "hóa đơn bị hủy bởi vì gộp vào {}"
SPLIT_OFF = "[Tách đơn] Các món được tách và tạo thành hóa đơn {} - bàn 4"
NEW = "[Tách đơn] hóa đơn được tạo mới"


def random_log(seed, bills=12, length=160):
    rng = random.Random(seed)
    rows = []
    for seq in range(length):
        bill = rng.randrange(bills)
        kind = bill % 4  # 0, 1: plain bills; 2: families that split; 3: bills that merge
        id_, number, note, type_ = f"B{bill:02d}", f"N{bill:02d}", None, "SALE_CHANGE"
        qty = rng.choice([1, 1, 2, 3, -1, -2])
        chance = rng.random()
        if kind == 2 and chance < 0.3:
            child = f"C{rng.randrange(2)}{bill:02d}"
            type_, note, qty = "SALE_SPLIT_ORDER", SPLIT_OFF.format(child), rng.randint(0, 3)
        elif kind == 2 and chance < 0.45:
            id_ = f"C{rng.randrange(2)}{bill:02d}"
            number = f"N{id_}"
            type_, note = ("SALE_SPLIT_ORDER", NEW) if rng.random() < 0.5 else ("SALE_CHANGE", None)
        elif kind == 3 and chance < 0.3:
            to = f"B{rng.choice([b for b in range(bills) if b < bill] or [0]):02d}"
            type_, note = "SALE_MERGE_ORDER", (MERGED if rng.random() < 0.4 else MERGED_SOFT).format(to)
        elif kind == 0 and chance < 0.1:
            type_ = "-"
        elif chance > 0.95:
            type_ = "SALE_PRINT"
        items = [(f"item{rng.randrange(2)}", qty)]
        if rng.random() < 0.2:
            items.append((rng.choice(["item9", "Không lấy Topping"]), 1))
        rows.append(
            dict(seq=seq, time=T0 + dt.timedelta(minutes=seq // 4), id=id_, number=number, type=type_, note=note, items=items)
        )
    return rows


def id_in(note, phrase):
    m = re.search(phrase + r"\s+(.+?)\s+-", note or "") or re.search(phrase + r"\s+([A-Z0-9]+)", note or "")
    return m.group(1).strip() if m else None


def nearest(values):
    """Own or earlier value, else a later one."""
    out, last = [], None
    for v in values:
        last = v or last
        out.append(last)
    first = next((v for v in values if v), None)
    return [v or first for v in out]


def end_of(links, x):
    path = []
    while links.get(x) and x not in path:
        path.append(x)
        x = links[x]
    return min(path[path.index(x):]) if x in path else x


def grouped(rows, key):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def model(log):
    flat = [
        dict(r, item=item, qty=float(qty), line_no=n)
        for r in log if r["type"] != "SALE_PRINT" for n, (item, qty) in enumerate(r["items"])
    ]
    types = {n: {r["type"] for r in rs} for n, rs in grouped(flat, "number").items()}

    # Merges.
    rows = [dict(r, old=r["number"]) for r in flat if types[r["number"]] & {"SALE_MERGE_ORDER", "SALE_SPLIT_ORDER"}]
    rows.sort(key=lambda r: (r["number"], r["time"], r["seq"], r["line_no"]))
    for rs in grouped(rows, "number").values():
        for r, to in zip(rs, nearest([id_in(r["note"], "hóa đơn bị hủy bởi vì gộp vào") for r in rs])):
            r["to"] = to
    rows = [r for r in rows if "[Gộp đơn]" not in (r["note"] or "")]
    links = {r["id"]: r["to"] for r in rows}
    numbers = {}
    for r in rows:
        numbers.setdefault(r["id"], r["number"])
    for r in rows:
        r["id"] = end_of(links, r["id"])
        r["number"] = numbers.get(r["id"], r["number"])

    # Splits.
    splitting = {r["number"] for r in rows if r["type"] == "SALE_SPLIT_ORDER"}
    rows = [r for r in rows if r["number"] in splitting]
    rows.sort(key=lambda r: (r["time"], r["number"], r["old"], r["seq"], r["line_no"]))
    for rs in grouped(rows, "id").values():
        found = [
            id_in(r["note"], "tạo thành hóa đơn") if "các món được tách" in (r["note"] or "").lower() else None for r in rs
        ]
        for r, child in zip(rs, nearest(found)):
            r["child_id"] = child if r["type"] == "SALE_SPLIT_ORDER" else None
    pairs = list(dict.fromkeys((r["child_id"], r["id"]) for r in rows if r["child_id"]))
    parents = dict(pairs)
    for r in rows:
        r["root"] = end_of(parents, r["id"])
    rows.sort(key=lambda r: (r["time"], r["root"]))
    known = {r["id"]: r["number"] for r in rows}
    for r in rows:
        r["child_no"] = known.get(r["child_id"]) if r["child_id"] else None
    rows = [r for r in rows if not (r["type"] == "SALE_SPLIT_ORDER" and not r["child_no"])]
    rows = [r for r in rows if "hóa đơn được tạo mới" not in (r["note"] or "").lower()]
    rows.sort(key=lambda r: (r["root"], r["time"], (r["child_id"] or "None")[-4:]))
    by_place = dict(enumerate(rows))
    replayed = simulate(
        [
            dict(root=r["root"], id=r["id"], number=r["number"], time=r["time"], log_type=r["type"], item=r["item"],
                 qty=r["qty"], child_id=r["child_id"], child_no=r["child_no"], seq=i, line_no=0)
            for i, r in by_place.items()
        ],
        in_order=True,
    )
    final = [dict(by_place[i], id=id_, number=number, qty=q) for id_, number, i, q in replayed]
    final += sorted(
        (r for r in flat if types[r["number"]] == {"SALE_CHANGE"}),
        key=lambda r: (r["number"], r["time"], r["seq"], r["line_no"]),
    )
    final.sort(key=lambda r: (r["id"], r["time"]))

    # Netting, latest first, and occurrence numbers.
    for rs in grouped([dict(r, key=(r["id"], r["item"]), at=i) for i, r in enumerate(final)], "key").values():
        owed = -sum(r["qty"] for r in rs if r["qty"] < 0)
        for r in reversed([r for r in rs if r["qty"] > 0]):
            used = min(owed, r["qty"])
            owed -= used
            final[r["at"]]["qty"] -= used
    final = sorted((r for r in final if r["qty"] > 0), key=lambda r: (r["id"], r["item"], r["time"]))
    seen, out = {}, []
    for r in final:
        key = (r["id"], r["item"], r["qty"])
        seen[key] = seen.get(key, 0) + 1
        if r["item"] != "Không lấy Topping":
            out.append((r["id"], r["number"], r["item"], r["qty"], r["seq"], r["line_no"], seen[key]))
    return sorted(out)


def landed(spark, log):
    rows = [
        (
            r["seq"], r["time"].strftime("%d/%m/%Y %H:%M"), r["type"], "T",
            json.dumps({
                "employee_name": "An", "tran_id": r["id"], "tran_no": r["number"],
                "extra_data": {"message_modify_table": r["note"]},
                "sale_detail": [{"item_name": i, "price": 10.0, "quantity": q} for i, q in r["items"]],
            }, ensure_ascii=False),
        )
        for r in log
    ]
    return spark.createDataFrame(rows, "seq bigint, created_at string, log_type string, table_name string, change_data string")


def run(spark, log, limits=None):
    out = final_lines(landed(spark, log), Options(limits=limits or GroupLimits()))
    return sorted(tuple(r) for r in out.select("id", "number", "item", "qty", "seq", "line_no", "mark").collect())


@pytest.mark.parametrize("seed", range(5))
def test_random_logs(spark, seed):
    log = random_log(seed)
    want = model(log)
    assert run(spark, log) == want and len(want) > 20


@pytest.mark.parametrize("seed", range(2))
def test_random_logs_with_cut_groups(spark, small_limits, seed):
    log = random_log(50 + seed, bills=8, length=200)
    assert run(spark, log, small_limits) == model(log)


def test_only_rows_that_tell_or_ask_are_ordered_for_links(spark, monkeypatch):
    change = lambda i, bill, type_="SALE_CHANGE", note=None: dict(
        seq=i, time=T0 + dt.timedelta(minutes=i), id=bill, number=f"N{bill}", type=type_, note=note, items=[("tea", 1)]
    )
    log = [change(i, "B1") for i in range(40)] + [change(40, "B1", "SALE_MERGE_ORDER", MERGED.format("B2"))]
    log += [change(50 + i, "B2") for i in range(40)] + [change(100, "B2", "SALE_SPLIT_ORDER", SPLIT_OFF.format("C2"))]
    log += [change(101, "C2", "SALE_SPLIT_ORDER", NEW)]
    ordered, real = [], order_log.fill
    monkeypatch.setattr(order_log, "fill", lambda df, *args, **kwargs: ordered.append(df.count()) or real(df, *args, **kwargs))
    assert run(spark, log) == model(log)
    assert len(ordered) == 2 and max(ordered) < 10


@pytest.mark.parametrize("seed", range(2))
def test_columns_that_are_not_asked_for(spark, seed):
    log = landed(spark, random_log(20 + seed))
    unused = ["log_table", "origin_id", "note", "line_no", "kind", "revenue", "root", "at_end", "emit", "line_at"]
    whole, some = final_lines(log), final_lines(log, drop=unused)
    assert sorted(some.columns) == sorted(set(whole.columns) - set(unused))
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(some.columns).collect()))


def test_python_literal_payload(spark):
    cell = "{'tran_id': 'X', 'tran_no': 'N', 'extra_data': {'message_modify_table': None}, " \
           "'sale_detail': [{'item_name': \"O'Tea\", 'price': 2, 'quantity': 3, 'toppings': None}]}"
    rows = [(1, "01/03/2024 10:00", "SALE_CHANGE", "T", c) for c in (cell, "{'broken", None, "[]")]
    log = spark.createDataFrame(rows, "seq bigint, created_at string, log_type string, table_name string, change_data string")
    got = final_lines(log, literal_payload=True).select("item", "qty", "revenue", "date").collect()
    assert [tuple(r) for r in got] == [("O'Tea", 3.0, 6.0, dt.date(2024, 3, 1))]


def test_empty_log(spark):
    log = landed(spark, random_log(1)).where("seq < 0")
    assert final_lines(log).count() == 0


def test_removed_items_that_are_no_list(spark):
    cells = ['[{"item_name": "Tea", "quantity": -2}]', '{"item_name": "Tea"}', "text", None, "[]", '[{"item_name": "x"}]']
    rows = [(f"THU{i}", "An", "01/03/2024 10:00", c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, "tran_no string, employee_name string, updated_at string, sale_detail string")
    got = cancellations(df).select("number", "item", "qty", "week").collect()
    assert [tuple(r) for r in got] == [("THU0", "Tea", 2.0, "09-2024")]
