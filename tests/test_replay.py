"""Split replay against a plain loop over one family at a time."""

import datetime as dt
import random

import pytest

from tillflow.operators.replay import replay_splits

SCHEMA = (
    "seq bigint, line_no int, root string, id string, number string, time timestamp, log_type string, "
    "item string, qty double, child_id string, child_no string, price double"
)
T0 = dt.datetime(2024, 3, 1, 10, 0)


def simulate(rows, in_order=False):
    """Model: walk one family in order with one list of [line, units] and pop from its end.

    ``in_order`` keeps the results in the order in which they arise.
    """
    out = []
    families = {}
    for r in rows:
        families.setdefault(r["root"], []).append(r)
    for root, log in sorted(families.items()):
        log.sort(key=lambda r: (r["time"], r["seq"], r["line_no"]))
        stock, done = [], set()
        named = [r["id"] for r in log if root in r["id"]]
        main = named[0] if named else log[0]["id"]

        def take(item, units, stock=stock):
            gone = []
            for entry in reversed(stock):
                if entry[0]["item"] == item and units > 0 and entry[1] > 0:
                    n = min(units, entry[1])
                    entry[1] -= n
                    units -= n
                    gone.append((entry[0], n))
            return gone

        for r in log:
            if r["log_type"] == "SALE_CHANGE":
                if r["id"] != main:
                    out.append((r["id"], r["number"], r["seq"], r["qty"]))
                elif r["qty"] > 0:
                    stock.append([r, r["qty"]])
                else:
                    take(r["item"], -r["qty"])
            elif r["log_type"] == "SALE_SPLIT_ORDER" and r["child_id"]:
                event = (r["time"], r["child_id"], r["child_no"])
                if event in done:
                    continue
                done.add(event)
                same = [x for x in log if x["log_type"] == "SALE_SPLIT_ORDER"
                        and (x["time"], x["child_id"], x["child_no"]) == event]
                gone = []
                for item in {e[0]["item"] for e in stock}:
                    stays = abs(sum(x["qty"] for x in same if x["item"] == item))
                    total = sum(e[1] for e in stock if e[0]["item"] == item)
                    gone += take(item, max(0, total - stays))
                place = [id(e[0]) for e in stock]
                for line, n in sorted(gone, key=lambda g: place.index(id(g[0]))):
                    out.append((r["child_id"], r["child_no"], line["seq"], n))
        out += [(e[0]["id"], e[0]["number"], e[0]["seq"], e[1]) for e in stock if e[1] > 0]
    return out if in_order else sorted(out)


def run(spark, rows, limits=None):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    got = replay_splits(df, ["time"], limits).select("id", "number", "seq", "qty").collect()
    return sorted(tuple(r) for r in got)


def row(seq, minute, root, id_, kind, item, qty, child=None):
    return dict(
        seq=seq, line_no=0, root=root, id=id_, number=f"no-{id_}", time=T0 + dt.timedelta(minutes=minute),
        log_type=kind, item=item, qty=float(qty), child_id=child, child_no=child and f"no-{child}", price=1.0,
    )


def random_log(seed, families, length, items):
    rng = random.Random(seed)
    rows = []
    for seq in range(families * length):
        root = f"R{rng.randrange(families)}x"
        what, item = rng.random(), f"item{rng.randrange(items)}"
        minute = seq // 3
        if what < 0.55:
            rows.append(row(seq, minute, root, root, "SALE_CHANGE", item, rng.randint(1, 5)))
        elif what < 0.75:
            rows.append(row(seq, minute, root, root, "SALE_CHANGE", item, -rng.randint(0, 6)))
        elif what < 0.8:
            rows.append(row(seq, minute, root, f"C{rng.randrange(3)}", "SALE_CHANGE", item, rng.randint(-2, 3)))
        elif what < 0.83:
            rows.append(row(seq, minute, root, root, "SALE_MERGE_ORDER", item, 2))
        else:
            child = f"C{rng.randrange(3)}" if rng.random() < 0.9 else None
            rows.append(row(seq, minute, root, root, "SALE_SPLIT_ORDER", item, rng.randint(-6, 9), child))
    return rows


def test_worked_case(spark):
    rows = [
        row(1, 0, "R", "R", "SALE_CHANGE", "Coffee", 3),
        row(2, 1, "R", "R", "SALE_CHANGE", "Tea", 2),
        row(3, 2, "R", "R", "SALE_CHANGE", "Coffee", -1),
        row(4, 5, "R", "R", "SALE_SPLIT_ORDER", "Coffee", 1, "C"),
    ]
    assert run(spark, rows) == [("C", "no-C", 1, 1.0), ("C", "no-C", 2, 2.0), ("R", "no-R", 1, 1.0)]


@pytest.mark.parametrize("seed", range(3))
def test_random_logs(spark, seed):
    rows = random_log(seed, 6, 40, 3)
    assert run(spark, rows) == simulate(rows)


@pytest.mark.parametrize("seed", range(4))
def test_one_family_cut_into_blocks(spark, small_limits, seed):
    rows = random_log(100 + seed, 2, 120, 2)
    assert run(spark, rows, small_limits) == simulate(rows)


def test_all_ordered_then_all_split(spark, small_limits):
    """Nothing matches inside a block: everything is left to the ranges of height."""
    rows = [row(i, i, "R", "R", "SALE_CHANGE", "Tea", 1 + i % 3) for i in range(60)]
    rows += [row(60 + i, 60 + i, "R", "R", "SALE_SPLIT_ORDER", "Tea", 118 - 2 * i, f"C{i}") for i in range(50)]
    assert run(spark, rows, small_limits) == simulate(rows)


def test_units_are_conserved(spark):
    rows = random_log(7, 3, 60, 2)
    got = run(spark, rows)
    ordered = sum(r["qty"] for r in rows if r["log_type"] == "SALE_CHANGE" and r["qty"] > 0 and r["id"] == r["root"])
    assert 0 < sum(q for i, _, s, q in got if rows[s]["id"] == rows[s]["root"]) <= ordered



def test_no_row_is_walked_in_python(spark):
    rows = random_log(3, 4, 60, 2)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    plan = replay_splits(df, ["time"])._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "FlatMapGroups" not in plan
