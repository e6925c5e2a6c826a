"""Ordered operators against plain loops, with and without cutting of hot groups."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillflow.operators import chains, groups, ordered, scan
from tillflow.options import GroupLimits
from tillflow.session import written

WHOLE = GroupLimits()


@pytest.fixture(params=["whole", "cut"])
def limits(request, small_limits):
    return WHOLE if request.param == "whole" else small_limits


def table(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((key, rng.randrange(40), seq, float(rng.randint(-4, 6)), rng.choice([None, None, "x", "y", "z"])))
    return rows, spark.createDataFrame(rows, "k string, t int, seq int, q double, v string")


def by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def test_hot_group_lies_in_several_partitions(spark):
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is far too small for a task each
    try:
        parts = scan.in_order(df, ["k"], ["id"]).select("k", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["p"] for r in parts if r["k"] == "hot"}) >= 2 and max(Counter(r["p"] for r in parts).values()) < 15_000
    marks = scan.scan(df, ["k"], ["id"], [scan.Count("mark")])
    assert marks.where("k = 'hot' and mark <> id / 3 + 1").count() == 0 and marks.where("k <> 'hot' and mark <> 1").count() == 0


def test_blocks_keep_all_rows_in_order(spark):
    batches = [pa.RecordBatch.from_pydict({"x": list(range(a, b))}) for a, b in [(0, 3), (3, 3), (3, 4), (4, 25), (25, 26)]]

    class Context:
        def get(self):
            return self

        def partitionId(self):
            return 2

    for most in (1, 4, 7, 26, 100):
        found = list(scan.blocks(iter(batches), most, Context()))
        assert [x for _, t in found for x in t.column("x").to_pylist()] == list(range(26))
        assert [n for n, _ in found] == [(2 << 32) + i for i in range(len(found))]
        assert all(len(t) == most for _, t in found[:-1]) and 0 < len(found[-1][1]) <= most


def test_wide_rows_make_blocks_of_fewer(monkeypatch):
    monkeypatch.setattr(scan, "BLOCK_BYTES", 2_000)
    batches = [pa.RecordBatch.from_pydict({"x": list(range(a, a + 5)), "wide": ["w" * 100] * 5}) for a in range(0, 100, 5)]

    class Context:
        get = classmethod(lambda cls: cls)
        partitionId = classmethod(lambda cls: 1)

    found = list(scan.blocks(iter(batches), 1_000_000, Context))
    assert [x for _, t in found for x in t.column("x").to_pylist()] == list(range(100))
    assert [n for n, _ in found] == [(1 << 32) + i for i in range(len(found))] and len(found) >= 5
    assert all(t.nbytes <= 2_000 + batches[0].nbytes for _, t in found)
    groups = list(scan.whole_groups(iter(batches), ["x"], 1_000_000))
    assert [x for t in groups for x in t.column("x").to_pylist()] == list(range(100)) and len(groups) >= 4
    # A group that is larger than a block stays whole.
    assert [len(t) for t in scan.whole_groups(iter(batches), ["wide"], 10)] == [100]


def test_a_scan_over_blocks_cut_by_bytes(spark, monkeypatch):
    rows, df = table(spark, 5)
    wanted = [scan.Count("n"), scan.Sum("q", "after", later=True), scan.Fill("v", "v")]
    whole = sorted(map(str, scan.scan(df, ["k"], ["seq"], wanted).collect()))

    def cut(batches, most, real=scan.blocks):
        return real((b.slice(i, 2) for b in batches for i in range(0, len(b), 2)), 3)

    monkeypatch.setattr(scan, "blocks", cut)
    assert sorted(map(str, scan.scan(df, ["k"], ["seq"], wanted).collect())) == whole


def test_columns_that_only_order_rows_are_not_written(spark, monkeypatch):
    rows, df = table(spark, 4)
    wrote = []
    monkeypatch.setattr(scan, "written", lambda d: wrote.append(d.columns) or written(d))
    wanted = [scan.Count("n"), scan.Fill("v", "v")]
    got = scan.scan(df, ["k"], ["seq"], wanted, drop=["seq", "q"])
    assert not {"seq", "q", "v"} & set(wrote[0]) and not {"seq", "q"} & set(got.columns)
    kept = scan.scan(df, ["k"], ["seq"], wanted).drop("seq", "q")
    assert got.columns == kept.columns and sorted(map(str, got.collect())) == sorted(map(str, kept.collect()))


def test_netted_rows_keep_their_place_without_what_ordered_them(spark, limits, monkeypatch):
    rows, df = table(spark, 6)
    wrote = []
    monkeypatch.setattr(scan, "written", lambda d: wrote.append(d.columns) or written(d))
    got = ordered.net_latest_first(df, ["k"], ["t", "seq"], "q", limits, ["t"], "place")
    assert not {"t", "_lost"} & set(wrote[0]) and "t" not in got.columns
    whole = {r["seq"]: (r["q"], r["t"]) for r in ordered.net_latest_first(df, ["k"], ["t", "seq"], "q", limits).collect()}
    found = got.collect()
    assert {r["seq"]: r["q"] for r in found} == {seq: q for seq, (q, _) in whole.items()}
    by_place = sorted(found, key=lambda r: (str(r["k"]), r["place"]))
    assert [r["seq"] for r in by_place] == [r["seq"] for r in sorted(found, key=lambda r: (str(r["k"]), whole[r["seq"]][1], r["seq"]))]


def test_scans_of_one_call_share_one_write(spark, limits, monkeypatch):
    rows, df = table(spark, 3)
    writes = []
    monkeypatch.setattr(scan, "written", lambda d: writes.append(1) or written(d))
    df = df.withColumns({"even": F.col("seq") % 2 == 0, "pair": F.when(F.col("v").isNotNull(), F.struct("v", "seq"))})
    wanted = [
        scan.Count("n"), scan.Count("evens", "even"), scan.Sum("q", "after", later=True), scan.Sum("q", "total"),
        scan.Fill("pair", "pair"), scan.Fill("v", "next", forward=False), scan.Fill("v", "last", backward=False),
        scan.Fill("v", "other_next", forward=False, own=False), scan.Fill("v", "other_last", backward=False, own=False), scan.First("pair", "first"),
    ]
    got = {r["seq"]: r for r in scan.scan(df, ["k"], ["t", "seq"], wanted, limits).collect()}
    assert len(writes) == 1 and len(got) == len(rows)
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            x, known = got[r[2]], [g for g in group if g[4]]
            before, after = [g for g in group[: i + 1] if g[4]], [g for g in group[i:] if g[4]]
            assert (x["n"], x["evens"]) == (i + 1, sum(g[2] % 2 == 0 for g in group[: i + 1]))
            assert (x["after"], x["total"]) == (sum(g[3] for g in group[i + 1 :]), sum(g[3] for g in group))
            assert (x["next"], x["last"]) == (after[0][4] if after else None, before[-1][4] if before else None)
            others = [g for g in group[i + 1 :] if g[4]], [g for g in group[:i] if g[4]]
            assert (x["other_next"], x["other_last"]) == (others[0][0][4] if others[0] else None, others[1][-1][4] if others[1] else None)
            assert (tuple(x["first"]) if x["first"] else None) == (known[0][4], known[0][2]) if known else x["first"] is None
            near = before[-1] if before else after[0] if after else None
            assert (tuple(x["pair"]) if x["pair"] else None) == (near and (near[4], near[2]))


def test_keys_of_any_type(spark, limits):
    nan, zero = float("nan"), -0.0
    rows = [(k, d, i) for i, (k, d) in enumerate([(nan, b"a"), (nan, b"a"), (0.0, None), (zero, None), (None, b"a"), (None, b"a"), (1.5, b"b")] * 3)]
    df = spark.createDataFrame(rows, "k double, d binary, i int")
    got = scan.scan(df, ["k", "d"], ["i"], [scan.Count("n")], limits).groupBy("k", "d").agg(F.max("n").alias("n"), F.count("*").alias("c"))
    assert sorted((str(r["k"]), r["n"], r["c"]) for r in got.collect()) == [("0.0", 6, 6), ("1.5", 3, 3), ("None", 6, 6), ("nan", 6, 6)]


def test_scan_of_nothing(spark, limits):
    df = spark.createDataFrame([], "k string, i int")
    assert scan.scan(df, ["k"], ["i"], [scan.Count("n"), scan.Fill("i", "i")], limits).collect() == []


def test_many_edges_are_joined_without_broadcast(spark, monkeypatch):
    rows, df = table(spark, 4)
    want = sorted(map(str, scan.scan(df, ["k"], ["t", "seq"], [scan.Fill("v", "v")], GroupLimits(4)).collect()))
    monkeypatch.setattr(scan, "BROADCAST_EDGES", 1)
    got = scan.scan(df, ["k"], ["t", "seq"], [scan.Fill("v", "v")], GroupLimits(4))
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, got.collect())) == want


def test_occurrence_number(spark, limits):
    rows, df = table(spark)
    got = {r["seq"]: r["mark"] for r in ordered.occurrence_number(df, ["k"], ["t", "seq"], limits=limits).collect()}
    for key, group in by_key(rows).items():
        for n, r in enumerate(group, 1):
            assert got[r[2]] == (n if key else 0)
    assert len(got) == len(rows)


@pytest.mark.parametrize("forward,backward", [(True, True), (False, True), (True, False)])
def test_fill(spark, limits, forward, backward):
    rows, df = table(spark)
    out = ordered.fill(df, ["k"], ["t", "seq"], ["v"], forward, backward, limits)
    got = {r["seq"]: r["v"] for r in out.collect()}
    for key, group in by_key(rows).items():
        values = [r[4] for r in group]
        for i, r in enumerate(group):
            before = [v for v in values[: i + 1] if v] if forward else []
            after = [v for v in values[i:] if v] if backward else []
            want = before[-1] if before else after[0] if after else None
            assert got[r[2]] == (want if key else None), r


def test_fill_of_an_empty_group(spark, limits):
    df = spark.createDataFrame([("a", i, None) for i in range(20)], "k string, seq int, v string")
    assert ordered.fill(df, ["k"], ["seq"], ["v"], limits=limits).where("v is not null").count() == 0


def net_loop(group):
    keep = [[r, r[3]] for r in group if r[3] > 0]
    for r in group:
        owed = max(0.0, -r[3])
        for entry in reversed(keep):
            n = min(owed, entry[1])
            entry[1] -= n
            owed -= n
    return {r[2]: q for r, q in keep if q > 0}


@pytest.mark.parametrize("seed", range(3))
def test_net_latest_first(spark, limits, seed):
    rows, df = table(spark, seed, 400)
    got = {r["seq"]: r["q"] for r in ordered.net_latest_first(df, ["k"], ["t", "seq"], "q", limits).collect()}
    want = {}
    for key, group in by_key(rows).items():
        want |= net_loop(group) if key else {r[2]: r[3] for r in group if r[3] > 0}
    assert got == want


def test_net_worked_cases(spark):
    def net(*rows):
        df = spark.createDataFrame([("X", t, float(q)) for t, q in rows], "k string, t int, q double")
        return [tuple(r) for r in ordered.net_latest_first(df, ["k"], ["t"], "q").select("t", "q").collect()]

    assert net((1000, 2), (1010, 3), (1020, -4)) == [(1000, 1.0)]
    assert net((1000, 2), (1010, 3), (900, -4)) == [(1000, 1.0)]
    assert net((1, 1), (2, -5)) == []


def test_first_per_key_prunes_before_the_shuffle(spark):
    rows, df = table(spark)
    out = ordered.first_per_key(df, ["k"], ["t", "seq"])
    assert {r["seq"] for r in out.collect()} == {g[0][2] for g in by_key(rows).values()}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup(spark, limits, how):
    rows, df = table(spark)
    right = spark.createDataFrame([("hot", 1), ("a", 2), (None, 3), ("unused", 4)], "k string, w int")
    got = groups.lookup(df, right, ["k"], how, limits)
    found = {"hot": 1, "a": 2, None: 3}
    if how in ("left", "inner"):
        want = {(r[2], found.get(r[0])) for r in rows if how == "left" or r[0] in found}
        assert {(r["seq"], r["w"]) for r in got.collect()} == want
        assert got.count() == len(want)
    else:
        want = sorted(r[2] for r in rows if (r[0] in found) == (how == "left_semi"))
        assert sorted(r["seq"] for r in got.collect()) == want


def follow(links, x):
    path = []
    while x in links and x not in path:
        path.append(x)
        x = links[x]
    return min(path[path.index(x):]) if x in path else x


@pytest.mark.parametrize("shape", ["forest", "cycles", "long", "star"])
def test_resolve(spark, limits, shape):
    rng = random.Random(5)
    if shape == "forest":
        links = {i: rng.randrange(i) for i in range(1, 400) if rng.random() < 0.95}
    elif shape == "cycles":
        links = {i: rng.randrange(60) for i in range(80) if rng.random() < 0.97}
    elif shape == "long":
        links = {i: i - 1 for i in range(1, 130)} | {500: 501, 501: 502, 502: 500, 503: 503}
    else:
        links = {i: 0 for i in range(2, 120)} | {0: 1}
    df = spark.createDataFrame(list(links.items()), "src int, dst int")
    got = {r["src"]: r["dst"] for r in chains.resolve(df, "src", "dst", limits).collect()}
    assert got == {x: follow(links, x) for x in links}


def test_resolve_without_links(spark):
    assert chains.resolve(spark.createDataFrame([], "src string, dst string"), "src", "dst").count() == 0


def test_merge_chain_worked_case(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "id string")
    links = spark.createDataFrame([("A", "B"), ("B", "C")], "src string, dst string")
    got = chains.with_end(df, "id", links, "end").collect()
    assert {r["id"]: r["end"] for r in got} == {"A": "C", "B": "C", "C": "C", "D": "D"}


def test_link_rules(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("a", "x", 3), ("b", "x", 1), ("b", None, 2)], "s string, d string, n int"
    )
    assert [tuple(r) for r in chains.latest_links(df, "s", "d", ["n"]).collect()] == [("a", "x")]
    new = chains.latest_new_links(df, "s", "d", ["n"]).orderBy("s").collect()
    assert [tuple(r) for r in new] == [("a", "y"), ("b", "x")]


def test_aggregates_follow_the_order(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 3, "z"), ("a", 1, None)], "k string, n int, v string")
    got = df.groupBy("k").agg(
        ordered.first_known("v", ["n"]).alias("known"),
        ordered.first_value("v", ["n"]).alias("first"),
        ordered.last_value("v", ["n"]).alias("last"),
        F.count("*"),
    )
    assert tuple(got.first()) == ("a", "z", None, "z", 3)


def test_a_hot_key_is_split_by_adaptive_execution(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
        right = spark.range(60_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("w")).unionByName(spark.createDataFrame([("hot", 5)], "k string, w int"))
        out = groups.lookup(df, right, ["k"], "left", nulls_match=False)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert out.where("w = 5").count() == 20_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_exact_sums_in_netting(spark):
    rows = [("a", i, 60.0) for i in range(3000)] + [("a", 4000, 0.1), ("a", 4001, 0.3), ("a", 4002, -0.2)]
    df = spark.createDataFrame(rows, "k string, n int, qty double")
    got = {r["n"]: r["qty"] for r in ordered.net_latest_first(df, ["k"], ["n"], "qty").collect()}
    assert got[4000] == 0.1 and got[4001] == 0.1 and got[2999] == 60.0
