"""Publishing several tables of a day together, and their row order."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillflow.sinks import history

DAY = dt.date(2024, 3, 1)
NAMES = ["one", "two", "three", "four", "five"]


def tables(spark, value, n=4):
    return {name: spark.range(n).select("id", F.lit(value).alias("value")) for name in NAMES}


def seen(spark, out, day=DAY):
    return {
        name: {r["value"] for r in history.read_history(spark, f"{out}/{name}", day, day).collect()} for name in NAMES
    }


def broken(spark):
    return spark.range(3).select("id", F.raise_error(F.lit("stop")).cast("string").alias("value"))


def test_failure_in_the_middle_leaves_the_old_day_whole(spark, tmp_path):
    out = str(tmp_path)
    history.publish(tables(spark, "old"), out, DAY)
    with pytest.raises(Exception, match="stop"):
        history.publish(tables(spark, "new") | {"three": broken(spark)}, out, DAY)
    assert seen(spark, out) == {name: {"old"} for name in NAMES}
    assert [len(os.listdir(f"{out}/{name}/run_date={DAY}")) for name in NAMES] == [1] * 5
    assert history.publish(tables(spark, "new", 2), out, DAY) == dict.fromkeys(NAMES, 2)
    assert seen(spark, out) == {name: {"new"} for name in NAMES}


def test_a_run_that_died_is_not_read(spark, tmp_path):
    """Nothing cleans up after a killed process; its tables stay unseen, in the first run of a table too."""
    out = str(tmp_path)
    died = history.StagedRun(spark, out, DAY)
    for name, df in tables(spark, "dead").items():
        died.write(name, df)
    with pytest.raises(FileNotFoundError):
        history.read_history(spark, f"{out}/one")
    history.publish(tables(spark, "old"), out, DAY)
    died = history.StagedRun(spark, out, DAY)
    died.write("one", tables(spark, "dead")["one"])
    assert seen(spark, out) == {name: {"old"} for name in NAMES}


def test_killed_after_the_marker_before_the_clearing(spark, tmp_path):
    out = str(tmp_path)
    history.publish(tables(spark, "old"), out, DAY)
    run = history.StagedRun(spark, out, DAY)
    for name, df in tables(spark, "new").items():
        run.write(name, df)
    run.commit()
    assert seen(spark, out) == {name: {"new"} for name in NAMES}
    # The old rows still lie there, but are not read.
    assert len(os.listdir(f"{out}/one/run_date={DAY}")) == 2


def test_two_runs_at_once_give_one_of_them(spark, tmp_path, monkeypatch):
    out, runs = str(tmp_path), []
    for value in ("a", "b"):
        run = history.StagedRun(spark, out, DAY)
        for name, df in tables(spark, value).items():
            run.write(name, df)
        runs.append(run)
    before = history.committed(spark, out)
    monkeypatch.setattr(history, "committed", lambda *_: before)  # neither sees the other
    for run in runs:
        run.commit()
    monkeypatch.undo()
    assert len(history.committed(spark, out).collect()) == 2
    found = seen(spark, out)
    assert len(set(map(tuple, found.values()))) == 1 and found["one"] in ({"a"}, {"b"})


def test_days_and_other_tables_stay(spark, tmp_path):
    out, next_day = str(tmp_path), DAY + dt.timedelta(days=1)
    history.publish(tables(spark, "first"), out, DAY)
    history.publish(tables(spark, "second"), out, next_day)
    history.publish({"one": tables(spark, "again")["one"].withColumn("more", F.lit(1))}, out, next_day)
    got = history.read_history(spark, f"{out}/one").groupBy("run_date", "value").agg(F.sum("more").alias("more"))
    assert sorted(map(tuple, got.collect())) == [(DAY, "first", None), (next_day, "again", 4)]
    assert seen(spark, out, next_day)["two"] == {"second"}


def test_one_minute_lies_in_several_ranges(spark):
    """The sort's ranges are cut inside a day and minute, so a busy minute is not one task's work."""
    rows = spark.range(20000).select(
        F.lit(DAY).alias("date"), F.when(F.col("id") % 10 < 9, "18:30").otherwise("09:00").alias("time_in"), "id"
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = history.in_order(rows, "daily_invoice").withColumn("part", F.spark_partition_id())
        sizes = placed.where("time_in = '18:30'").groupBy("part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 9000


def test_order_does_not_depend_on_the_input_order(spark):
    rows = spark.range(50).select(F.lit(DAY).alias("date"), F.lit("10:00").alias("time_in"), "id")
    one = [r["id"] for r in history.in_order(rows, "daily_invoice").collect()]
    other = [r["id"] for r in history.in_order(rows.orderBy(F.rand(3)).repartition(3), "daily_invoice").collect()]
    assert one == other
