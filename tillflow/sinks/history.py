"""Published tables: history that grows by one day per run, and the run log.

A run writes its tables beside what is there, each into ``<table>/run_date=<day>/run=<id>``, and then one marker file in
``_commits`` that names them all. Readers follow the markers, so they see the tables of a day from one run or from the run
before it, never from both; a run that fails before its marker has published nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schemas import HEADINGS, SORTED_BY


def zero_filled(df: DataFrame, text_too: bool = False) -> DataFrame:
    """Missing, infinite and not-a-number values become 0, in text columns only on request."""
    out = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
            out[f.name] = F.when(bad, F.lit(0).cast(f.dataType)).otherwise(c)
        elif isinstance(f.dataType, T.NumericType):
            out[f.name] = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif text_too and isinstance(f.dataType, T.StringType):
            out[f.name] = F.coalesce(c, F.lit("0"))
    return df.withColumns(out) if out else df


def appended(old: DataFrame, new: DataFrame, clean: bool = True, zero_fill_text: bool = False) -> DataFrame:
    """Old rows, without the empty ones, followed by the new; columns are matched by name."""
    both = old.dropna("all").unionByName(new, allowMissingColumns=True)
    return zero_filled(both, zero_fill_text) if clean else both


def for_sheet(df: DataFrame, table: str) -> DataFrame:
    """Localised headings, and dates as dd/MM/yyyy text."""
    names = HEADINGS[table]
    dates = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
    return df.select(
        *[(F.date_format(c, "dd/MM/yyyy") if c in dates else F.col(c)).alias(name) for c, name in names.items()]
    )


def from_sheet(df: DataFrame, table: str) -> DataFrame:
    """The columns of a published table under their own names, dates as dates."""
    names = HEADINGS[table]
    return df.select(
        *[(F.to_date(f"`{h}`", "dd/MM/yyyy") if c == "date" else F.col(f"`{h}`")).alias(c) for c, h in names.items()]
    )


def in_order(df: DataFrame, table: str) -> DataFrame:
    """The table's row order; tables without one are only brought to a sensible number of files.

    The order goes on with a key made of the whole row, so that the ranges of the sort can be cut between rows that agree
    in the columns people see it by (a day, a minute), and rows that agree in these have a fixed order.
    """
    if table not in SORTED_BY:
        return df.hint("rebalance")
    shown = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in SORTED_BY[table]]
    return df.orderBy(*shown, F.xxhash64(*df.columns))


COMMITS = "_commits"
_MARKER = "sequence bigint, run string, day date, tables map<string, bigint>"


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and what makes its path objects."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark._jsc.hadoopConfiguration()), new


def committed(spark: SparkSession, path: str) -> DataFrame:
    """Markers of all finished runs under ``path``: ``sequence, run, day, tables`` with the rows of each table."""
    fs, new = _file_system(spark, path)
    if not fs.exists(new(f"{path}/{COMMITS}")):
        return spark.createDataFrame([], _MARKER)
    return spark.read.schema(_MARKER).option("pathGlobFilter", "*.json").json(f"{path}/{COMMITS}")


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run that holds each table and day: the last one committed."""
    runs = committed(spark, path).select("sequence", "run", "day", F.explode("tables").alias("table", "rows"))
    last = F.max_by(F.struct("run", "rows"), F.struct("sequence", "run"))
    return runs.groupBy("table", "day").agg(last.alias("_last")).select("table", "day", "_last.*")


class StagedRun:
    """Tables of one day that are to appear together.

    ``write`` stages a table, which no reader sees; ``commit`` makes all of them the day's tables by renaming one file
    into its place. ``abandon`` removes what was staged.
    """

    def __init__(self, spark: SparkSession, path: str, day: dt.date) -> None:
        self.spark, self.path, self.day, self.run = spark, path.rstrip("/"), day, uuid.uuid4().hex
        self.rows: dict[str, int] = {}
        self.replaced: list[str] = []

    def _folder(self, table: str, run: str) -> str:
        return f"{self.path}/{table}/run_date={self.day}/run={run}"

    def write(self, table: str, df: DataFrame) -> int:
        """Returns the number of rows, counted while writing."""
        counted = Observation()
        self.rows[table] = -1  # begun
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(self._folder(table, self.run))
        self.rows[table] = counted.get["rows"]
        return self.rows[table]

    def commit(self) -> dict[str, int]:
        """Publish. What the day's tables held before is no longer read, and kept in ``replaced``."""
        fs, new = _file_system(self.spark, self.path)
        mine = F.col("table").isin(*self.rows) & (F.col("day") == F.lit(self.day))
        self.replaced = [self._folder(r["table"], r["run"]) for r in current_runs(self.spark, self.path).where(mine).collect()]
        last = committed(self.spark, self.path).agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
        marker = {"sequence": last + 1, "run": self.run, "day": str(self.day), "tables": self.rows}
        # The name is the run's own, so two runs at once leave two markers; the later in order counts, for all tables.
        name = f"{last + 1:020d}-{self.run}"
        staged, final = (new(f"{self.path}/{COMMITS}/{name}{end}") for end in (".staged", ".json"))
        out = fs.create(staged, True)
        out.write(bytearray(json.dumps(marker).encode()))
        out.close()
        if not fs.rename(staged, final):
            raise OSError(f"the marker of run {self.run} could not be put in place")
        return dict(self.rows)

    def abandon(self) -> None:
        """Remove what was staged and not committed."""
        self._remove([self._folder(table, self.run) for table in self.rows])

    def clear(self) -> None:
        """Remove the rows that this run replaced."""
        self._remove(self.replaced)

    def _remove(self, folders: list[str]) -> None:
        fs, new = _file_system(self.spark, self.path)
        for folder in folders:
            fs.delete(new(folder), True)


def read_history(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The published table in folder ``path``, of all days or those from ``first`` to ``last``, with its ``run_date``.

    Only the folders of committed runs are listed and read. A column that a day does not have is null there.
    """
    root, table = path.rstrip("/").rsplit("/", 1)
    runs = current_runs(spark, root).where(F.col("table") == table)
    if first:
        runs = runs.where(F.col("day") >= F.lit(first))
    if last:
        runs = runs.where(F.col("day") <= F.lit(last))
    # One row for each day.
    folders = [f"{path}/run_date={r['day']}/run={r['run']}" for r in runs.orderBy("day").collect()]
    if not folders:
        raise FileNotFoundError(f"nothing is published of {table} under {root}")
    df = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*folders)
    return df.drop("run")


def publish(
    tables: Mapping[str, DataFrame], path: str, day: dt.date, clean: bool = True, zero_fill_text: bool = False
) -> dict[str, int]:
    """Publish tables of a day together; a rerun of the day replaces its rows. Returns rows per table.

    A table with headings gets them; every table is written in its order.
    """
    spark = next(iter(tables.values())).sparkSession
    run = StagedRun(spark, path, day)
    try:
        for name, df in tables.items():
            df = in_order(df, name)
            df = for_sheet(df, name) if name in HEADINGS else df
            run.write(name, zero_filled(df, zero_fill_text) if clean else df)
        rows = run.commit()
    except BaseException:
        run.abandon()
        raise
    run.clear()
    return rows


RUN_LOG = "status string, date date, rows map<string, bigint>, message string, matched map<string, bigint>"


def log_run(
    spark: SparkSession,
    path: str,
    job: str,
    day: dt.date,
    rows: Mapping[str, int],
    status: str = "success",
    message: str | None = None,
    matched: Mapping[str, int] | None = None,
) -> None:
    """One row about the run, in the folder of its job and day; ``status`` is success, incomplete or error.

    ``matched`` counts the lines by the rule that gave them their bill.
    """
    row = [(status, day, dict(rows), message, matched and dict(matched))]
    spark.createDataFrame(row, RUN_LOG).coalesce(1).write.mode("append").json(f"{path}/run_log/job={job}")
