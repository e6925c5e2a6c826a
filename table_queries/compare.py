"""Run registered queries next to their SQL: ``python -m table_queries.compare [--cut] SF_DIR [name ...]``."""

from __future__ import annotations

import decimal
import glob
import os
import sys
import time

import duckdb

from table_queries.oracle import SQL
from table_queries.queries import OPTIONS, REGISTERED
from tillflow.options import GroupLimits


CUT = GroupLimits(max_rows=10)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None if both give the same rows, else what differs."""
    df = REGISTERED[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        return None if got else "no rows"
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if got == want and got:
        return None
    only = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows against {len(want)}; only here {only[0]}; only in SQL {only[1]}"


def main() -> None:
    from pyspark.sql import SparkSession

    args = [a for a in sys.argv[1:] if a != "--cut"]
    if "--cut" in sys.argv:
        # The largest groups count as hot, however small: the same results must come out.
        object.__setattr__(OPTIONS, "limits", CUT)
        GroupLimits.__init__.__defaults__ = tuple(vars(CUT).values())
    sf_dir, names = args[0], args[1:] or list(REGISTERED)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or ('same' if name in SQL else 'rows only')}", flush=True)
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
