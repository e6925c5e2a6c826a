"""Every registered query against its SQL on the driver's tables."""

import os

import pytest

from table_queries import compare, queries
from table_queries.oracle import SQL
from table_queries.queries import OPTIONS, REGISTERED
from tillflow.options import GroupLimits

SF_DIR = os.environ.get("TILLFLOW_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

# Their results depend on how hot groups are cut only if the cutting is wrong.
CUT = [
    "invoice_line_join", "merge_split_semi", "merge_chain", "merge_cycles", "fill_both_ways", "lifo_netting",
    "occurrence_join", "split_replay", "price_override",
]


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.fixture(autouse=True)
def utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(REGISTERED)


@pytest.mark.parametrize("name", list(REGISTERED))
def test_query(spark, con, name):
    assert compare.compare(spark, con, SF_DIR, name) is None


@pytest.mark.parametrize("name", CUT)
def test_query_with_cut_groups(spark, con, monkeypatch, name):
    monkeypatch.setattr(GroupLimits.__init__, "__defaults__", tuple(vars(compare.CUT).values()))
    before = OPTIONS.limits
    object.__setattr__(OPTIONS, "limits", compare.CUT)
    try:
        assert compare.compare(spark, con, SF_DIR, name) is None
    finally:
        object.__setattr__(OPTIONS, "limits", before)


def test_lines_are_numbered_before_texts_and_places_are_added(spark, monkeypatch):
    """What is numbered is dealt out whole, so it should be narrow."""
    numbered, real = [], queries.occurrence_number
    monkeypatch.setattr(queries, "occurrence_number", lambda df, *args, **kwargs: numbered.append(dict(df.dtypes)) or real(df, *args, **kwargs))
    assert queries.match_residuals(spark, SF_DIR).count() > 0
    assert len(numbered) == 2 and not any(t.startswith("struct") for types in numbered for t in types.values())
    assert not any({"id", "number", "phone", "customer_class"} & set(types) for types in numbered)


@pytest.mark.parametrize("name", list(SQL))
def test_types_agree_with_sql(spark, con, name):
    """The hash of a result depends on its types, so they must be of one kind on both sides."""
    kinds = {"string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT"}
    described = con.execute(f"DESCRIBE {SQL[name]}").fetchall()
    want = {row[0]: row[1] for row in described}
    got = {c: kinds.get(t, t) for c, t in REGISTERED[name](spark, SF_DIR).dtypes}
    assert got == want
