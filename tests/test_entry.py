"""Every registered query against its SQL at the smallest scale."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
#: Operators that have their own folder of tests.
OWN_TESTS = re.compile(r"op\d+_|pipeline$")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(q for q in E.oracle_sql() if not OWN_TESTS.match(q)))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    result = duck.execute(E.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(names, result.fetchall())


def test_names_and_entry(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {q for q in set(E.queries()) - set(E.oracle_sql()) if not OWN_TESTS.match(q)} == set()
    assert E.entry(spark).count() == 5


def test_no_unbounded_plans(spark):
    """No query multiplies its inputs or collects groups."""
    for name, query in E.queries().items():
        if OWN_TESTS.match(name) or name.startswith("stream_") or name in ("trained_models", "predictions"):
            continue
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|collect_(list|set)", plan), name
