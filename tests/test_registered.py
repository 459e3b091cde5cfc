"""Every registered query against its SQL twin, and what the plans must not contain."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from skyledger.workload import queries as registered

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(registered.TWINS))
def test_query_equals_its_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    twin = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in twin.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in twin.fetchall())


def test_entry(spark):
    assert entry.entry(spark).first().total_records > 0


def test_merge_plan(spark):
    """Pruned columns, one hash aggregate pair and one exchange of the data on (station, day)."""
    df = registered.unified(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(station_id") == 1
    assert "SortAggregate" not in plan and "partial_max_by" in plan
    scan = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scan) == 1 and "l_tax" not in scan[0] and "l_linestatus" not in scan[0]
