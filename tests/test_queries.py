"""Every query against its SQL in a second engine, over whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import canonical, database
from triagelake.plans.oracle import ORACLE
from triagelake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = result.fetchall()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert got, "the query returns no rows"
    assert canonical(df.columns, got) == canonical(columns, want)


def test_known_values(spark, sf_dir):
    from triagelake.plans import queries as q

    assert q.duplicate_keys(spark, sf_dir).first()["violations"] == 11_785
    assert q.budget_admit(spark, sf_dir).count() == 304  # whole texts cost more than their starts
    matrix = {(r["actual"], r["predicted"]): r["n"] for r in q.confusion(spark, sf_dir).collect()}
    assert {k: v for k, v in matrix.items() if k[0] in ("de", "en") and v} == {
        ("de", "de"): 127, ("de", "other"): 2, ("en", "en"): 608, ("en", "fr"): 1, ("en", "other"): 11
    }
    parts = {
        (r["gold_label"], r["part"]): r["count"]
        for r in q.stratified_split(spark, sf_dir).groupBy("gold_label", "part").count().collect()
    }
    assert parts[("de", "test")] == 32 and parts[("en", "dev")] == 465 and parts[("es", "test")] == 26
    assert q.label_counts(spark, sf_dir).count() == 118
