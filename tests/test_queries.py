"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from prediolake.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    return c


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(None if pd.isna(v) else str(v) for v in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.toPandas()
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    elif name != "export_filter_city":
        assert len(got)


@pytest.mark.parametrize("name", ["exportable_listings", "validate_rules", "upsert_listings", "card_rule_chain", "merge_first_match"])
def test_plans_stay_native(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "Join Cross" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["count_all"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    plan = QUERIES["normalize_tipo"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan


def test_queries_are_known_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 100"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"PYTHONPATH": root}).returncode == 0
