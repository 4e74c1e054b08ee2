import duckdb
import pytest

import __spark_entry__ as contract
from slackline.plans import fixtures as fx
from slackline.plans.queries import REGISTRY
from tests.conftest import TABLES

MODELS = {"gbt_forecast", "random_search", "ensemble_mean", "early_stopped_rounds"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract():
    llm = {n for n in contract.queries() if n == "pipeline" or (n.startswith("op") and n[2].isdigit())}
    assert set(contract.oracle_sql()) - llm == set(contract.queries()) - MODELS - llm


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["forecast", "n"]
    assert df.count() == 2


@pytest.fixture(scope="module")
def tables():
    base = duckdb.connect()
    for name in fx.SCHEMAS:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    return base


def shape(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - MODELS))
def test_query_equals_its_sql(spark, tables, name):
    df = REGISTRY[name](spark, TABLES)
    result = tables.execute(contract.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert shape(df.columns, [tuple(r) for r in df.collect()]) == shape(names, result.fetchall())
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert "ArrowEvalPython" not in text


def test_scan_reads_only_what_the_panel_needs(spark):
    text = plan(fx.panel(spark, TABLES))
    assert "l_quantity" not in text and "p_name" not in text and "s_acctbal" not in text


def test_first_orders_are_limited_before_the_shuffle(spark):
    lines = plan(fx.survey(spark, TABLES)).splitlines()
    partial = [i for i, t in enumerate(lines) if "WindowGroupLimit" in t and "Partial" in t]
    exchange = [i for i, t in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in t]
    assert partial and exchange and exchange[0] < partial[0]


def test_large_dimensions_are_not_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastExchange" not in plan(fx.panel(spark, TABLES))
    expected = sorted(fx.panel(spark, TABLES).collect())
    conf("spark.sql.adaptive.enabled", "false")
    salted = fx.panel(spark, TABLES)
    assert "_salt" in plan(salted)
    assert sorted(salted.collect()) == expected
