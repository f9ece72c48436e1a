import ast
from pathlib import Path

import pytest
from checking import ROOT, SMALL, compare, connect

import __spark_entry__ as contract
from tablex.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n in contract.queries() if n in QUERIES])
def test_query_matches_its_sql(spark, con, name):
    df = contract.queries()[name](spark, SMALL)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) == []


def test_every_oracle_has_a_query():
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_no_python_functions_in_the_plans():
    """Everything runs inside the JVM: no UDF, no RDD, no local checkpoint."""
    banned = {"udf", "pandas_udf", "mapInPandas", "applyInPandas", "mapPartitions", "rdd", "localCheckpoint", "crossJoin", "toPandas"}
    for file in Path(ROOT, "tablex").rglob("*.py"):
        if "llm" in file.relative_to(ROOT).parts:
            continue  # its own tests say which of its operators may use Python
        used = {n.attr for n in ast.walk(ast.parse(file.read_text())) if isinstance(n, ast.Attribute)}
        assert not used & banned, file
