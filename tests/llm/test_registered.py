"""Every registered query against its SQL, and what the queries promise about their columns."""

import ast
from pathlib import Path

import pytest
from checking import compare, connect

from tablex.llm.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
NATIVE = ("license_scan", "quality_rules", "line_dedup", "mixing", "common")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


def test_native_operators_use_no_python_functions():
    banned = {"udf", "pandas_udf", "mapInPandas", "mapInArrow", "applyInPandas", "mapPartitions", "rdd", "localCheckpoint", "crossJoin", "toPandas"}
    import tablex.llm

    for name in NATIVE:
        tree = ast.parse(Path(tablex.llm.__file__).with_name(f"{name}.py").read_text())
        assert not {n.attr for n in ast.walk(tree) if isinstance(n, ast.Attribute)} & banned, name


def test_thirteen_operators_and_the_pipeline():
    import __spark_entry__ as contract

    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names
