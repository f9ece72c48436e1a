from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablex import extract, limit, ordered, project, scan, where
from tablex.operators.extract import spread
from tablex.plans.relational import wide_1000


def test_names_are_columns_not_expressions(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF("a", "b+1", "a.b", "Odd Name")
    assert project(df, " a , b+1,a.b,Odd Name").columns == ["a", "b+1", "a.b", "Odd Name"]
    with pytest.raises(Exception):
        project(df, "a + 1").collect()
    with pytest.raises(Exception):
        project(df, "A").collect()


@pytest.mark.parametrize("columns", ["", "*"])
def test_all_columns(spark, columns):
    df = spark.range(3)
    assert project(df, columns) is df


def test_where_and_limit(spark):
    df = spark.range(10)
    assert where(df, "") is df
    assert limit(where(df, "id >= 4"), 3).count() == 3
    assert limit(df, 0) is df and limit(df, -1) is df
    assert limit(df, 100).count() == 10


@pytest.mark.parametrize("target", ["64MB", "1MB"])
@pytest.mark.parametrize("n", [5, 10_000, 100_000, 400_000])
def test_limit_of_a_join_is_exact(spark, target, n):
    folder = "/root/testdata/sf0.1"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", target)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines, orders = scan(spark, folder, "lineitem"), scan(spark, folder, "orders")
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        kept = limit(joined, n)
        assert kept.select("l_orderkey", "o_totalprice").collect().__len__() == n
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows", [1, 11, 1000, 5999, 6000, 9000])
@pytest.mark.parametrize("most", ["1000000", "10"])
def test_top_n_is_exact_and_ordered(spark, small, rows, most):
    keys = ["l_returnflag", "l_orderkey", "l_tax"]
    lines = scan(spark, small, "lineitem").select(*keys).toPandas()
    want = lines.sort_values(keys, ascending=[True, False, True]).head(rows)
    spark.conf.set("spark.sql.execution.topKSortFallbackThreshold", most)
    options = {"columns": "l_orderkey,l_tax", "rows": rows, "keys": ["l_returnflag", ("l_orderkey", "desc"), "l_tax"]}
    got = extract(spark, small, "lineitem", **options).collect()
    spark.conf.set("spark.sql.execution.topKSortFallbackThreshold", "1000000")
    assert [tuple(r) for r in got] == list(zip(want.l_orderkey, want.l_tax))


def test_building_an_extract_of_few_rows_runs_no_job(spark, small):
    """Larger limits are cut by counts, which take jobs (test_cut)."""
    spark.sparkContext.setJobGroup("building", "extracts")
    try:
        extract(spark, small, "lineitem", "l_orderkey", rows=10_000)
        extract(spark, small, "lineitem", "l_orderkey", rows=10_000, keys=["l_tax"])
        # no more than the look at the files' schema, once for each scan
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_order_puts_missing_values_above_all(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert [r.a for r in ordered(df, ["a"]).collect()] == [1, 2, None]
    assert [r.a for r in ordered(df, [("a", "desc")]).collect()] == [None, 2, 1]


def test_a_frequent_key_spreads_over_partitions(spark, small):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, 40_000, 1, 8).selectExpr("0 AS k", "id", "map('a', id) AS m")
    for out in (ordered(df, ["k"], steady_scan=True), ordered(df, ["k"])):
        sizes = Counter(r.p for r in out.select(F.spark_partition_id().alias("p")).collect())
        assert len(sizes) == 8 and max(sizes.values()) < 10_000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = extract(spark, small, "lineitem", "l_returnflag,l_orderkey", keys=["l_returnflag"])
    flags = [r.l_returnflag for r in lines.collect()]
    assert flags == sorted(flags)


def test_extract_combines_all_options(spark, small):
    df = extract(
        spark, small, "orders", "o_orderkey,o_totalprice", "o_orderstatus = 'F'", 5, [("o_totalprice", "desc")]
    )
    rows = [tuple(r) for r in df.collect()]
    orders = scan(spark, small, "orders").where("o_orderstatus = 'F'").toPandas()
    want = orders.sort_values("o_totalprice", ascending=False).head(5)
    assert rows == list(zip(want.o_orderkey, want.o_totalprice))


def test_predicate_may_use_columns_that_are_not_kept(spark, small):
    df = extract(spark, small, "orders", "o_orderkey", "o_orderstatus = 'F'", keys=["o_totalprice"])
    assert df.columns == ["o_orderkey"] and df.count() > 0


def test_sql_overrides_everything(spark):
    df = extract(spark, "nowhere", "nothing", "x", "broken (", 1, sql="SELECT id FROM range(4)")
    assert df.count() == 4


@pytest.mark.parametrize("schema, table", [("", ""), ("s", ""), ("", "t")])
def test_incomplete_extract(spark, schema, table):
    with pytest.raises(ValueError):
        extract(spark, schema, table)


def test_catalogue_table(spark):
    spark.sql("CREATE OR REPLACE GLOBAL TEMP VIEW `Odd ``Name``` AS SELECT * FROM range(3)")
    assert scan(spark, "global_temp", "Odd `Name`").count() == 3


def test_filter_and_columns_reach_the_scan(spark, small):
    df = extract(spark, small, "lineitem", "l_orderkey", "l_shipdate >= '1996-01-01' AND l_shipdate < '1997-01-01'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_double_quoted_identifiers(spark):
    spark.range(2).withColumnRenamed("id", "Odd Name").createOrReplaceTempView("odd")
    assert extract(spark, sql='SELECT "Odd Name" FROM odd').columns == ["Odd Name"]


def test_rows_that_become_wide_are_spread(spark, tmp_path):
    names = ", ".join(["'Customer' || id AS c_name", "'BUILDING' AS c_mktsegment", "id * 0.5D AS c_acctbal", "CAST(id % 25 AS INT) AS c_nationkey"]).split(", ")
    spark.range(1, 6001).coalesce(1).selectExpr("id AS c_custkey", *names).write.parquet(str(tmp_path / "customer.parquet"))
    customers = spark.read.parquet(str(tmp_path / "customer.parquet"))
    assert customers.rdd.getNumPartitions() == 1
    assert spread(customers, 1000).rdd.getNumPartitions() == 3
    assert spread(customers, 1000).exceptAll(customers).count() == 0 and spread(customers, 1000).count() == 6000
    assert spread(customers, 5).rdd.getNumPartitions() == 1
    assert wide_1000(spark, str(tmp_path)).rdd.getNumPartitions() == 3
