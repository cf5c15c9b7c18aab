"""Keys that outgrow their places, and views whose work grows with the tables."""
import pytest
from pyspark.sql import functions as F

from stayflow import fixtures as fx
from stayflow.functions import keys
from stayflow.operators import evaluate as ev, stats as st
from stayflow.plans import delivery as de
from stayflow.queries.statistics import many
from stayflow.sources import guarded


def test_target_list_keeps_keys_that_outgrow_their_places(spark):
    key = keys.build_key(F.lit("0701"), F.col("chc_id"), F.col("chc_id") % 100, grow=True)
    df = spark.createDataFrame([(1234507, 0.9), (1234500, 0.8), (123450, 0.7), (7, 0.6)], f"chc_id long, {ev.PROB} double")
    got = de.target_list(df.withColumns({ev.PREDICTED: F.lit(1), "corp_house_cust": key}), 200004, "t")
    assert [tuple(r)[2:] for r in got.sort(F.desc("corp_house_cust")).collect()] == [
        ("0701", "123450", "70", "0701123450707"), ("0701", "123450", "50", "070112345050"), ("0701", "123450", "00", "0701123450000"), ("0701", "000007", "07", "070100000707"),
    ]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two customers, one of them listed twice, with orders in some of thirteen months."""
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{path}/region.parquet")
    customers = [(1, 0, 5.0, "X"), (2, 0, 6.0, "Y"), (2, 0, 6.0, "Y"), (None, 0, 7.0, "Z")]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{path}/customer.parquet")
    orders = [(1, "2000-01-05", 10.0), (1, "2000-03-05", 20.0), (2, "2000-02-01", 1.0), (2, "2000-02-02", 2.0)]
    orders += [(3, f"{2000 + m // 12}-{m % 12 + 1:02d}-01", 1.0) for m in range(13)]
    rows = spark.createDataFrame(orders, "o_custkey long, d string, o_totalprice double")
    rows = rows.selectExpr("monotonically_increasing_id() AS o_orderkey", "o_custkey", "'O' AS o_orderstatus", "o_totalprice", "CAST(d AS TIMESTAMP) AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    rows.write.parquet(f"{path}/orders.parquet")
    return path


def test_customer_months_are_expanded_without_sorting_them(spark, tables):
    df = fx.cust_month(spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    after = plan[: plan.index("Generate")]  # the plan's upper part works on the rows of months
    assert "Window" not in plan and "Sort" not in after and "Exchange" not in after
    cols = ["dt", "tenure", "drform", "rev_m0", "rev_m1", "rev_m2", "orders_m0", "orders_6m"]
    one = [tuple(r) for r in df.filter("chc_id = 1 AND dt <= 200004").sort("dt").select(*cols).collect()]
    assert one == [
        (200001, 0, "ACTIVE", 10.0, None, None, 1, 1), (200002, 1, "ACTIVE", 0.0, 10.0, None, 0, 1),
        (200003, 2, "ACTIVE", 20.0, 0.0, 10.0, 1, 2), (200004, 3, "ACTIVE", 0.0, 20.0, 0.0, 0, 2),
    ]
    # two rows a month: twelve rows are then six months, so one row of August still sees an order
    assert [r.drform for r in df.filter("chc_id = 2 AND dt > 200007").collect()].count("ACTIVE") == 1
    two = [tuple(r) for r in df.filter("chc_id = 2 AND dt <= 200003").select("dt", "rev_m0", "rev_m1", "orders_6m").collect()]
    assert sorted(two, key=str) == sorted([(200002, 3.0, None, 2), (200002, 3.0, 3.0, 4), (200003, 0.0, 3.0, 4), (200003, 0.0, 0.0, 4)], key=str)
    assert df.filter("chc_id IS NULL").isEmpty()


def test_snapshot_holds_the_same_rows_and_leaves_the_session_as_it_was(spark, tables):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    old, df = spark.conf.get(name), fx.cust_month(spark, tables)
    kept = fx.snapshot(spark, tables).select(*df.columns)
    assert kept.exceptAll(df).isEmpty() and df.exceptAll(kept).isEmpty() and spark.conf.get(name) == old


def test_describe_reads_its_table_once(spark, tmp_path):
    path = str(tmp_path / "numbers")
    rows = [("a", 1.0), ("a", 1.0), ("a", 4.0), ("a", None), ("b", 3.0), ("c", None)]
    spark.createDataFrame(rows, "g string, x double").write.parquet(path)
    out = st.describe(spark.read.parquet(path), ["x"], ["g"], {"p50": 0.5})
    assert path not in out._jdf.queryExecution().executedPlan().toString()  # all from the counted values
    got = {r["g"]: (r["n"], r["mean"], r["sd"] and round(r["sd"], 9), r["min"], r["max"], r["missing_pct"], r["p50"]) for r in out.collect()}
    assert got == {"a": (3, 2.0, 1.732050808, 1.0, 4.0, 25.0, 1.0), "b": (1, 3.0, None, 3.0, 3.0, 0.0, 3.0), "c": (0, None, None, None, None, 100.0, None)}


def test_buckets_are_dealt_to_a_task_each(spark, tmp_path):
    df = spark.range(400).selectExpr("id % 40 AS chc_id", "CAST(id % 10 AS INT) AS dt")
    seen = []
    old, type(df).repartition = type(df).repartition, lambda self, n, *c: seen.append(n) or old(self, n, *c)
    try:
        guarded.store_bucketed(df, "stayflow_growth", str(tmp_path / "t"), buckets=4)
    finally:
        type(df).repartition = old
    assert seen == [40] and spark.table("stayflow_growth").exceptAll(df.select("chc_id", "dt")).isEmpty()
    guarded.drop_stored(spark, "stayflow_growth")


def test_wide_table_is_derived_in_many_tasks(spark, tmp_path):
    spark.range(4000).selectExpr("id AS c_custkey", "CAST(id AS DOUBLE) AS c_acctbal").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    assert many(spark, str(tmp_path), 1000).rdd.getNumPartitions() == 4


def test_quantile_parts_take_one_python_worker_a_task(spark, monkeypatch):
    from stayflow.operators import quantiles as qu

    made, kept = [], qu._part_counts
    monkeypatch.setattr(qu, "_part_counts", lambda *a: made.append(kept(*a)) or made[-1])
    rows = [(float(i * 37 % 1001), None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(i % 400)) for i in range(1001)]
    df = spark.createDataFrame(rows, "x double, y double")
    found = qu.exact_quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 1.0], limit=50)
    known = sorted(y for _, y in rows if y is not None and y == y)
    assert found["x"] == [0.0, 250.0, 500.0, 1000.0]
    spot = 0.25 * (len(known) - 1)
    assert abs(found["y"][1] - (known[int(spot)] + (known[int(spot) + 1] - known[int(spot)]) * (spot % 1))) < 1e-9
    assert found["y"][0] == known[0] and found["y"][3] == known[-1]
    assert made and all(d._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1 for d in made)
