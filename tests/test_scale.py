"""Sketch bounds, bitmaps, the salted join, bucketed tables and the bounded top-k."""

import random

import pytest
from pyspark.sql import functions as F

from ordermart.operators import cleaning as C
from ordermart.operators import joins as J
from ordermart.operators import marts as A
from ordermart.operators import quantiles as Q
from ordermart.operators import topk
from ordermart.plans import catalog
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- quantiles

def test_kll_answers_lie_within_one_percent(spark):
    rng = random.Random(1)
    values = [rng.lognormvariate(3, 2) for _ in range(40000)] + [5.0] * 9000
    df = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "x double").repartition(7)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = Q.kll_quantiles(df, "x", probs)
    errors = Q.rank_errors(df, "x", dict(zip(probs, got))).first()
    assert errors.n == len(values) and all(errors[f"error{i}"] <= 0.01 for i in range(5))
    assert Q.kll_quantiles(df.limit(0), "x", [0.5]) == [None]


def test_rank_errors_count_the_distance(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    row = Q.rank_errors(df, "x", {0.25: 30.0, 0.5: 50.0, 0.75: 70.5}).first()
    assert (row.n, round(row.error0, 6), row.error1, round(row.error2, 6)) == (100, 0.04, 0.0, 0.05)
    same = spark.range(10).select(F.lit(3.0).alias("x"))
    assert Q.rank_errors(same, "x", {0.25: 3.0, 0.75: 3.0}).first()[1:] == (0.0, 0.0)


# --- distinct customers

def test_bitmaps_count_like_distinct(spark):
    rng = random.Random(2)
    rows = [(f"2023-{rng.randrange(1, 13):02d}", rng.choice([None, "UNKNOWN"] + [f"C{i}" for i in range(500)])) for _ in range(5000)]
    rows += [("2024-01", "UNKNOWN")] * 3000 + [("2024-02", None)]
    done = spark.createDataFrame(rows, "year_month string, customer_id string").repartition(5)
    path = __import__("tempfile").mkdtemp() + "/numbers"
    A.numbered_customers(done).write.parquet(path)
    maps = A.customer_bitmaps(done, spark.read.parquet(path))
    assert A.customers_of(maps).first().n == len({c for _, c in rows})               # NULL counts as one
    got = {(r.year, r.year_month): r.n_customers for r in A.customers_by_span(maps).collect()}
    want = {}
    for m, c in rows:
        for key in ((m[:4], m), (m[:4], None)):
            want.setdefault(key, set()).add(c)
    assert got == {k: len(v - {None}) for k, v in want.items()}
    assert A.customers_of(maps.limit(0)).first().n == 0


def test_stored_kpis_do_not_read_the_fact(spark):
    a = catalog._a(spark, SF_SMALL)
    for df in (a.kpi_summary(), A.distinct_counts(a.cube(), a.customer_bitmaps())):
        plan = plan_of(df)
        assert a.pipe.processed_path not in plan and "customer_id" not in plan
    cube = a.cube()
    none = A.distinct_counts(cube.limit(0), a.customer_bitmaps().limit(0)).first()
    assert (none.unique_customers, none.active_sellers) == (0, 0)


# --- joins

def orders(spark, n=4000):
    return spark.range(n, numPartitions=6).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "S001").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("S"), F.lpad((F.col("id") % 220).cast("string"), 3, "0"))).alias("seller_id"),
        F.when(F.col("id") % 4 == 0, "north").alias("region"))


def test_salted_enrichment_equals_broadcast(spark):
    df, dim = orders(spark), C.seller_dim(spark, 200)
    want = sorted(map(repr, C.enrich_sellers(df, dim, 200).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = C.enrich_sellers(df, dim, 200, max_broadcast_rows=0)
        assert "BroadcastHashJoin" not in plan_of(got) and "_salt" in plan_of(got)
        assert sorted(map(repr, got.collect())) == want
        hot = got.where("seller_id = 'S001'")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        tasks = C.enrich_sellers(df, dim, 200, max_broadcast_rows=0).where("seller_id = 'S001'").select(
            F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(tasks) > 1 and max(r["count"] for r in tasks) < hot.count()
        for how in ("left_semi", "left_anti", "inner"):
            salts = {"S001": 4, "S002": 2}
            assert sorted(map(repr, J.salted_join(df, dim, "seller_id", "order_id", salts, how).collect())) == sorted(
                map(repr, df.join(dim, "seller_id", how).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    with pytest.raises(ValueError):
        J.salted_join(df, dim, "seller_id", "order_id", {"S001": 4}, "full")


def test_hot_keys_are_found_and_sized(spark):
    assert J.hot_keys(orders(spark), "seller_id", "order_id", 0.2, 8) == {"S001": 3}
    assert J.hot_keys(orders(spark).limit(0), "seller_id", "order_id", 0.2, 8) == {}


# --- bucketed fact

def test_bucketed_fact_needs_no_exchange(spark):
    df = catalog.QUERIES["seller_monthly_bucketed"](spark, SF_SMALL)
    plan = plan_of(df)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(map(repr, df.collect())) == sorted(map(repr, catalog.QUERIES["seller_monthly"](spark, SF_SMALL).collect()))


def test_a_hot_seller_is_not_bucketed(spark):
    a = catalog._a(spark, SF_SMALL)
    assert "Bucketed: true" not in plan_of(type(a)(a.pipe, "hot").sales_by_seller(max_share=0.001))


# --- top-k

@pytest.mark.parametrize("k", [1, 10, 300])
def test_top_counts_equal_the_full_count(spark, k):
    rng = random.Random(k)
    keys = [f"p{min(int(rng.paretovariate(0.7)), 3000)}" for _ in range(20000)] + [None] * 50
    df = spark.createDataFrame([(x,) for x in keys], "key string").repartition(8)
    moved = {}
    got = [(r.key, r.n) for r in topk.top_counts(df, "key", k, moved).collect()]
    full = df.where("key is not null").groupBy("key").count().orderBy(F.desc("count"), "key").limit(k).collect()
    assert got == [(r.key, r["count"]) for r in full]
    if k <= 10:                                       # a skewed distribution: few of the entries move
        assert moved["heads"] + moved["strong"] + moved["candidates"] < moved["lists"] / 3


def test_top_counts_of_small_and_even_tables(spark, monkeypatch):
    even = spark.createDataFrame([(f"k{i % 40:02d}",) for i in range(400)], "key string").repartition(5)
    assert [r.key for r in topk.top_counts(even, "key", 3).collect()] == ["k00", "k01", "k02"]
    assert topk.top_counts(even.limit(0), "key", 3).count() == 0
    assert topk.top_counts(even.limit(1), "key", 3).count() == 1
