import datetime as dt

from ordermart.operators import views as V
from ordermart.plans import benchmark as B


def test_timed_counts_jobs(spark):
    df = spark.range(1000).groupBy("id").count()
    t = B.timed(spark, "probe", lambda: B.noop(df), runs=3)
    assert len(t.seconds) == 3 and t.min <= t.mean and t.jobs >= 1


def test_benchmark_rows_skip_failed_and_report(spark):
    timings = [B.Timing("sql_revenue_by_category", [2.0, 3.0, 4.0], 2),
               B.Timing("mr_category_sum", [6.0, 6.0, 6.0], 2),
               B.Timing("sql_top_products", [-1.0], 1),            # failed run: skipped
               B.Timing("clean_orders", [1.0], 5)]                 # not a benchmark task
    rows = B.benchmark_rows(spark, timings)
    got = {(r["task"], r["engine"]): r for r in rows.collect()}
    assert set(got) == {("revenue_by_category", "spark_sql"), ("revenue_by_category", "spark_lines")}
    r = got[("revenue_by_category", "spark_sql")]
    assert r["min_seconds"] == 2.0 and r["avg_seconds"] == 3.0 and r["runs"] == 3 and r["n_jobs"] == 2
    rep = {x["key"]: x["value"] for x in B.report(rows).collect()}
    assert rep["speedup_ratio"] == "3.00" and rep["sql_total_sec"] == "2.00"
    assert rep["spark_sql_revenue_by_category"] == "2.00"
    hist = V.benchmark_history(rows).collect()
    assert len(hist) == 2


def test_model_history_newest_first(spark):
    log = spark.createDataFrame([(1.0, dt.datetime(2024, 1, 1)), (2.0, dt.datetime(2024, 3, 1))],
                                "rmse double, run_at timestamp")
    assert [r["rmse"] for r in V.model_history(log).collect()] == [2.0, 1.0]
