"""User-level jobs on explicit locations (feeds written from the sf0.001 orders)."""

import os

from ordermart import schemas
from ordermart.config import FIXTURE
from ordermart.plans import jobs
from ordermart.sources import feeds
from ordermart.sources.tables import read_log
from tests.conftest import SF_SMALL


def test_clean_analytics_forecast_jobs(spark, tmp_dir):
    feeds_root = feeds.write_feeds(feeds.fixture_raw(spark.read.parquet(f"{SF_SMALL}/orders.parquet")),
                                   os.path.join(tmp_dir, "raw"))
    assert {"source=app", "source=web"} <= set(os.listdir(feeds_root))
    log = os.path.join(tmp_dir, "pipeline_runs")

    before = spark.conf.get("spark.sql.shuffle.partitions")
    clean = jobs.run_clean(spark, feeds_root, os.path.join(tmp_dir, "out"), FIXTURE, log_path=log)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before     # the caller's setting is put back
    assert clean["rows_in"] == 1530 and clean["rows_out"] == 1086
    assert sum(clean["malformed"].values()) == 6 and spark.read.json(clean["quarantine"]).count() == 6
    assert spark.read.parquet(clean["processed"]).count() == 1086
    assert spark.read.json(clean["jsonl"]).count() == 1086
    assert sorted(d for d in os.listdir(clean["processed"]) if d.startswith("data_source=")) == \
        ["data_source=app", "data_source=web"]

    serving = os.path.join(tmp_dir, "serving")
    marts = jobs.run_analytics(spark, clean["processed"], os.path.join(tmp_dir, "marts"), FIXTURE, log_path=log,
                               serving_root=serving)
    assert marts["rows"]["seller_monthly"] == 711
    assert marts["rows"]["seller_alerts"] == 192
    assert marts["rows"]["monthly_trend"] == 60
    assert marts["rows"]["kpi_summary"] == 6 and marts["rows"]["top_products"] == 10

    again = jobs.publish_serving(spark, marts["paths"], serving)          # second refresh: same content
    for name, path in again.items():
        assert spark.read.parquet(path).count() == marts["rows"][name]

    fc = jobs.run_forecast(spark, marts["paths"]["seller_monthly"], os.path.join(tmp_dir, "model"), FIXTURE,
                           log_path=log)
    assert fc["metrics"]["n_test"] > 0 and fc["metrics"]["feature_json"].startswith("[")
    assert spark.read.parquet(fc["predictions"]).count() == fc["metrics"]["n_test"]

    bench = jobs.run_benchmark(spark, clean["processed"], os.path.join(tmp_dir, "bench"), runs=3,
                               jsonl_path=clean["jsonl"])
    assert set(bench) == {"sql_revenue_by_category", "sql_monthly_orders", "sql_top_products",
                          "mr_category_sum", "mr_month_sum_count", "mr_ranked_products"}
    assert all(v["min"] > 0 and v["jobs"] >= 1 for v in bench.values())
    assert spark.read.parquet(os.path.join(tmp_dir, "bench", "benchmark_results")).count() == 6

    runs = {r["step"]: r for r in read_log(spark, log, schemas.PIPELINE_RUNS).collect()}
    assert set(runs) == {"clean", "analytics", "train"}
    assert runs["clean"]["status"] == "success" and runs["clean"]["rows_out"] == 1086


def test_clean_reads_feeds_that_grew(spark, tmp_dir):
    raw = feeds.fixture_raw(spark.read.parquet(f"{SF_SMALL}/orders.parquet"))
    root = os.path.join(tmp_dir, "raw")
    half = "order_id % 2 = 0"
    feeds.write_feeds(raw.where(half), root)
    first = jobs.run_clean(spark, root, os.path.join(tmp_dir, "a"), FIXTURE, jsonl_export=False)
    feeds.feed_lines(raw.where(f"NOT ({half})")).write.mode("append").partitionBy("source").text(root)
    again = jobs.run_clean(spark, root, os.path.join(tmp_dir, "b"), FIXTURE, jsonl_export=False)
    assert 0 < first["rows_in"] < 1530
    assert (again["rows_in"], again["rows_out"]) == (1530, 1086)
