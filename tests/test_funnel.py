"""Broken feed lines, the one-pass stage counts and the comparable dedup key."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermart import schemas
from ordermart.operators import cleaning as C
from ordermart.plans import catalog
from ordermart.plans.clean import OrderPipeline
from ordermart.sources import feeds
from tests.conftest import SF_SMALL

STAGES = ["parsed_app", "parsed_web", "union", "dedup", "window_filter", "outliers", "enriched"]
ORDER = ("order_id string, seller_id string, status string, customer_id string, region string, "
         "total_amount double, order_ts timestamp_ntz, order_date date, data_source string")


@pytest.fixture(scope="module")
def pipe(spark):
    p = catalog._p(spark, SF_SMALL)
    p.bounds()
    return p


def counts(df):
    return {r.stage: r.n_rows for r in df.collect()}


def stage_by_stage(p):
    frames = [p.parsed_app(), p.parsed_web(), p.combined(), p.deduped(), p.valid(), p.clean(), p.enriched()]
    return dict(zip(STAGES, (df.count() for df in frames)))


def test_funnel_counts_what_the_stages_return(pipe):
    assert counts(pipe.funnel()) == stage_by_stage(pipe)


def test_funnel_reads_each_feed_once_in_few_jobs(spark, pipe):
    df = pipe.funnel()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 2
    assert plan.count("Exchange hashpartitioning") == 1
    group = "funnel-jobs"
    spark.sparkContext.setJobGroup(group, group)
    df.write.format("noop").mode("overwrite").save()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 4                           # two shuffles, the broadcast, the result


@pytest.mark.parametrize("stage, broken", [
    ("window_filter", "in_valid_window"), ("outliers", "within_bounds"), ("dedup", "dedup"), ("enriched", "enrich")])
def test_a_broken_stage_moves_its_count(pipe, monkeypatch, stage, broken):
    want = counts(pipe.funnel())
    if broken == "in_valid_window":
        monkeypatch.setattr(C, "in_valid_window", lambda a, b: F.col("total_amount") > 0)
    elif broken == "within_bounds":
        monkeypatch.setattr(C, "within_bounds", lambda a, b: F.col("total_amount") < 1000)
    elif broken == "enrich":                        # a dimension with a repeated key multiplies rows
        monkeypatch.setattr(OrderPipeline, "sellers", lambda self: C.seller_dim(self.spark).union(C.seller_dim(self.spark, 3)))
    else:
        monkeypatch.setattr(OrderPipeline, "combined", lambda self: C.union_sources(
            self.parsed_app(), self.parsed_web().withColumn("order_id", F.concat("order_id", F.col("order_ts").cast("string")))))
    got = counts(pipe.funnel())
    assert got[stage] != want[stage]
    before = STAGES[:STAGES.index(stage)]
    assert {s: got[s] for s in before} == {s: want[s] for s in before}


def test_funnel_of_nothing(spark, pipe):
    none = spark.createDataFrame([], ORDER)
    got = C.stage_funnel(none, C.seller_dim(spark), "1996-01-01", "2000-12-31", None, None, 200)
    assert counts(got) == dict.fromkeys(STAGES, 0)


def test_dedup_key_orders_as_the_window_does(spark):
    rng = random.Random(4)
    t0 = dt.datetime(2023, 5, 1)
    pick = lambda *v: rng.choice(v)
    rows = [(str(rng.randrange(60)), pick("S1", "S2", None), pick("a", "b", None), pick("c", None), pick("n", None),
             pick(None, 1.5, -2.0, float("nan"), 0.0, float("inf")), pick(None, t0, t0 + dt.timedelta(microseconds=1),
                                                                       dt.datetime(1950, 1, 1)), None, pick("app", "web"))
            for _ in range(900)]
    df = spark.createDataFrame(rows, ORDER)
    w = Window.partitionBy("order_id").orderBy(*C.dedup_order())
    first = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    least = df.groupBy("order_id").agg(F.min_by(F.struct(*df.columns), C.dedup_key()).alias("x")).select("x.*")
    assert sorted(map(repr, first.collect())) == sorted(map(repr, least.collect()))


def test_broken_lines_are_kept_apart(spark, tmp_dir):
    lines = {"app": [json.dumps({"oid": "1", "ts": 1682935200, "tot": 12.5}), '{"oid": "2", "ts": 168', "no json",
                     json.dumps({"oid": "3", "_dup": "maybe"}), json.dumps({"ts": 5, "tot": 1}), ""],
             "web": [json.dumps({"order_id": "4", "metadata": {"_retry": "x"}}), json.dumps({"order_id": "5", "metadata": None})]}
    for name, rows in lines.items():
        os.makedirs(os.path.join(tmp_dir, f"source={name}"))
        with open(os.path.join(tmp_dir, f"source={name}", "a.json"), "w") as f:
            f.writelines(r + "\n" for r in rows)
    app, web = feeds.read_app_feed(spark, tmp_dir), feeds.read_web_feed(spark, tmp_dir)
    assert {r.data_source: r[:3] for r in C.feed_quality(app, web).select(
        "n_sound", "n_malformed", "n_without_id", "data_source").collect()} == {"app": (2, 3, 1), "web": (1, 1, 0)}
    kept = C.malformed_lines(app, web).collect()
    assert sorted((r.data_source, r.line) for r in kept) == sorted(
        [("app", lines["app"][1]), ("app", "no json"), ("app", lines["app"][3]), ("web", lines["web"][0])])
    assert {r.file for r in kept} == {"a.json"} and C.malformed_lines(app, web).columns == [f.name for f in schemas.MALFORMED]
    assert sorted(str(r.order_id) for r in C.parse_app(app).collect()) == ["1", "None"]
    assert [r.order_id for r in C.parse_web(web).collect()] == ["5"]


def test_sums_keep_fractions_of_a_cent(spark):
    from ordermart.functions import money_avg, money_sum
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert df.agg(money_sum("x").alias("s"), money_avg("x", 4).alias("a")).first() == (4.0, 0.004)


def test_older_layout_and_cut_lines_do_not_change_the_tasks(spark, pipe):
    from ordermart.operators import text_tasks as T
    lines = T.older_layout(pipe.processed())
    assert lines.count() > pipe.processed().count()
    missing = catalog.QUERIES["month_key_fallback"](spark, SF_SMALL).agg(F.sum("n_from_order_date")).first()[0]
    assert missing > 0
