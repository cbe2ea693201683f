import os

import pytest
from pyspark.sql import functions as F

from ordermart import schemas
from ordermart.sources import tables as TB
from ordermart.sources import text as TX

def test_replace_is_truncate_insert(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    assert TB.read_table(spark, path, schemas.KPI_SUMMARY).count() == 0           # empty frame with schema
    TB.replace_table(spark.createDataFrame([("a", 1.0), ("b", 2.0)], schemas.KPI_SUMMARY), path)
    out = TB.replace_table(spark.createDataFrame([("c", 3.0)], schemas.KPI_SUMMARY), path, ["metric_name"])
    assert [r["metric_name"] for r in out.collect()] == ["c"]
    assert all(f.startswith(("part-", "_SUCCESS", ".")) for f in os.listdir(path))      # a plain folder
    rows = spark.createDataFrame([("c", 3.0), ("c", 4.0)], schemas.KPI_SUMMARY)
    with pytest.raises(ValueError):
        TB.replace_table(rows, path, ["metric_name"])
    assert TB.read_table(spark, path, schemas.KPI_SUMMARY).count() == 1           # the old content stays


MONTHS = "seller_id string, year_month string, v double"
KEYS = ["seller_id", "year_month"]


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upsert_insert_update_unchanged_and_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "u")
    TB.upsert_table(spark.createDataFrame([("S1", "2023-01", 1.0), ("S1", "2023-02", 2.0), ("S2", "2023-02", 9.0)], MONTHS),
                    path, KEYS, "year_month")                                     # insert into nothing
    before = _files(path)
    batch = spark.createDataFrame([("S1", "2023-02", 5.0), ("S2", "2023-03", 7.0)], MONTHS)
    want = {("S1", "2023-01"): 1.0, ("S1", "2023-02"): 5.0, ("S2", "2023-02"): 9.0, ("S2", "2023-03"): 7.0}
    for _ in range(2):
        out = TB.upsert_table(batch, path, KEYS, "year_month")
        assert out.columns == ["seller_id", "year_month", "v"] and dict(out.dtypes)["year_month"] == "string"
        assert {(r[0], r[1]): r[2] for r in out.collect()} == want
    after = _files(path)
    old = [f for f in before if "2023-01" in f]
    assert old and all(after[f] == before[f] for f in old)                        # an untouched month is not rewritten
    assert not any(f in after for f in before if "2023-02" in f)
    assert TB.upsert_table(batch.limit(0), path, KEYS, "year_month").count() == 4


def test_upsert_reads_touched_months_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    rows = [(f"S{i}", f"2023-{m:02d}", 1.0) for i in range(5) for m in range(1, 13)]
    TB.replace_table(spark.createDataFrame(rows, MONTHS), path, KEYS, "year_month")
    plan = TB.read_table(spark, path, spark.createDataFrame([], MONTHS).schema).where("year_month in ('2023-03')")
    assert "PartitionFilters: [isnotnull(year_month" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [[("S1", "2023-01", 1.0), ("S1", "2023-01", 2.0)], [("S1", None, 1.0)], [(None, "2023-01", 1.0)]])
def test_upsert_rejects_repeated_and_incomplete_keys(spark, tmp_dir, rows):
    with pytest.raises(ValueError):
        TB.upsert_table(spark.createDataFrame(rows, MONTHS), os.path.join(tmp_dir, "d"), KEYS, "year_month")


def test_upsert_partitions_by_a_key_column(spark, tmp_dir):
    with pytest.raises(ValueError):
        TB.upsert_table(spark.createDataFrame([("a", "b", 1.0)], MONTHS), os.path.join(tmp_dir, "d"), KEYS, "v")


def test_database_upsert_is_one_statement():
    assert TB.upsert_statement("m", "m_staging", ["seller_id", "year_month", "v"], KEYS) == (
        "INSERT INTO m (seller_id, year_month, v) SELECT seller_id, year_month, v FROM m_staging "
        "ON CONFLICT (seller_id, year_month) DO UPDATE SET v = EXCLUDED.v")
    assert TB.upsert_statement("m", "s", ["k"], ["k"]).endswith("DO NOTHING")


def test_append_log_and_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "runs")
    assert TB.read_log(spark, path, schemas.PIPELINE_RUNS).count() == 0
    TB.append_log(spark, path, [{"step": "clean", "status": "success", "rows_in": 10, "rows_out": 8,
                                 "duration_seconds": 1.5}], schemas.PIPELINE_RUNS)
    TB.append_log(spark, path, [{"step": "analytics", "status": "failed", "rows_in": 0, "rows_out": 0,
                                 "duration_seconds": 0.1}], schemas.PIPELINE_RUNS)
    rows = TB.read_log(spark, path, schemas.PIPELINE_RUNS).collect()
    assert sorted(r["step"] for r in rows) == ["analytics", "clean"]
    assert all(r["run_at"] is not None for r in rows)


def test_serving_read_fallbacks(spark, tmp_dir):
    empty = TB.serving_read(spark, "revenue_by_category", schemas.REVENUE_BY_CATEGORY,
                            parquet_root=tmp_dir, jdbc_options={"url": "jdbc:none://nowhere"})
    assert empty.count() == 0 and empty.columns == [f.name for f in schemas.REVENUE_BY_CATEGORY.fields]
    df = spark.createDataFrame([("books", 1.0, 1, 1.0)], schemas.REVENUE_BY_CATEGORY)
    TB.write_mart(df, tmp_dir, "revenue_by_category")
    assert TB.serving_read(spark, "revenue_by_category", schemas.REVENUE_BY_CATEGORY, tmp_dir).count() == 1


def test_text_roundtrips(spark, tmp_dir):
    df = spark.createDataFrame([("S1", "2023-01", "revenue_drop", 10.0, 7.0, 30.0)], schemas.SELLER_ALERTS)
    csv = TX.write_csv(df, os.path.join(tmp_dir, "csv"), header=True, single_file=True)
    assert len([f for f in os.listdir(csv) if f.endswith(".csv")]) == 1
    assert TX.read_csv(spark, csv, schemas.SELLER_ALERTS).collect() == df.collect()
    tsv = TX.write_tsv(df, os.path.join(tmp_dir, "tsv"))
    assert TX.read_tsv(spark, tsv, schemas.SELLER_ALERTS).collect() == df.collect()
    js = TX.write_jsonl(df, os.path.join(tmp_dir, "js"))
    assert TX.read_jsonl(spark, js, schemas.SELLER_ALERTS).collect() == df.collect()


def test_single_file_csv_is_the_callers_choice(spark, tmp_dir):
    df = spark.range(10, numPartitions=4).select(F.col("id").cast("string").alias("x"))
    for single, files in ((True, 1), (False, 4)):
        out = TX.write_csv(df, os.path.join(tmp_dir, f"csv{single}"), single_file=single)
        assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == files
        assert spark.read.csv(out, header=True).count() == 10


def test_serving_read_needs_no_success_marker(spark, tmp_dir):
    df = spark.createDataFrame([("books", 1.0, 1, 1.0)], schemas.REVENUE_BY_CATEGORY)
    path = TB.write_mart(df, tmp_dir, "revenue_by_category")
    os.remove(os.path.join(path, "_SUCCESS"))
    assert TB.serving_read(spark, "revenue_by_category", schemas.REVENUE_BY_CATEGORY, tmp_dir).count() == 1


def test_shuffle_sizing(spark, tmp_dir):
    from ordermart.session import input_bytes, size_shuffles_for, suggest_shuffle_partitions
    assert suggest_shuffle_partitions(0) == 8
    assert suggest_shuffle_partitions(100 * (1 << 40)) == 200_000          # 100 TB -> capped
    assert suggest_shuffle_partitions(3 * 128 * (1 << 20) * 1000) == 1000
    spark.range(100).write.mode("overwrite").parquet(os.path.join(tmp_dir, "p"))
    assert input_bytes(spark, os.path.join(tmp_dir, "p")) > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffles_for(spark, os.path.join(tmp_dir, "p"), minimum=1) == int(before)  # never lowers
