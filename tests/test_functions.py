import hashlib

from pyspark.sql import functions as F

from ordermart.constants import CATEGORIES
from ordermart.functions import (
    category_bucket, normalize_status, parse_wall_clock, product_bucket, round_half_up,
    strip_tz_suffix,
)


def test_normalize_status_edge_cases(spark):
    rows = [(None,), ("Done",), ("PAID",), ("other",), ("COMPLETED",), ("REFUND",), ("cancel",),
            ("in_progress",), ("CANCELLED",), ("paid",)]
    df = spark.createDataFrame(rows, "s string").select("s", normalize_status(F.col("s")).alias("c"))
    got = {r["s"]: r["c"] for r in df.collect()}
    assert got[None] == "unknown"
    assert got["Done"] == "unknown"          # case-sensitive lists
    assert got["PAID"] == "unknown"
    assert got["other"] == "unknown"
    assert got["COMPLETED"] == "completed"
    assert got["REFUND"] == "returned"
    assert got["cancel"] == "cancelled"
    assert got["CANCELLED"] == "cancelled"
    assert got["in_progress"] == "pending"
    assert got["paid"] == "completed"


def test_normalize_status_case_insensitive_option(spark):
    df = spark.createDataFrame([("Done",), ("PAID",)], "s string")
    out = [r[0] for r in df.select(normalize_status(F.col("s"), case_insensitive=True)).collect()]
    assert out == ["completed", "completed"]


def test_strip_and_parse_timestamps(spark):
    rows = [("2023-05-01T10:00:00+07:00",), ("2023-05-01T10:00:00Z",), ("2023-05-01T10:00:00-05:00",),
            ("garbage",), (None,), ("2023-02-30T10:00:00",)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select("s", strip_tz_suffix(F.col("s")).alias("x")) \
            .select("s", "x", parse_wall_clock(F.col("x")).alias("ts")).collect()
    got = {r["s"]: (r["x"], r["ts"]) for r in out}
    assert got["2023-05-01T10:00:00+07:00"][0] == "2023-05-01T10:00:00"
    assert str(got["2023-05-01T10:00:00+07:00"][1]) == "2023-05-01 10:00:00"   # wall clock kept
    assert str(got["2023-05-01T10:00:00Z"][1]) == "2023-05-01 10:00:00"
    # a negative offset is not stripped by the reference pattern: it is applied (UTC session)
    assert got["2023-05-01T10:00:00-05:00"][0] == "2023-05-01T10:00:00-05:00"
    assert str(got["2023-05-01T10:00:00-05:00"][1]) == "2023-05-01 15:00:00"
    assert got["garbage"][1] is None
    assert got[None][1] is None
    assert got["2023-02-30T10:00:00"][1] is None


def test_strip_all_offsets_flag(spark):
    df = spark.createDataFrame([("2023-05-01T10:00:00-05:00",)], "s string")
    x = df.select(strip_tz_suffix(F.col("s"), all_offsets=True)).first()[0]
    assert x == "2023-05-01T10:00:00"


def test_round_half_up_on_decimal_image(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (-1.005,)], "x double")
    out = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert out == [1.01, 0.29, 2.68, -1.01]


def test_buckets_match_md5_rule(spark):
    ids = [f"S{i:03d}" for i in range(1, 201)] + ["", "12345"]
    df = spark.createDataFrame([(i,) for i in ids], "s string").select(
        "s", category_bucket(F.col("s")).alias("c"), product_bucket(F.col("s")).alias("p"))
    for r in df.collect():
        h = int(hashlib.md5(r["s"].encode()).hexdigest()[:8], 16)
        assert r["c"] == CATEGORIES[h % 10]
        assert r["p"] == f"P{h % 500 + 1:05d}"
