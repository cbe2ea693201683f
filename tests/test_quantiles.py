import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermart.operators.quantiles import approx_quantiles, exact_quantiles, iqr_bounds


def _frame(spark, xs, parts=4):
    return spark.createDataFrame([(float(x),) for x in xs], "x double").repartition(parts)


def _linear(xs, p):
    return float(np.percentile(np.array(xs, dtype=float), p * 100, method="linear"))


@pytest.mark.parametrize("xs", [
    [5.0],
    [1.0, 2.0],
    [3.0, 1.0, 2.0, 10.0],
    list(range(1000)),
])
def test_exact_matches_linear_interpolation(spark, xs):
    got = exact_quantiles(_frame(spark, xs), "x", [0.0, 0.25, 0.5, 0.75, 1.0])
    for p, g in zip([0.0, 0.25, 0.5, 0.75, 1.0], got):
        assert g == pytest.approx(_linear(xs, p), rel=0, abs=1e-9)


def test_exact_with_hot_value_and_outliers(spark):
    rng = np.random.default_rng(7)
    xs = list(np.round(rng.lognormal(10, 1, 3000), 2)) + [42.0] * 1500 + [1e9, 2e9]
    got = exact_quantiles(_frame(spark, xs, 8), "x", [0.25, 0.75], buckets=64, collect_limit=16)
    assert got[0] == pytest.approx(_linear(xs, 0.25), abs=1e-9)
    assert got[1] == pytest.approx(_linear(xs, 0.75), abs=1e-9)


def test_exact_ignores_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]
    df = spark.createDataFrame([(None,), (3.0,), (1.0,)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [2.0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60))
def test_exact_property_small_buckets(spark, ints):
    xs = [i / 4 for i in ints]
    got = exact_quantiles(_frame(spark, xs, 3), "x", [0.25, 0.75], buckets=4, collect_limit=2)
    assert got[0] == pytest.approx(_linear(xs, 0.25), abs=1e-9)
    assert got[1] == pytest.approx(_linear(xs, 0.75), abs=1e-9)


def test_approx_rank_error_bound(spark):
    xs = list(range(10000))
    q1, q3 = approx_quantiles(_frame(spark, xs), "x", [0.25, 0.75], 0.01)
    assert abs(q1 - 2500) <= 0.01 * 10000 + 1
    assert abs(q3 - 7500) <= 0.01 * 10000 + 1


def test_iqr_bounds_positive_only(spark):
    xs = [-100.0, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    b = iqr_bounds(_frame(spark, xs), "x", 3.0, "exact")
    pos = [1.0, 2.0, 3.0, 4.0, 5.0]
    q1, q3 = _linear(pos, 0.25), _linear(pos, 0.75)
    assert b["q1"] == q1 and b["q3"] == q3
    assert b["lower"] == q1 - 3 * (q3 - q1) and b["upper"] == q3 + 3 * (q3 - q1)


def test_bounds_on_empty_input(spark):
    df = spark.createDataFrame([(-1.0,), (None,)], "x double")
    for method in ("exact", "approx"):
        b = iqr_bounds(df, "x", 3.0, method)
        assert b["lower"] is None and b["upper"] is None


def test_exact_with_infinite_values(spark):
    xs = [float("-inf"), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, float("inf"), float("inf")]
    got = exact_quantiles(_frame(spark, xs), "x", [0.25, 0.5, 0.75])
    assert got == [2.0, 4.0, 6.0]          # integral positions: exact ranks, no interpolation
    lo, hi = exact_quantiles(_frame(spark, xs), "x", [0.0, 1.0])
    assert lo == float("-inf") and hi == float("inf")


def test_wrong_sketch_bracket_is_detected_and_recovered(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ordermart.operators import quantiles as Q

    def bad_sketch(col, probs, accuracy):          # brackets far away from every value
        return F.array(*[F.lit(1e9 + i) for i in range(len(probs))])

    monkeypatch.setattr(Q.F, "percentile_approx", bad_sketch)
    xs = [float(v) for v in range(101)]
    stats = {}
    got = Q.exact_quantiles(_frame(spark, xs), "x", [0.25, 0.75], buckets=8, collect_limit=2, stats=stats)
    assert got == [25.0, 75.0]
    assert stats["passes"] >= 2


def test_wrong_brackets_and_many_magnitudes_are_exact(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ordermart.operators import quantiles as Q
    xs = [float(v) for v in range(37)] + [5.0, 5.0, 30.0]
    wide = [2.0 ** e for e in range(-600, 600, 7)] + [0.0, 1e300]
    for data in (xs, wide):
        got = Q.exact_quantiles(_frame(spark, data), "x", [0.1, 0.25, 0.5, 0.75, 0.9], collect_limit=1, buckets=64)
        assert got == [_linear(data, p) for p in (0.1, 0.25, 0.5, 0.75, 0.9)]

    def bad_sketch(col, probs, accuracy):               # brackets that hold no wanted rank
        return F.array(*[F.lit(-1e9 - i) for i in range(len(probs))])

    monkeypatch.setattr(Q.F, "percentile_approx", bad_sketch)
    got = Q.exact_quantiles(_frame(spark, xs), "x", [0.25, 0.75])
    assert got == [_linear(xs, 0.25), _linear(xs, 0.75)]
