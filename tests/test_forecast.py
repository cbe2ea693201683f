import numpy as np
import pytest

from ordermart.config import ForecastParams
from ordermart.constants import FEATURE_COLUMNS, LABEL_COLUMN
from ordermart.operators import forecast as M


def _features(spark, n=240, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, len(FEATURE_COLUMNS))) * rng.uniform(1, 50, len(FEATURE_COLUMNS))
    w = rng.normal(size=len(FEATURE_COLUMNS))
    y = X @ w + 1000 + rng.normal(scale=5, size=n)
    years = np.where(np.arange(n) < n * 3 // 4, 2022, 2023)
    rows = [tuple(float(v) for v in X[i]) + (float(y[i]), int(years[i]), "S001", f"{years[i]}-01")
            for i in range(n)]
    cols = [f"{c} double" for c in FEATURE_COLUMNS] + [f"{LABEL_COLUMN} double", "year int",
                                                       "seller_id string", "year_month string"]
    return spark.createDataFrame(rows, ", ".join(cols)), X, y, years


def test_ridge_matches_closed_form(spark):
    df, X, y, years = _features(spark)
    p = ForecastParams(split_year=2023, reg_param=0.1)
    run = M.fit_forecast(df, p)
    train = years < 2023
    Xt, yt = X[train], y[train]
    # scaler: centred, sample std (fitted on the training years)
    Z0 = (Xt - Xt.mean(0)) / Xt.std(0, ddof=1)
    # normal-equation solver: standardised features/label (population std), lambda / sigma_y
    sz, sy = Z0.std(0), yt.std()
    Zs, ys = (Z0 - Z0.mean(0)) / sz, (yt - yt.mean()) / sy
    n = len(yt)
    lam = p.reg_param / sy
    ws = np.linalg.solve(Zs.T @ Zs / n + lam * np.eye(Zs.shape[1]), Zs.T @ ys / n)
    w = ws * sy / sz
    got = np.array([c for _, c in M.coefficients(run.model)])
    assert np.allclose(got, w, rtol=1e-6, atol=1e-8)


def test_metrics_and_predictions(spark):
    df, *_ = _features(spark)
    run = M.fit_forecast(df, ForecastParams(split_year=2023))
    m = M.forecast_metrics(run).first()
    assert m["n_train"] + m["n_test"] == 240 and m["n_test"] == 60
    assert m["r2"] > 0.9 and m["rmse"] > 0 and m["mae"] <= m["rmse"]
    preds = M.seller_predictions(run)
    assert preds.count() == 60 and preds.columns == ["seller_id", "year_month", "actual_revenue",
                                                     "predicted_revenue"]
    row = M.model_metrics_row(M.forecast_metrics(run)).first()
    assert row["feature_json"].startswith('["month"') and row["run_at"] is not None


def test_scaler_fit_on_all_variant_and_save_load(spark, tmp_dir):
    df, *_ = _features(spark)
    run = M.fit_forecast(df, ForecastParams(split_year=2023, scaler_fit_on="all"))
    path = M.save_model(run.model, tmp_dir + "/model")
    again = M.load_model(path)
    a = run.model.transform(run.test).select("predicted_revenue").collect()
    b = again.transform(run.test).select("predicted_revenue").collect()
    assert a == b


def test_feature_prep_rules(spark):
    rows = [("high_performer", None, 1.0), ("average_seller", 2.0, 1.0), ("low_performer", 3.0, None),
            (None, 4.0, 2.0)]
    df = spark.createDataFrame(rows, f"seller_type string, lag1_revenue double, {LABEL_COLUMN} double")
    enc = M.fill_feature_nulls(M.encode_seller_tier(df).select(
        "seller_type", "seller_type_enc", "lag1_revenue", LABEL_COLUMN, *[
            __import__("pyspark.sql.functions", fromlist=["lit"]).lit(0.0).alias(c)
            for c in ("lag2_revenue", "lag3_revenue", "revenue_ma3", "growth_rate", "cancel_rate")]))
    got = {r["seller_type"]: r for r in enc.collect()}
    assert got["high_performer"]["seller_type_enc"] == 2.0 and got["high_performer"]["lag1_revenue"] == 0.0
    assert got["average_seller"]["seller_type_enc"] == 1.0
    assert got[None]["seller_type_enc"] == 0.0
    labelled = enc.filter(f"{LABEL_COLUMN} IS NOT NULL")
    assert labelled.count() == 3


def test_empty_training_split_is_reported(spark):
    import pytest
    df, *_ = _features(spark)
    with pytest.raises(ValueError):
        M.fit_forecast(df, ForecastParams(split_year=1900))
