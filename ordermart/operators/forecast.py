"""Next-month revenue regression on the seller-month features (Spark ML).

Assembler -> standard scaler (mean and sample std) -> ridge linear regression.
With elasticNet 0 and ``solver="auto"`` Spark uses the normal-equation solver: one
distributed pass builds the 12x12 Gram matrix (tree aggregation), so training cost
grows with rows only linearly and nothing is collected but the small matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.config import ForecastParams
from ordermart.constants import FEATURE_COLUMNS, LABEL_COLUMN, TIER_CODES
from ordermart.functions import ratio, round_half_up

FILL_ZERO = ("lag1_revenue", "lag2_revenue", "lag3_revenue", "revenue_ma3", "growth_rate", "cancel_rate")


def encode_seller_tier(df: DataFrame) -> DataFrame:
    expr = None
    for name, code in TIER_CODES:
        cond = F.col("seller_type") == name
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return df.withColumn("seller_type_enc", expr.otherwise(F.lit(0.0)))


def fill_feature_nulls(df: DataFrame) -> DataFrame:
    return df.fillna(0.0, subset=list(FILL_ZERO))


def labelled_rows(df: DataFrame) -> DataFrame:
    return (df.filter(F.col(LABEL_COLUMN).isNotNull())
              .na.drop(subset=list(FEATURE_COLUMNS) + [LABEL_COLUMN]))


def feature_frame(seller_monthly: DataFrame) -> DataFrame:
    return labelled_rows(fill_feature_nulls(encode_seller_tier(seller_monthly)))


def temporal_split(features: DataFrame, split_year: int) -> tuple[DataFrame, DataFrame]:
    return (features.filter(F.col("year") < split_year),
            features.filter(F.col("year") == split_year))


def split_counts(features: DataFrame, split_year: int) -> DataFrame:
    return features.agg(F.count(F.when(F.col("year") < split_year, 1)).alias("n_train"),
                        F.count(F.when(F.col("year") == split_year, 1)).alias("n_test"))


def _assembler():
    return VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features_raw", handleInvalid="skip")


def _scaler():
    return StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)


def _regression(p: ForecastParams):
    return LinearRegression(featuresCol="features", labelCol=LABEL_COLUMN, predictionCol="predicted_revenue",
                            maxIter=p.max_iter, regParam=p.reg_param, elasticNetParam=p.elastic_net)


def feature_scaling_stats(train: DataFrame) -> DataFrame:
    """Per feature: exact mean (decimal sum) and sample standard deviation; one scan."""
    aggs = []
    for c in FEATURE_COLUMNS:
        x = F.col(c)
        aggs.append(round_half_up(ratio(F.sum(x.cast("decimal(28,4)")), F.count(x)), 6).alias(f"{c}__mean"))
        aggs.append(round_half_up(F.stddev_samp(x.cast("double")), 4).alias(f"{c}__std"))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                              F.col(f"{c}__std").alias("std")) for c in FEATURE_COLUMNS])
    return train.agg(*aggs).select(F.explode(rows).alias("s")).select("s.*")


def gram_terms() -> list[tuple[str, str]]:
    """The pairs of the Gram matrix: intercept (``one``), features and label, each with each."""
    names = ["one", *FEATURE_COLUMNS, LABEL_COLUMN]
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def gram_matrix(rows: DataFrame) -> DataFrame:
    """(row_term, col_term, n, mean_product) of all ``gram_terms``, summed exactly in one scan: all
    that the normal equations of the regression need, whatever the number of rows."""
    def term(name):
        return (F.lit(1) if name == "one" else F.col(name)).cast("decimal(18,4)")
    pairs = gram_terms()
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(term(a) * term(b)).alias(f"{a}*{b}") for a, b in pairs])
    out = F.array(*[F.struct(F.lit(a).alias("row_term"), F.lit(b).alias("col_term"), F.col("n"), round_half_up(
        ratio(F.col(f"`{a}*{b}`"), F.col("n")), 2).alias("mean_product")) for a, b in pairs])
    return sums.select(F.explode(out).alias("x")).select("x.*")


@dataclass
class ForecastRun:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    test_predictions: DataFrame
    train_predictions: DataFrame


def fit_forecast(features: DataFrame, p: ForecastParams) -> ForecastRun:
    train, test = temporal_split(features, p.split_year)
    if not train.limit(1).collect():
        raise ValueError(f"no labelled seller-months before split year {p.split_year}")
    if p.scaler_fit_on == "all":                       # reference behaviour (stats leak the test year)
        prep = Pipeline(stages=[_assembler(), _scaler()]).fit(features)
        lr = _regression(p).fit(prep.transform(train))
        model = PipelineModel(stages=list(prep.stages) + [lr])
    else:
        model = Pipeline(stages=[_assembler(), _scaler(), _regression(p)]).fit(train)
    return ForecastRun(model, train, test, model.transform(test), model.transform(train))


def _metrics(prefix: str, cond, label: str, prediction: str) -> list:
    e = F.col(prediction) - F.col(label)
    y = F.col(label)
    n = F.count(F.when(cond, 1))
    sse = F.sum(F.when(cond, e * e))
    ss_tot = F.var_pop(F.when(cond, y)) * n         # numerically stable, unlike sum(y^2) - sum(y)^2 / n
    return [F.sqrt(ratio(sse, n)).alias(f"{prefix}rmse"),
            ratio(F.sum(F.when(cond, F.abs(e))), n).alias(f"{prefix}mae"),
            (F.lit(1.0) - ratio(sse, ss_tot)).alias(f"{prefix}r2"),
            n.alias(f"{prefix}n")]


def forecast_metrics(run: ForecastRun) -> DataFrame:
    """Test RMSE/MAE/R^2 and train RMSE from one pass over both prediction sets."""
    cols = ["seller_id", "year_month", LABEL_COLUMN, "predicted_revenue"]
    both = (run.test_predictions.select(*cols, F.lit(True).alias("_test"))
            .unionByName(run.train_predictions.select(*cols, F.lit(False).alias("_test"))))
    test, train = F.col("_test"), ~F.col("_test")
    return both.agg(*_metrics("", test, LABEL_COLUMN, "predicted_revenue"),
                    *_metrics("train_", train, LABEL_COLUMN, "predicted_revenue")).select(
        "rmse", "mae", "r2", "train_rmse", F.col("train_n").alias("n_train"), F.col("n").alias("n_test"))


def model_metrics_row(metrics: DataFrame) -> DataFrame:
    """Log row: rounding 4/4/6/4, JSON feature list, run timestamp."""
    return metrics.select(
        round_half_up(F.col("rmse"), 4).alias("rmse"), round_half_up(F.col("mae"), 4).alias("mae"),
        round_half_up(F.col("r2"), 6).alias("r2"), round_half_up(F.col("train_rmse"), 4).alias("train_rmse"), F.col("n_train").cast("long"),
        F.col("n_test").cast("long"),
        F.to_json(F.array(*[F.lit(c) for c in FEATURE_COLUMNS])).alias("feature_json"),
        F.current_timestamp().alias("run_at"))


def seller_predictions(run: ForecastRun) -> DataFrame:
    return (run.test_predictions.select(
                "seller_id", "year_month", F.col(LABEL_COLUMN).alias("actual_revenue"),
                round_half_up(F.col("predicted_revenue"), 2).alias("predicted_revenue"))
            .orderBy("seller_id", "year_month"))


def coefficients(model: PipelineModel) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return list(zip(FEATURE_COLUMNS, [float(v) for v in lr.coefficients]))


def residual_pct(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn(
        "residual_pct", ratio(F.col("predicted_revenue") - F.col("actual_revenue"), F.col("actual_revenue")) * 100)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
