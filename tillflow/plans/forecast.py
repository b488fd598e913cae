"""Daily revenue forecast: dense daily series, calendar features, OLS on one-hot
weekday and month, 30-day holdout, training-mean baseline, 31-day forecast.

The scalable part is fact -> daily revenue (a partial aggregate); the series
then has one row per calendar day, so its size is bounded by the time span.
The model is `pyspark.ml` LinearRegression with the normal-equation solver.

Design (see SURVEY H9): full one-hot blocks plus the weekend flag are
collinear; the fitted values are the same for the reduced full-rank design
used here: intercept + weekday dummies (Sunday as base) + month dummies
(January as base), dummies only for categories present in the training
rows. The weekend flag stays in the feature table. A category never seen in
training gets the base effect (zeros), as with an encoder that ignores
unknown categories.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import money_out, round_double, to_units, units_out
from tillflow.plans.warehouse import Star

# Holdout length, forecast horizon, MAPE denominator floor.
TEST_DAYS = 30
HORIZON_DAYS = 31
MAPE_EPS = 2.220446049250313e-16
MODEL_NAME = "regressao_linear"
BASELINE_NAME = "baseline_media_historica"


def daily_revenue(fact: DataFrame) -> DataFrame:
    """revenue per sale day (exact decimal)."""
    return fact.groupBy(F.col("Data_Venda").alias("data")).agg(F.sum("Faturamento").alias("_fat"))


def daily_dense(fact: DataFrame) -> DataFrame:
    """one row per day between the first and last sale; missing days are 0.

    `faturamento` is the exact daily sum as DOUBLE (the model's label); the
    exact decimal stays alongside as `_fat` for exact totals.
    """
    daily = daily_revenue(fact)
    calendar = daily.agg(F.min("data").alias("a"), F.max("data").alias("b")) \
        .select(F.explode(F.sequence("a", "b")).alias("data"))
    exact = F.coalesce("_fat", F.lit(0).cast("decimal(28,2)"))
    return calendar.join(daily, "data", "left").select(
        "data", money_out(exact).alias("faturamento"), exact.alias("_fat"))


def calendar_features(df: DataFrame, date_col: str = "data") -> DataFrame:
    """weekday (Mon=0) and month as category text, weekend flag (Sat/Sun = 1)."""
    d = F.col(date_col)
    return df.withColumns({
        "dia_semana": F.weekday(d).cast("string"),
        "mes": F.month(d).cast("string"),
        "fim_de_semana": (F.weekday(d) >= 5).cast("int"),
    })


def split(features: DataFrame, test_days: int = TEST_DAYS) -> tuple[DataFrame, DataFrame]:
    """chronological split; the dense series' last `test_days` days are the test set."""
    last = features.agg(F.max("data")).scalar()
    is_test = F.col("data") > F.date_sub(last, test_days)
    return features.where(~is_test), features.where(is_test)


@dataclass
class Fitted:
    model: LinearRegressionModel
    weekdays: list[int]
    months: list[int]

    def predict(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(_design(df, self.weekdays, self.months))
        return out.withColumnRenamed("prediction", "faturamento_previsto").drop("features")


def _dummies(df: DataFrame, weekdays: list[int], months: list[int]) -> list[str]:
    return [f"_d{w}" for w in weekdays] + [f"_m{m}" for m in months]


def _design(df: DataFrame, weekdays: list[int], months: list[int]) -> DataFrame:
    cols = {f"_d{w}": (F.col("dia_semana") == str(w)).cast("double") for w in weekdays}
    cols.update({f"_m{m}": (F.col("mes") == str(m)).cast("double") for m in months})
    with_cols = df.withColumns(cols) if cols else df
    names = _dummies(df, weekdays, months)
    if not names:
        with_cols = with_cols.withColumn("_zero", F.lit(0.0))
        names = ["_zero"]
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(with_cols)
    return assembled.drop(*names)


def fit(train: DataFrame) -> Fitted:
    """F5 + F6: one-hot design and OLS (normal equations)."""
    seen = train.agg(F.collect_set(F.weekday("data")).alias("w"),
                     F.collect_set(F.month("data")).alias("m")).first()  # at most 7 + 12 values
    weekdays = sorted(w for w in seen["w"] if w != 6)   # Sunday is the base weekday
    months = sorted(m for m in seen["m"] if m != 1)     # January is the base month
    lr = LinearRegression(featuresCol="features", labelCol="faturamento", solver="normal",
                          regParam=0.0, elasticNetParam=0.0, fitIntercept=True, standardization=False)
    model = lr.fit(_design(train, weekdays, months))
    return Fitted(model, weekdays, months)


def _relative_error(y: Column, p: Column) -> Column:
    """Mean of |y - p| / max(|y|, epsilon). Days without revenue divide by epsilon and
    dwarf the others, so their part is summed exactly, in cents."""
    rest = F.sum(F.when(y != 0, F.abs(y - p) / F.greatest(F.abs(y), F.lit(MAPE_EPS))))
    none = F.sum(F.when(y == 0, F.round(F.abs(p), 2).cast("decimal(28,2)"))).cast("double") / F.lit(MAPE_EPS)
    return (F.coalesce(none, F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))) / F.count(y)


def regression_metrics(pred: DataFrame, actual: DataFrame, y: str = "faturamento",
                       p: str = "faturamento_previsto") -> DataFrame:
    """F8: MAE, RMSE, MAPE x 100 (denominator floored at machine epsilon) and R², rounded 2/2/2/3.

    `actual` holds the same test rows before prediction; the mean of the
    actual values (for R²) is a scalar subquery over it.
    """
    mean_y = actual.agg(F.avg(y)).scalar()
    err = F.col(y) - F.col(p)
    g = pred.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (_relative_error(F.col(y), F.col(p)) * 100).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(err * err), F.sum((F.col(y) - mean_y) * (F.col(y) - mean_y))))
        .alias("r2"))
    return g.select(round_double("mae", 2).alias("mae"), round_double("rmse", 2).alias("rmse"),
                    round_double("mape", 2).alias("mape"), round_double("r2", 3).alias("r2"))


def _train_mean(train: DataFrame) -> Column:
    """Training mean from the exact decimal sum (same IEEE steps in any engine)."""
    g = train.agg(F.sum(to_units(F.col("_fat"), 2)).alias("_u"), F.count(F.lit(1)).alias("_n"))
    return g.select(units_out(F.col("_u"), 2) / F.col("_n")).scalar()


def _series(s: Star) -> DataFrame:
    """Dense daily series with calendar features, checkpointed once per star.

    One row per calendar day (bounded by the time span); the split, the fits,
    the baseline and the metrics all read it, so it is pinned instead of being
    re-aggregated from the fact in every subquery.
    """
    if "daily_series" not in s.memo:
        s.memo["daily_series"] = calendar_features(daily_dense(s.fact)).checkpoint(eager=True)
    return s.memo["daily_series"]


def daily_revenue_dense(s: Star) -> DataFrame:
    """F2 as a query."""
    return _series(s).select("data", "faturamento")


def calendar_feature_table(s: Star) -> DataFrame:
    """F3 as a query."""
    return _series(s).select("data", "faturamento", "dia_semana", "mes", "fim_de_semana")


def train_test_split(s: Star) -> DataFrame:
    """F4 as a query: every day tagged treino / teste."""
    train, test = split(_series(s))
    return train.withColumn("conjunto", F.lit("treino")).unionByName(
        test.withColumn("conjunto", F.lit("teste"))).select("data", "faturamento", "conjunto")


def split_summary(s: Star) -> DataFrame:
    """first day, last day and length of the training and test periods."""
    tagged = train_test_split(s)
    return tagged.groupBy("conjunto").agg(F.min("data").alias("inicio"), F.max("data").alias("fim"),
                                          F.count(F.lit(1)).alias("dias"))


def forecast_holdout(s: Star) -> DataFrame:
    """F6 + F7: model fitted on the training days, actual vs predicted on the test days."""
    train, test = split(_series(s))
    return fit(train).predict(test).select(
        "data", "faturamento", round_double("faturamento_previsto", 2).alias("faturamento_previsto"))


def baseline_metrics(s: Star) -> DataFrame:
    """metrics of the constant training-mean forecast on the test days."""
    train, test = split(_series(s))
    pred = test.select("data", "faturamento", _train_mean(train).alias("faturamento_previsto"))
    return regression_metrics(pred, test).select(F.lit(BASELINE_NAME).alias("modelo"), "*")


def forecast_metrics(s: Star) -> DataFrame:
    """F8 + F10: the two-row metrics table (model, baseline)."""
    train, test = split(_series(s))
    pred = fit(train).predict(test)
    model = regression_metrics(pred, test).select(F.lit(MODEL_NAME).alias("modelo"), "*")
    return model.unionByName(baseline_metrics(s))


def predict_ahead(s: Star, horizon: int = HORIZON_DAYS) -> DataFrame:
    """F11 + F12: refit on the full history, predict the next `horizon` days, clipped at 0."""
    series = _series(s)
    fitted = fit(series)
    future = series.agg(F.max("data").alias("last")).select(
        F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))).alias("data"))
    pred = fitted.predict(calendar_features(future))
    return pred.select("data", F.greatest(F.col("faturamento_previsto"), F.lit(0.0))
                       .alias("faturamento_previsto"))


def forecast_next_month(s: Star) -> DataFrame:
    """F11 + F12 as a query: the next 31 days, in cents."""
    return predict_ahead(s).select("data", round_double("faturamento_previsto", 2).alias("faturamento_previsto"))


def forecast_total(s: Star) -> DataFrame:
    """total forecast revenue of the horizon, in cents."""
    return predict_ahead(s).agg(round_double(F.sum("faturamento_previsto"), 2).alias("faturamento_previsto_total"))


def mean_month_revenue(s: Star) -> DataFrame:
    """mean over calendar months of the monthly revenue of the dense daily series."""
    monthly = _series(s).groupBy(F.trunc("data", "month").alias("mes")).agg(
        F.sum(to_units(F.col("_fat"), 2)).alias("_u"))
    return monthly.agg(units_out(F.sum("_u"), 2).alias("_t"), F.count(F.lit(1)).alias("meses")) \
        .select((F.col("_t") / F.col("meses")).alias("media_mensal"), "meses")


def monthly_history(s: Star) -> DataFrame:
    """monthly revenue of the whole history with its 3-month rolling mean
    (the dashboard's monthly series without any selection)."""
    from tillflow.plans.kpis import KpiParams, resample
    return resample(s, KpiParams(), "MS")
