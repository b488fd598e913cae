import datetime as dt

import numpy as np
import pytest

from tillflow.plans import forecast

# A 30-day holdout (actual, predicted) and its published metrics.
HOLDOUT = [
    (85839.39, 82221.75837694977), (59076.439999999995, 85321.71667996884),
    (72633.72, 84300.06662620638), (67807.19, 86403.25180464545),
    (119673.24, 87344.00393031149), (65270.14, 91057.78685323671),
    (131401.24, 87736.98360389883), (57757.05, 82221.75837694977),
    (63945.47, 85321.71667996884), (86544.72, 84300.06662620638),
    (113960.52, 86403.25180464545), (89656.56, 87344.00393031149),
    (78165.4, 91057.78685323671), (90275.39, 87736.98360389883),
    (103983.34, 82221.75837694977), (112070.87, 85321.71667996884),
    (84733.81, 84300.06662620638), (91929.70999999999, 86403.25180464545),
    (102211.51, 87344.00393031149), (72483.96, 91057.78685323671),
    (117752.85, 87736.98360389883), (83093.92, 82221.75837694977),
    (71060.89, 85321.71667996884), (94240.95, 84300.06662620638),
    (102375.95, 86403.25180464545), (83715.36, 87344.00393031149),
    (51337.84, 91057.78685323671), (51136.09, 87736.98360389883),
    (56028.28, 82221.75837694977), (74247.95, 85321.71667996884),
]
HOLDOUT_METRICS = (17716.14, 21434.05, 23.18, -0.023)


def test_metrics_match_published_holdout(spark):
    start = dt.date(2025, 12, 2)
    rows = [(start + dt.timedelta(days=i), y, p) for i, (y, p) in enumerate(HOLDOUT)]
    pred = spark.createDataFrame(rows, "data date, faturamento double, faturamento_previsto double")
    m = forecast.regression_metrics(pred, pred.select("data", "faturamento")).first()
    assert tuple(m) == HOLDOUT_METRICS


def _numpy_fit(dates, y):
    """Reference-style design: full one-hot weekday + month and the weekend flag, min-norm lstsq."""
    wd = np.array([d.weekday() for d in dates])
    mo = np.array([d.month for d in dates])
    wcats, mcats = sorted(set(wd)), sorted(set(mo))

    def design(ds):
        w = np.array([d.weekday() for d in ds])
        m = np.array([d.month for d in ds])
        cols = [(w == c).astype(float) for c in wcats] + [(m == c).astype(float) for c in mcats]
        cols.append((w >= 5).astype(float))
        return np.column_stack(cols)

    X = design(dates)
    xm, ym = X.mean(axis=0), y.mean()
    coef, *_ = np.linalg.lstsq(X - xm, y - ym, rcond=None)
    return lambda ds: (design(ds) - xm) @ coef + ym


def test_ols_matches_numpy_least_squares(spark, star_small):
    series = forecast._series(star_small)
    train, test = forecast.split(series)
    tr = train.orderBy("data").select("data", "faturamento").collect()
    te = test.orderBy("data").select("data", "faturamento").collect()
    predict = _numpy_fit([r["data"] for r in tr], np.array([r["faturamento"] for r in tr]))
    want = predict([r["data"] for r in te])
    fitted = forecast.fit(train)
    assert len(fitted.weekdays) == 6 and len(fitted.months) == 11  # every category seen in training
    got = forecast.forecast_holdout(star_small).orderBy("data").collect()
    assert len(got) == forecast.TEST_DAYS
    np.testing.assert_allclose([r["faturamento_previsto"] for r in got], want, rtol=1e-7)
    nxt = forecast.forecast_next_month(star_small).orderBy("data").collect()
    assert len(nxt) == forecast.HORIZON_DAYS
    assert nxt[0]["data"] == te[-1]["data"] + dt.timedelta(days=1)
    assert all(r["faturamento_previsto"] >= 0 for r in nxt)


def test_dense_series_and_split(spark, star_small):
    dense = forecast.daily_revenue_dense(star_small).orderBy("data").collect()
    days = (dense[-1]["data"] - dense[0]["data"]).days + 1
    assert len(dense) == days
    summary = {r["conjunto"]: r for r in forecast.split_summary(star_small).collect()}
    assert summary["teste"]["dias"] == 30 and summary["treino"]["dias"] == days - 30
    metrics = forecast.forecast_metrics(star_small).collect()
    assert [r["modelo"] for r in metrics] == ["regressao_linear", "baseline_media_historica"]
    total = forecast.forecast_total(star_small).first()[0]
    assert total == pytest.approx(sum(r["faturamento_previsto"] for r in
                                      forecast.forecast_next_month(star_small).collect()))
