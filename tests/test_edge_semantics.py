"""Edge rules from the survey's pitfall list, on literal rows."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest

from helpers import raw_df, sale
from tillflow.plans import forecast, kpis, profile, reports
from tillflow.plans.warehouse import Star, build_star
from tillflow.session import scratch_path


def _star(spark, rows):
    return build_star(spark, raw_df(spark, rows), scratch_path(spark, f"edge-{uuid.uuid4().hex}"))


def test_zero_variance_correlation_is_null(spark):
    rows = [sale(f"T{i}", qty=2.0, price=f"{10 + i}.00", cust=f"CLI{i}") for i in range(6)]
    corr = {r["coluna"]: r for r in profile.correlation_matrix(_star(spark, rows)).collect()}
    assert corr["Quantidade"]["Quantidade"] is None and corr["Quantidade"]["Faturamento"] is None
    assert corr["Valor_Unitario"]["Faturamento"] == 1.0


def test_mape_floors_zero_actuals(spark):
    pred = spark.createDataFrame([(dt.date(2025, 1, 1), 0.0, 1.0), (dt.date(2025, 1, 2), 2.0, 1.0)],
                                 "data date, faturamento double, faturamento_previsto double")
    m = forecast.regression_metrics(pred, pred).first()
    assert m["mae"] == 1.0 and m["mape"] == pytest.approx(round((1 / 2.220446049250313e-16 + 0.5) / 2 * 100, 2))


def test_churn_is_strictly_greater_and_flags_use_full_history(spark):
    rows = [
        sale("T1", date="2025-01-01", cust="CLI1"),   # recency 90 -> not churned at 90
        sale("T2", date="2024-12-31", cust="CLI2"),   # recency 91 -> churned
        sale("T3", date="2025-04-01", cust="CLI3"),   # last sale of the history
        sale("T4", date="2025-03-15", cust="CLI1", method="Boleto"),
    ]
    s = _star(spark, rows)
    p = kpis.KpiParams(metodos=("Pix",), cut=dt.date(2025, 2, 1))
    lc = {r["ID_Cliente"]: r for r in kpis.customer_lifecycle(s, p).collect()}
    assert lc["CLI1"]["recencia_dias"] == 17          # from the full history, not the filter
    assert (lc["CLI1"]["comprou_h1"], lc["CLI1"]["comprou_h2"]) == (True, True)
    churn = kpis.churn_rate(s, kpis.KpiParams(metodos=("Pix",), churn_days=90)).first()
    assert churn["clientes"] == 3 and churn["churn_pct"] == 33.33
    ret = kpis.retention_rate(s, p).first()            # CLI1 bought in both halves (one via Boleto)
    assert ret["base_h1"] == 2 and ret["retencao_pct"] == 50.0


def test_status_nulls_excluded_from_dashboard_but_grouped_in_sql_report(spark):
    rows = [sale("T1", status=None), sale("T2", status="Concluido"), sale("T3", status="Concluido")]
    s = _star(spark, rows)
    dash = {r["Status_Pedido"]: r["qtd"] for r in kpis.dash_status_counts(s, kpis.KpiParams()).collect()}
    assert dash == {"Concluido": 2}
    rep = {r["Status_Pedido"]: (r["qtd"], r["pct"]) for r in reports.status_distribution(s).collect()}
    assert rep == {"Concluido": (2, 66.67), None: (1, 33.33)}


def test_top_customer_share_uses_rounded_customer_totals(spark):
    fact = spark.createDataFrame(
        [("C1", Decimal("1.00")), ("C2", Decimal("2.00")), ("C2", Decimal("0.01"))],
        "ID_Cliente string, Faturamento decimal(18,2)")
    s = Star("", None, None, None, fact, 0)
    got = {r["ID_Cliente"]: (r["faturamento_total"], r["pct_do_faturamento_total"], r["ranking"])
           for r in reports.top_customers(s).collect()}
    assert got == {"C2": (2.01, 66.78, 1), "C1": (1.0, 33.22, 2)}


def test_fences_keep_their_decimals(spark):
    """10.000000 lies below a fence of 10.0000004: the comparison must not cut the fence."""
    from decimal import Decimal

    from tillflow.plans.profile import _is_outlier
    df = spark.createDataFrame([(Decimal("10.000000"),), (Decimal("10.000001"),)], "v decimal(18,6)")
    fence = (None, None, Decimal("10.0000004"), Decimal("20.0000004"))
    assert [r[0] for r in df.select(_is_outlier("v", fence)).collect()] == [True, False]


def test_display_percentages_are_rounded_once(spark):
    """12.7493 % is 12.7, not 12.75 and then 12.8."""
    from pyspark.sql import functions as F

    from tillflow.plans.kpis import _percent_or_zero
    df = spark.createDataFrame([(127493, 1000000)], "a long, b long")
    assert df.select(F.format_number(_percent_or_zero("a", "b", 1), 1)).first()[0] == "12.7"


def test_keep_first_needs_an_order(spark):
    import pytest

    from tillflow.operators.cleaning import dedupe_keep_first
    with pytest.raises(ValueError):
        dedupe_keep_first(spark.createDataFrame([("T1",)], "ID_Transacao string"))


def test_product_keys_are_listed_by_number(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("PRD10000",), ("PRD9999",)], "ID_Produto string")
    by_number = F.substring("ID_Produto", 4, 20).cast("long")
    assert [r[0] for r in df.orderBy(by_number).collect()] == ["PRD9999", "PRD10000"]
