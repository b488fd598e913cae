import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillflow.plans import reports
from tillflow.plans.warehouse import Star

# A year of monthly revenue with its change, % change and 3-month moving average.
GOLDEN_MONTHS = [
    ("2025-01", "2548649.84", None, None, 2548649.84),
    ("2025-02", "2254360.84", -294289.0, -11.55, 2401505.34),
    ("2025-03", "2675612.08", 421251.24, 18.69, 2492874.25),
    ("2025-04", "2515579.42", -160032.66, -5.98, 2481850.78),
    ("2025-05", "2588824.33", 73244.91, 2.91, 2593338.61),
    ("2025-06", "2503881.97", -84942.36, -3.28, 2536095.24),
    ("2025-07", "2764913.58", 261031.61, 10.43, 2619206.63),
    ("2025-08", "2800148.88", 35235.3, 1.27, 2689648.14),
    ("2025-09", "2464286.22", -335862.66, -11.99, 2676449.56),
    ("2025-10", "3083792.37", 619506.15, 25.14, 2782742.49),
    ("2025-11", "2541497.98", -542294.39, -17.59, 2696525.52),
    ("2025-12", "2622146.73", 80648.75, 3.17, 2749145.69),
]


def fact_only(df):
    return Star(location="", clean=None, customers=None, products=None, fact=df)


def test_monthly_window_matches_golden(spark):
    rows = [(dt.date(int(m[:4]), int(m[5:]), 15), Decimal(v)) for m, v, *_ in GOLDEN_MONTHS]
    fact = spark.createDataFrame(rows, "Data_Venda date, Faturamento decimal(18,2)")
    got = [tuple(r) for r in reports.monthly_revenue(fact_only(fact)).collect()]
    want = [(m, float(v), a, p, mm) for m, v, a, p, mm in GOLDEN_MONTHS]
    assert got == want


def test_report_totals_agree(spark, star_small):
    total = star_small.fact.agg(F.sum("Faturamento")).first()[0]
    by_cat = sum(r["faturamento_total"] for r in reports.revenue_by_category(star_small).collect())
    by_month = sum(r["faturamento"] for r in reports.monthly_revenue(star_small).collect())
    by_state = sum(r["faturamento_total"] for r in reports.ticket_by_state(star_small).collect())
    for v in (by_cat, by_month, by_state):
        assert v == pytest.approx(float(total), abs=0.01)
    status = reports.status_distribution(star_small).collect()
    assert sum(r["qtd"] for r in status) == star_small.fact.count()
    assert sum(r["pct"] for r in status) == pytest.approx(100, abs=0.05)


def test_top_customers_and_rfm_against_pandas(spark, star_small):
    pdf = star_small.fact.select("ID_Cliente", "Data_Venda", F.col("Faturamento").cast("double")).toPandas()
    g = pdf.groupby("ID_Cliente").agg(v=("Faturamento", "sum"), n=("Faturamento", "size"),
                                      last=("Data_Venda", "max")).reset_index()
    g["v"] = g["v"].round(2)
    g = g.sort_values(["v", "ID_Cliente"], ascending=[False, True]).reset_index(drop=True)
    top = reports.top_customers(star_small).collect()
    assert [r["ID_Cliente"] for r in top] == list(g["ID_Cliente"][:10])
    assert [r["ranking"] for r in top] == list(g["v"].rank(method="min", ascending=False).astype(int)[:10])
    rfm = {r["ID_Cliente"]: r for r in reports.rfm_customers(star_small).collect()}
    n = len(g)
    for i, row in g.iterrows():
        expected_tile = pd.qcut(range(n), 4, labels=False)[i] + 1 if n % 4 == 0 else None
        r = rfm[row["ID_Cliente"]]
        assert r["frequencia"] == row["n"]
        assert r["recencia_dias"] == (pdf["Data_Venda"].max() - row["last"]).days
        if expected_tile is not None:
            assert r["quartil_valor"] == expected_tile


def test_top_products_keeps_ties(spark):
    rows = [("PRD0001", Decimal("10.00")), ("PRD0002", Decimal("10.00")), ("PRD0003", Decimal("5.00")),
            ("PRD0004", Decimal("1.00"))]
    fact = spark.createDataFrame([(p, v, 1) for p, v in rows], "ID_Produto string, Faturamento decimal(18,2), Quantidade int")
    products = spark.createDataFrame([(p, f"n{p[-1]}", "Casa") for p, _ in rows],
                                     "ID_Produto string, Nome_Produto string, Categoria_Produto string")
    s = Star("", None, None, products, fact, 4)
    out = [(r["Nome_Produto"], r["ranking_categoria"]) for r in reports.top_products_by_category(s, k=2).collect()]
    assert sorted(out) == [("n1", 1), ("n2", 1)]
    out3 = reports.top_products_by_category(s, k=3).collect()
    assert sorted(r["ranking_categoria"] for r in out3) == [1, 1, 3]
