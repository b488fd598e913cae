import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import raw_df, sale
from tillflow.plans import kpis, profile
from tillflow.plans.warehouse import build_star
from tillflow.session import scratch_path


@pytest.fixture(scope="module")
def star_fixture(spark):
    """Small star built from literal raw rows: two revenue outliers, a NULL price."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(120):
        d = dt.date(2025, 1, 1) + dt.timedelta(days=int(rng.integers(0, 330)))
        price = f"{rng.integers(100, 200)}.{rng.integers(0, 100):02d}"
        rows.append(sale(f"T{i:04d}", date=d.isoformat(), cust=f"CLI{int(rng.integers(0, 25)):05d}",
                         prod=["Kit Cama", "Bola", "Livro"][i % 3], cat=["Casa", "Esporte", "Livros"][i % 3],
                         price=price, qty=float(rng.integers(1, 4)),
                         loc=["Recife/PE/Brasil", "NATAL - rn"][i % 2],
                         method=["Pix", "Boleto"][i % 2], status=["Concluido", "Cancelado"][i % 2]))
    rows.append(sale("T9990", date="2025-06-01", price="R$ 5.000,00", qty=5.0))
    rows.append(sale("T9991", date="2025-06-02", price="R$ 4.000,00", qty=5.0))
    rows.append(sale("T9992", date="2025-06-03", price="1.234,56", qty=1.0))
    return build_star(spark, raw_df(spark, rows), scratch_path(spark, f"test-{uuid.uuid4().hex}"))


def enriched_pd(star):
    e = star.enriched()
    return e.select(*[F.col(c).cast("double").alias(c) if c in ("Valor_Unitario", "Faturamento")
                      else F.col(c) for c in e.columns]).toPandas()


def test_numeric_stats_and_outliers_vs_pandas(spark, star_fixture):
    pdf = enriched_pd(star_fixture)
    stats = {r["coluna"]: r for r in profile.numeric_stats_by_column(star_fixture).collect()}
    wide = {r["estatistica"]: r for r in profile.numeric_stats(star_fixture).collect()}
    assert list(wide) == list(profile.NUMERIC_STAT_LABELS)
    assert wide["50%"]["Faturamento"] == stats["Faturamento"]["q50"]
    assert wide["count"]["Quantidade"] == float(stats["Quantidade"]["contagem"])
    for c in profile.NUMERIC_COLS:
        s = pdf[c].dropna()
        assert stats[c]["contagem"] == len(s)
        assert stats[c]["media"] == pytest.approx(s.mean(), abs=0.006)
        assert stats[c]["desvio_padrao"] == pytest.approx(s.std(), abs=0.006)
        for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            assert stats[c][name] == pytest.approx(s.quantile(q), abs=0.006)
    summary = {r["coluna"]: r for r in profile.outlier_summary(star_fixture).collect()}
    detail = profile.outlier_detail(star_fixture).collect()
    for c in profile.NUMERIC_COLS:
        s = pdf[c]
        q1, q3 = s.quantile([0.25, 0.75])
        mask = (s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))
        assert summary[c]["qtd_outliers"] == int(mask.sum())
        assert summary[c]["pct_outliers"] == round(100 * mask.sum() / len(pdf), 2)
        assert sorted(r["ID_Transacao"] for r in detail if r["coluna_outlier"] == c) == \
            sorted(pdf.loc[mask, "ID_Transacao"])
    assert summary["Faturamento"]["qtd_outliers"] >= 2
    top = profile.top_outliers(star_fixture).collect()
    assert [r["ID_Transacao"] for r in top][:2] == ["T9990", "T9991"]
    box = {r["coluna"]: r for r in profile.boxplot_stats(star_fixture).collect()}
    fat = pdf["Faturamento"].dropna()
    q1, q3 = fat.quantile([0.25, 0.75])
    inside = fat[(fat >= q1 - 1.5 * (q3 - q1)) & (fat <= q3 + 1.5 * (q3 - q1))]
    assert box["Faturamento"]["bigode_superior"] == pytest.approx(inside.max(), abs=0.006)


def test_categorical_correlation_profile(spark, star_fixture):
    pdf = enriched_pd(star_fixture)
    cats = {r["coluna"]: r for r in profile.categorical_stats_by_column(star_fixture).collect()}
    wide = {r["estatistica"]: r for r in profile.categorical_stats(star_fixture).collect()}
    assert wide["top"]["Estado"] == cats["Estado"]["moda"]
    assert wide["freq"]["Estado"] == str(cats["Estado"]["frequencia_moda"])
    for c in profile.CATEGORICAL_COLS:
        vc = pdf[c].value_counts()
        assert cats[c]["unicos"] == pdf[c].nunique() and cats[c]["frequencia_moda"] == vc.iloc[0]
        assert cats[c]["moda"] == min(vc[vc == vc.iloc[0]].index)
    corr = {r["coluna"]: r for r in profile.correlation_matrix(star_fixture).collect()}
    pc = pdf[list(profile.NUMERIC_COLS)].corr()
    for a in profile.NUMERIC_COLS:
        for b in profile.NUMERIC_COLS:
            assert corr[a][b] == pytest.approx(round(pc.loc[a, b], 3), abs=0.0011)
    prof = profile.dataset_profile(star_fixture).first()
    assert prof["linhas"] == len(pdf) and prof["clientes_unicos"] == pdf["ID_Cliente"].nunique()


def test_kpi_filters_each_alone_and_empty(spark, star_fixture):
    pdf = enriched_pd(star_fixture)
    cases = [
        kpis.KpiParams(),
        kpis.KpiParams(start=dt.date(2025, 3, 1), end=dt.date(2025, 6, 30)),
        kpis.KpiParams(categorias=("Casa",)),
        kpis.KpiParams(estados=("RN",)),
        kpis.KpiParams(status=("Cancelado",)),
        kpis.KpiParams(metodos=("Pix",)),
    ]
    for p in cases:
        mask = pd.Series(True, index=pdf.index)
        if p.start:
            mask &= (pdf["Data_Venda"] >= p.start) & (pdf["Data_Venda"] <= p.end)
        for col, vals in (("Categoria_Produto", p.categorias), ("Estado", p.estados),
                          ("Status_Pedido", p.status), ("Metodo_Pagamento", p.metodos)):
            if vals:
                mask &= pdf[col].isin(vals)
        f = pdf[mask]
        k = kpis.kpi_summary(star_fixture, p).first()
        assert k["total_pedidos"] == len(f) and k["clientes_unicos"] == f["ID_Cliente"].nunique()
        assert k["faturamento_total"] == pytest.approx(f["Faturamento"].sum(), abs=0.005)
        assert k["ticket_medio"] == pytest.approx(f["Faturamento"].mean(), abs=0.006)
    empty = kpis.KpiParams(categorias=("Nada",))
    k = kpis.kpi_summary(star_fixture, empty).first()
    assert (k["faturamento_total"], k["ticket_medio"], k["total_pedidos"], k["clientes_unicos"]) == \
        (0.0, None, 0, 0)
    assert kpis.churn_rate(star_fixture, empty).first()["churn_pct"] == 0.0
    assert kpis.retention_rate(star_fixture, empty).first()["retencao_pct"] == 0.0
    assert kpis.resample(star_fixture, empty, "D").count() == 0
    with pytest.raises(ValueError):
        kpis.KpiParams(churn_days=100)


def test_churn_retention_and_resample_vs_pandas(spark, star_fixture):
    pdf = enriched_pd(star_fixture)
    cut = dt.date(2025, 7, 1)
    p = kpis.KpiParams(churn_days=60, cut=cut, metodos=("Pix",))
    last = pdf["Data_Venda"].max()
    lc = pdf.groupby("ID_Cliente").agg(u=("Data_Venda", "max"))
    lc["rec"] = [(last - d).days for d in lc["u"]]
    lc["h1"] = lc.index.isin(set(pdf.loc[pdf["Data_Venda"] < cut, "ID_Cliente"]))
    lc["h2"] = lc.index.isin(set(pdf.loc[pdf["Data_Venda"] >= cut, "ID_Cliente"]))
    inf = lc[lc.index.isin(pdf.loc[pdf["Metodo_Pagamento"] == "Pix", "ID_Cliente"])]
    assert kpis.churn_rate(star_fixture, p).first()["churn_pct"] == pytest.approx(
        (inf["rec"] > 60).mean() * 100, abs=0.006)
    b = inf[inf["h1"]]
    assert kpis.retention_rate(star_fixture, p).first()["retencao_pct"] == pytest.approx(
        b["h2"].mean() * 100, abs=0.006)
    f = pdf[pdf["Metodo_Pagamento"] == "Pix"].copy()
    f["Data_Venda"] = pd.to_datetime(f["Data_Venda"])
    for freq, rule in (("D", "D"), ("W", "W"), ("MS", "MS")):
        want = f.set_index("Data_Venda")["Faturamento"].resample(rule).sum()
        roll = want.rolling(3, min_periods=1).mean()
        got = kpis.resample(star_fixture, p, freq).collect()
        assert [r["periodo"] for r in got] == [d.date() for d in want.index]
        np.testing.assert_allclose([r["faturamento"] for r in got], want.values, atol=0.005)
        np.testing.assert_allclose([r["media_movel_3"] for r in got], roll.values, atol=0.006)
