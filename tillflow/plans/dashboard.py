"""D5-D14 of one dashboard state from one pass over the sales.

Each KPI view of the dashboard reads the filtered sales again. `shared_sums`
reads them once: GROUPING SETS over day, product, state, status and customer
give every sum the views need, with one partial aggregate in the scan's stage
and one exchange of groups. The groups (a row per day, product, state, status
and customer of the selection) are written to the shared folder, and the eleven
views are small jobs over them, through the same expressions as before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import format_brl, format_int_br, money_out, ratio_out, to_units
from tillflow.plans import kpis
from tillflow.plans.kpis import DEFAULT, KpiParams
from tillflow.plans.warehouse import Star
from tillflow.session import scratch_path

GROUPS = ["Data_Venda", "ID_Produto", "Estado", "Status_Pedido", "ID_Cliente"]
SUMS = ["_rows", "_sum", "_present"]


def grouped_sums(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """(grupo, one column per grouping, sums): the sums of the filter's sales by each of GROUPS."""
    sales = kpis.selected_sales(s, p).select(*GROUPS, "Faturamento")
    sets = sales.groupingSets([[F.col(c)] for c in GROUPS], *[F.col(c) for c in GROUPS])
    number = {(1 << len(GROUPS)) - 1 - (1 << (len(GROUPS) - 1 - i)): c for i, c in enumerate(GROUPS)}
    name = F.create_map(*[F.lit(x) for kv in number.items() for x in kv])
    return sets.agg(F.grouping_id().cast("int").alias("_id"), F.count(F.lit(1)).alias("_rows"),
                    F.sum("Faturamento").alias("_sum"), F.count("Faturamento").alias("_present")) \
        .select(name[F.col("_id")].alias("grupo"), *GROUPS, *SUMS)


def shared_sums(s: Star, p: KpiParams = DEFAULT) -> dict[str, DataFrame]:
    """grouped_sums by group, written once per star and dashboard state."""
    key = ("dashboard", p)
    if key not in s.memo:
        path = scratch_path(s.fact.sparkSession, f"dashboard-{uuid.uuid4().hex[:12]}")
        sums = grouped_sums(s, p)
        sums.write.mode("overwrite").partitionBy("grupo").parquet(path)
        back = s.fact.sparkSession.read.schema(sums.schema).parquet(path)
        s.memo[key] = {c: back.where(F.col("grupo") == c).select(c, *SUMS) for c in GROUPS}
    return s.memo[key]


def _views(s: Star, p: KpiParams) -> dict[str, Callable[[], DataFrame]]:
    sums = shared_sums(s, p)
    money = F.sum("_sum").alias("_fat")

    def kpi_summary() -> DataFrame:
        customers = sums["ID_Cliente"].agg(F.count(F.lit(1))).scalar()
        g = sums["Data_Venda"].agg(F.sum("_sum").alias("_tot"), F.sum("_present").alias("_n"), F.sum("_rows").alias("_q"))
        return g.select(money_out(F.coalesce(F.col("_tot"), F.lit(0))).alias("faturamento_total"),
                        ratio_out(to_units("_tot", 2), F.col("_n") * F.lit(100), 2).alias("ticket_medio"),
                        F.coalesce("_q", F.lit(0).cast("bigint")).alias("total_pedidos"), customers.alias("clientes_unicos"))

    def counts() -> DataFrame:
        return kpis.customer_counts(kpis.customer_lifecycle(s, p), sums["ID_Cliente"].select("ID_Cliente"), p)

    def periods(freq: str) -> DataFrame:
        daily = sums["Data_Venda"].groupBy(kpis.period(freq).alias("periodo")).agg(money)
        return kpis.dense_periods(daily, freq)

    def products() -> DataFrame:
        return s.named(sums["ID_Produto"])

    return {
        "kpi_summary": kpi_summary,
        "churn_rate": lambda: kpis.churn_of(counts(), p),
        "retention_rate": lambda: kpis.retention_of(counts()),
        "resample_daily": lambda: periods("D"),
        "resample_weekly": lambda: periods("W"),
        "resample_monthly": lambda: periods("MS"),
        "dash_category_revenue": lambda: kpis.category_revenue_of(products()),
        "dash_top_products": lambda: kpis.top_products_of(products()),
        "dash_status_counts": lambda: sums["Status_Pedido"].where(F.col("Status_Pedido").isNotNull())
        .select("Status_Pedido", F.col("_rows").alias("qtd")).orderBy(F.col("qtd").desc()),
        "dash_state_ticket": lambda: sums["Estado"].where(F.col("Estado").isNotNull()).select(
            "Estado", ratio_out(to_units("_sum", 2), F.col("_present") * F.lit(100), 2).alias("ticket_medio"))
        .orderBy(F.col("ticket_medio").desc()),
        "kpi_formatted": lambda: kpi_summary().select(
            *[format_brl(c).alias(c) for c in ("faturamento_total", "ticket_medio")],
            *[format_int_br(c).alias(c) for c in ("total_pedidos", "clientes_unicos")],
            kpis.rate_texts(counts()).scalar().alias("_r")).select(
            "faturamento_total", "ticket_medio", "total_pedidos", "clientes_unicos",
            F.col("_r.churn").alias("churn"), F.col("_r.retencao").alias("retencao")),
    }


def dashboard_views(s: Star, p: KpiParams = DEFAULT) -> dict[str, DataFrame]:
    """The eleven views of one dashboard state, all from the shared sums; equal to the jobs of the same names."""
    return {name: view() for name, view in _views(s, p).items()}


def dashboard(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """All views of one dashboard state as one table: (visao, chave, medida, valor), a row per number.

    chave is the view's key column as text ('' where it has none); the display strings are left to kpi_formatted.
    """
    parts = []
    for name, view in dashboard_views(s, p).items():
        if name == "kpi_formatted":
            continue
        keyed = view.columns[0] in ("periodo", "Categoria_Produto", "Nome_Produto", "Status_Pedido", "Estado")
        measures = view.columns[1:] if keyed else view.columns
        rows = F.inline(F.array(*[F.struct(F.lit(m).alias("medida"), F.col(m).cast("double").alias("valor")) for m in measures]))
        parts.append(view.select(F.lit(name).alias("visao"), (F.col(view.columns[0]).cast("string") if keyed else F.lit(""))
                                 .alias("chave"), rows))
    return reduce(DataFrame.unionByName, parts)
