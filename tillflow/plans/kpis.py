"""KPI / dashboard data jobs over the enriched fact.

A `KpiParams` value carries the dashboard state: an inclusive date range and
optional IN-lists (an empty list means no filter), the churn threshold and the
half-year cut. Filters are plain column predicates, so they reach the Parquet
scan (PushedFilters) of the written fact.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.dates import month_start, week_label
from tillflow.functions.money import (format_brl, format_int_br, money_out, ratio_out,
                                     report_columns, to_units)
from tillflow.operators.lifecycle import lifecycle_of, lifecycle_state
from tillflow.plans.warehouse import Star

# Churn threshold slider (default, min, max, step) and formats.
CHURN_DEFAULT, CHURN_MIN, CHURN_MAX, CHURN_STEP = 90, 30, 180, 15
ROLLING_PERIODS = 3


@dataclass(frozen=True)
class KpiParams:
    start: dt.date | None = None          # inclusive; None = first sale
    end: dt.date | None = None            # inclusive; None = last sale
    categorias: tuple[str, ...] = ()
    estados: tuple[str, ...] = ()
    status: tuple[str, ...] = ()
    metodos: tuple[str, ...] = ()
    churn_days: int = CHURN_DEFAULT
    cut: dt.date = dt.date(1998, 7, 1)     # first day of the second half-year
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if not CHURN_MIN <= self.churn_days <= CHURN_MAX or (self.churn_days - CHURN_MIN) % CHURN_STEP:
            raise ValueError(f"churn_days must be in {CHURN_MIN}..{CHURN_MAX} step {CHURN_STEP}")


# The dashboard's opening state: the whole period, no list selected, churn
# threshold 90 days. The half-year cut is a parameter; on the driver data it
# is the middle of the history.
DEFAULT = KpiParams()
# A selection used by the registered filter query (D3), on driver data values.
DEMO = KpiParams(start=dt.date(1996, 1, 1), end=dt.date(1999, 12, 31),
                 categorias=("Economy", "Promo", "Standard"), status=("F", "O"))


def fact_filter(p: KpiParams) -> Column:
    """The part of the D3 predicate that reads fact columns: date range and three lists."""
    cond = F.lit(True)
    if p.start is not None:
        cond = cond & (F.col("Data_Venda") >= F.lit(p.start))
    if p.end is not None:
        cond = cond & (F.col("Data_Venda") <= F.lit(p.end))
    for col, values in (("Estado", p.estados), ("Status_Pedido", p.status), ("Metodo_Pagamento", p.metodos)):
        if values:
            cond = cond & F.col(col).isin(*values)
    return cond


def product_filter(p: KpiParams) -> Column:
    """The part of the D3 predicate that reads the product dimension."""
    return F.col("Categoria_Produto").isin(*p.categorias) if p.categorias else F.lit(True)


def sale_filter(p: KpiParams) -> Column:
    """D3 predicate: date range AND each non-empty IN-list."""
    return fact_filter(p) & product_filter(p)


# A selection that uses all four lists and the dates, and one that nothing matches.
SELECTION = KpiParams(start=dt.date(1996, 2, 1), end=dt.date(1999, 6, 30),
                      categorias=("Economy", "Promo", "Standard"),
                      estados=tuple(f"NATION_{i}" for i in range(0, 24, 2)),
                      status=("F", "O"), metodos=("1-Urgent", "2-High", "4-Not Specified"))
NOTHING = KpiParams(categorias=("Nenhuma",))


def filtered_sales(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """D3: enriched sales that pass the dashboard filters."""
    return s.enriched().where(sale_filter(p))


def selected_sales(s: Star, p: KpiParams) -> DataFrame:
    """Sales that pass the filters, for jobs that read fact columns only: the product
    dimension is joined only where its category filter asks for it."""
    return (s.enriched() if p.categorias else s.fact).where(sale_filter(p))


def filtered_sales_report(s: Star, p: KpiParams = DEMO) -> DataFrame:
    """D3 as a report: money columns as DOUBLE (registered with the DEMO selection)."""
    f = filtered_sales(s, p)
    return f.select(*report_columns(f))


def customer_lifecycle(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """D1 + D2: per customer last purchase, recency vs the last sale of the full
    history, and whether they bought before / on-or-after the cut.

    Independent of the dashboard filters, so it is computed once per star and
    cut and checkpointed; churn, retention and the KPI strings read it.
    """
    key = ("lifecycle", p.cut)
    if key not in s.memo:
        s.memo[key] = lifecycle_of(lifecycle_state(s.fact, p.cut)).checkpoint(eager=True)
    return s.memo[key]


def filter_domains(s: Star) -> DataFrame:
    """Selectable values of the four list filters and the date bounds, as text.

    One pass over the fact: a partial aggregate leaves one row per combination
    of the four columns, and only those rows are joined and unfolded.
    """
    combos = s.fact.groupBy("ID_Produto", "Estado", "Status_Pedido", "Metodo_Pagamento").agg(
        F.min("Data_Venda").cast("string").alias("data_min"), F.max("Data_Venda").cast("string").alias("data_max"))
    named = combos.join(s.products.select("ID_Produto", "Categoria_Produto"), "ID_Produto")
    lists = ("Categoria_Produto", "Estado", "Status_Pedido", "Metodo_Pagamento")
    pairs = named.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("filtro"), F.col(c).alias("valor")) for c in (*lists, "data_min", "data_max")]))
        .alias("x")).select("x.*").where(F.col("valor").isNotNull())
    # a date bound is one group (ISO text sorts by date); a list value is a group of its own
    group = F.when(F.col("filtro").isin(*lists), F.col("valor"))
    out = pairs.groupBy("filtro", group.alias("g")).agg(F.min("valor").alias("lo"), F.max("valor").alias("hi"))
    return out.select("filtro", F.when(F.col("filtro") == "data_max", F.col("hi")).otherwise(F.col("lo"))
                      .alias("valor")).orderBy("filtro", "valor")


def kpi_summary(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """D5 (+D16): total revenue, mean ticket, orders, distinct customers; zeros when empty."""
    f = selected_sales(s, p)
    g = f.agg(F.sum("Faturamento").alias("_tot"), F.count("Faturamento").alias("_n"),
              F.count(F.lit(1)).alias("total_pedidos"),
              F.count_distinct("ID_Cliente").alias("clientes_unicos"))
    return g.select(
        money_out(F.coalesce(F.col("_tot"), F.lit(0).cast("decimal(28,2)"))).alias("faturamento_total"),
        ratio_out(to_units("_tot", 2), F.col("_n") * F.lit(100), 2).alias("ticket_medio"),
        "total_pedidos", "clientes_unicos")


def _customer_counts(s: Star, p: KpiParams) -> DataFrame:
    """One row of counts over the customers that have a sale in the filter.

    The buyers are made distinct (a partial aggregate) before the semi join, so
    a customer with very many sales reaches the shuffle as one row per task.
    """
    return customer_counts(customer_lifecycle(s, p), selected_sales(s, p).select("ID_Cliente").distinct(), p)


def customer_counts(lifecycle: DataFrame, buyers: DataFrame, p: KpiParams) -> DataFrame:
    """One row of counts over the lifecycle rows of the buyers (distinct customer ids)."""
    inside = lifecycle.join(buyers, "ID_Cliente", "left_semi")
    return inside.agg(
        F.count(F.lit(1)).alias("clientes"),
        F.count_if(F.col("recencia_dias") > p.churn_days).alias("perdidos"),
        F.count_if(F.col("comprou_h1")).alias("base_h1"),
        F.count_if(F.col("comprou_h1") & F.col("comprou_h2")).alias("retidos"))


def _percent_or_zero(part: str, whole: str, scale: int) -> Column:
    return F.coalesce(ratio_out(F.col(part) * F.lit(100), F.col(whole), scale), F.lit(0.0))


def churn_rate(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """% of the filter's customers with recency > threshold (0 when none)."""
    return churn_of(_customer_counts(s, p), p)


def churn_of(counts: DataFrame, p: KpiParams) -> DataFrame:
    return counts.select(F.lit(p.churn_days).alias("limite_dias"), "clientes",
                         _percent_or_zero("perdidos", "clientes", 2).alias("churn_pct"))


def retention_rate(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """Of the filter's first-half buyers, % who also bought in the second half (0 when none)."""
    return retention_of(_customer_counts(s, p))


def retention_of(counts: DataFrame) -> DataFrame:
    return counts.select("base_h1", _percent_or_zero("retidos", "base_h1", 2).alias("retencao_pct"))


def period(freq: str, c: str = "Data_Venda") -> Column:
    return {"D": F.col(c), "W": week_label(c), "MS": month_start(c)}[freq]


def _step(freq: str) -> Column:
    return {"D": F.expr("INTERVAL 1 DAY"), "W": F.expr("INTERVAL 7 DAYS"),
            "MS": F.expr("INTERVAL 1 MONTH")}[freq]


def resample(s: Star, p: KpiParams = DEFAULT, freq: str = "D") -> DataFrame:
    """D9 + D10: revenue per day / week (ending Sunday) / month start, empty periods 0,
    with the rolling mean of the last 3 periods (fewer at the start).

    The calendar comes from sequence(first, last) on a one-row aggregate: its
    length is bounded by the time span, not by the data.
    """
    f = selected_sales(s, p)
    sums = f.groupBy(period(freq).alias("periodo")).agg(F.sum("Faturamento").alias("_fat"))
    return dense_periods(sums, freq)


def dense_periods(sums: DataFrame, freq: str) -> DataFrame:
    """(periodo, _fat) with the periods between that are empty, and the rolling mean."""
    calendar = sums.agg(F.min("periodo").alias("a"), F.max("periodo").alias("b")) \
        .select(F.explode(F.sequence("a", "b", _step(freq))).alias("periodo"))
    dense = calendar.join(sums, "periodo", "left") \
        .withColumn("_fat", F.coalesce("_fat", F.lit(0).cast("decimal(28,2)")))
    last3 = Window.orderBy("periodo").rowsBetween(-(ROLLING_PERIODS - 1), 0)  # one row per period
    return dense.select(
        "periodo", money_out("_fat").alias("faturamento"),
        ratio_out(to_units(F.sum("_fat").over(last3), 2), F.count("_fat").over(last3) * F.lit(100), 2)
        .alias("media_movel_3")).orderBy("periodo")


def _product_revenue(s: Star, p: KpiParams) -> DataFrame:
    """Revenue of the filter's sales per product key, with name and category: the sales are summed
    before the product join, which then moves one row per product."""
    sums = s.fact.where(fact_filter(p)).groupBy("ID_Produto").agg(F.sum("Faturamento").alias("_sum"))
    return s.named(sums).where(product_filter(p))


def dash_category_revenue(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """Revenue by category, descending (NULL category dropped, as in a pandas groupby)."""
    return category_revenue_of(_product_revenue(s, p))


def category_revenue_of(per_product: DataFrame) -> DataFrame:
    g = per_product.where(F.col("Categoria_Produto").isNotNull()) \
        .groupBy("Categoria_Produto").agg(F.sum("_sum").alias("_fat"))
    return g.select("Categoria_Produto", money_out(F.coalesce("_fat", F.lit(0))).alias("faturamento")) \
        .orderBy(F.col("faturamento").desc())


def dash_status_counts(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """Sales per status, descending, NULL status excluded."""
    return selected_sales(s, p).where(F.col("Status_Pedido").isNotNull()) \
        .groupBy("Status_Pedido").agg(F.count(F.lit(1)).alias("qtd")).orderBy(F.col("qtd").desc())


def dash_top_products(s: Star, p: KpiParams = DEFAULT, n: int = 10) -> DataFrame:
    """Top-n product names by revenue (grouped by name only; ties by name)."""
    return top_products_of(_product_revenue(s, p), n)


def top_products_of(per_product: DataFrame, n: int = 10) -> DataFrame:
    g = per_product.where(F.col("Nome_Produto").isNotNull()) \
        .groupBy("Nome_Produto").agg(F.coalesce(F.sum("_sum"), F.lit(0)).alias("_fat"))
    return g.orderBy(F.col("_fat").desc(), F.col("Nome_Produto")).limit(n) \
        .select("Nome_Produto", money_out("_fat").alias("faturamento"))


def dash_state_ticket(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """Mean ticket per state, descending (NULL state dropped)."""
    g = selected_sales(s, p).where(F.col("Estado").isNotNull()) \
        .groupBy("Estado").agg(F.sum("Faturamento").alias("_fat"), F.count("Faturamento").alias("_n"))
    return g.select("Estado", ratio_out(to_units("_fat", 2), F.col("_n") * F.lit(100), 2)
                    .alias("ticket_medio")).orderBy(F.col("ticket_medio").desc())


def rate_texts(counts: DataFrame) -> DataFrame:
    """One row, one struct: churn and retention as text, rounded once from the exact ratio to one decimal."""
    pct = lambda c: F.concat(F.format_number(c, 1), F.lit("%"))
    return counts.select(F.struct(
        pct(_percent_or_zero("perdidos", "clientes", 1)).alias("churn"),
        pct(_percent_or_zero("retidos", "base_h1", 1)).alias("retencao")).alias("r"))


def kpi_formatted(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """The KPI display strings (R$ 1.234,56 / 1.234 / 12,3%)."""
    return kpi_summary(s, p).select(
        format_brl("faturamento_total").alias("faturamento_total"),
        format_brl("ticket_medio").alias("ticket_medio"),
        format_int_br("total_pedidos").alias("total_pedidos"),
        format_int_br("clientes_unicos").alias("clientes_unicos"),
        rate_texts(_customer_counts(s, p)).scalar().alias("_r"),
    ).select("faturamento_total", "ticket_medio", "total_pedidos", "clientes_unicos",
             F.col("_r.churn").alias("churn"), F.col("_r.retencao").alias("retencao"))
