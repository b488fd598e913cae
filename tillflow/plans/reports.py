"""The named report queries over the star schema (fact `vendas`, dim `produtos`).

Global windows appear only over results that are already aggregated to one
row per category / month / top-10 row; ranking over all customers goes through
the distributed global row index. Totals used in percentages are uncorrelated
scalar subqueries (computed once, no join).

Reports by a product column aggregate by product key first: the sums of a
product are joined to its name and category and summed again, so no sale is
shuffled for the join, however skewed the products are. Decimal sums are exact,
so summing in two steps gives the same values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.money import mean_money_out, money_out, percent_out, report_columns
from tillflow.operators.clustering import Lookup
from tillflow.operators.ordering import global_row_index, ntile_from_index
from tillflow.plans.warehouse import Star, look_up


def revenue_by_category(s: Star) -> DataFrame:
    """Q1: per category sales, revenue, mean ticket and rank by (unrounded) revenue."""
    per_product = s.fact.groupBy("ID_Produto").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("Faturamento").alias("_sum"), F.count("Faturamento").alias("_present"))
    g = s.named(per_product).groupBy("Categoria_Produto").agg(
        F.sum("_rows").alias("qtd_vendas"), F.sum("_sum").alias("_tot"), F.sum("_present").alias("_n"))
    by_revenue = Window.orderBy(F.col("_tot").desc())  # one row per category
    return (g.select(
        "Categoria_Produto", "qtd_vendas",
        money_out("_tot").alias("faturamento_total"),
        mean_money_out("_tot", "_n").alias("ticket_medio"),
        F.rank().over(by_revenue).alias("ranking_faturamento"))
        .orderBy(F.col("faturamento_total").desc()))


def top_customers(s: Star, n: int = 10) -> DataFrame:
    """Q2: top-n customers by revenue with share of the all-customer total."""
    per_customer = s.fact.groupBy("ID_Cliente").agg(
        F.round(F.sum("Faturamento"), 2).alias("_tot"), F.count(F.lit(1)).alias("qtd_pedidos"))
    grand_total = per_customer.agg(F.sum("_tot")).scalar()
    top = per_customer.orderBy(F.col("_tot").desc(), F.col("ID_Cliente").asc()).limit(n)
    # RANK over all customers equals RANK over the top rows: it only counts rows above.
    by_revenue = Window.orderBy(F.col("_tot").desc())
    return (top.select(
        "ID_Cliente",
        money_out("_tot").alias("faturamento_total"),
        "qtd_pedidos",
        percent_out(F.col("_tot"), grand_total, part_scale=2).alias("pct_do_faturamento_total"),
        F.rank().over(by_revenue).alias("ranking"))
        .orderBy(F.col("faturamento_total").desc(), F.col("ID_Cliente")))


def monthly_revenue(s: Star) -> DataFrame:
    """Q3: revenue per month with change vs previous month and a 3-month moving average."""
    months = s.fact.groupBy(F.date_format("Data_Venda", "yyyy-MM").alias("mes")).agg(
        F.round(F.sum("Faturamento"), 2).alias("_fat"))
    by_month = Window.orderBy("mes")  # one row per month
    last3 = by_month.rowsBetween(-2, 0)
    prev = F.lag("_fat").over(by_month)
    return (months.select(
        "mes",
        money_out("_fat").alias("faturamento"),
        money_out(F.col("_fat") - prev).alias("variacao_absoluta"),
        percent_out(F.col("_fat") - prev, prev, part_scale=2).alias("variacao_pct"),
        mean_money_out(F.sum("_fat").over(last3), F.count("_fat").over(last3)).alias("media_movel_3m"))
        .orderBy("mes"))


def ticket_by_state(s: Star) -> DataFrame:
    """Q4: per state distinct customers, sales, revenue and mean ticket."""
    g = s.fact.groupBy("Estado").agg(
        F.count_distinct("ID_Cliente").alias("clientes_unicos"),
        F.count(F.lit(1)).alias("qtd_vendas"),
        F.sum("Faturamento").alias("_tot"),
        F.count("Faturamento").alias("_n"))
    return (g.select(
        "Estado", "clientes_unicos", "qtd_vendas",
        money_out("_tot").alias("faturamento_total"),
        mean_money_out("_tot", "_n").alias("ticket_medio"))
        .orderBy(F.col("faturamento_total").desc()))


def top_products_by_category(s: Star, k: int = 3) -> DataFrame:
    """Q5: the k best-selling products of each category, ties kept (RANK <= k)."""
    # a product key is one (category, name), so its sums are the group's
    g = s.named(s.fact.groupBy("ID_Produto").agg(
        F.sum("Quantidade").alias("qtd_total"), F.sum("Faturamento").alias("_tot")))
    in_category = Window.partitionBy("Categoria_Produto").orderBy(F.col("_tot").desc())
    ranked = g.withColumn("ranking_categoria", F.rank().over(in_category)) \
        .where(F.col("ranking_categoria") <= k)
    return (ranked.select(
        "Categoria_Produto", "Nome_Produto", F.col("qtd_total").cast("long").alias("qtd_total"),
        money_out("_tot").alias("faturamento_total"), "ranking_categoria")
        .orderBy("Categoria_Produto", "ranking_categoria", "Nome_Produto"))


def rfm_base(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ID_Cliente").agg(
        F.max("Data_Venda").alias("ultima_compra"),
        F.count(F.lit(1)).alias("frequencia"),
        F.round(F.sum("Faturamento"), 2).alias("_valor"))


def rfm_customers(s: Star) -> DataFrame:
    """Q6: recency / frequency / value per customer and the value quartile NTILE(4).

    NTILE needs every customer's position in value order; it comes from the
    distributed global row index (ties broken by customer id).
    """
    base = rfm_base(s.fact)
    last_day = s.fact.agg(F.max("Data_Venda")).scalar()
    order = [F.col("_valor").desc(), F.col("ID_Cliente").asc_nulls_first()]
    indexed, total = global_row_index(base, order)
    # The index left the rows range-partitioned and sorted in value order: each
    # partition is a contiguous, ordered part of the result, so it is not sorted again.
    return indexed.select(
        "ID_Cliente", "ultima_compra", "frequencia",
        money_out("_valor").alias("valor_total"),
        F.datediff(last_day, F.col("ultima_compra")).alias("recencia_dias"),
        ntile_from_index(F.col("_row"), total, 4).alias("quartil_valor"))


def status_distribution(s: Star) -> DataFrame:
    """Q7: count and share of sales per order status."""
    total = s.fact.agg(F.count(F.lit(1))).scalar()
    g = s.fact.groupBy("Status_Pedido").agg(F.count(F.lit(1)).alias("qtd"))
    return g.select("Status_Pedido", "qtd", percent_out(F.col("qtd"), total).alias("pct")) \
        .orderBy(F.col("qtd").desc())


def _looked_up(s: Star, lookup: Lookup) -> DataFrame:
    found = look_up(s, lookup)
    return found.select(*report_columns(found))


def sales_of_customer(s: Star, customer: str | None = None) -> DataFrame:
    """All sales of one customer (the first by id unless given), by the customer access path."""
    customer = customer or s.customers.agg(F.min("ID_Cliente")).first()[0]
    return _looked_up(s, Lookup("ID_Cliente", (customer or "",)))


def sales_of_product(s: Star, product: str = "PRD0001") -> DataFrame:
    """All sales of one product, by the product access path."""
    return _looked_up(s, Lookup("ID_Produto", (product,)))


def sales_between(s: Star, first: dt.date = dt.date(1997, 3, 1), last: dt.date = dt.date(1997, 3, 7)) -> DataFrame:
    """All sales of a range of days, by the date access path."""
    return _looked_up(s, Lookup("Data_Venda", least=first, most=last))
