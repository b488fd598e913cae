"""KPI and report views that merge customer sets instead of reading the sales again.

`customer_cells` is written once per star: for each day, category, state,
status and payment method the set of customers and the sums of their sales
(operators.distinct). Every dashboard selection is a union of such cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import mean_money_out, money_out, ratio_out, to_units
from tillflow.operators.dictionary import dictionaries
from tillflow.operators.distinct import NUMBER, by_block, dense_numbers, merged_counts, sets_by_cell
from tillflow.plans.kpis import DEFAULT, KpiParams, sale_filter
from tillflow.plans.warehouse import Star, written_once

CELL_TEXTS = ["Categoria_Produto", "Estado", "Status_Pedido", "Metodo_Pagamento"]
CELL = ["Data_Venda", *CELL_TEXTS]
SUMS = ["_rows", "_sum", "_present"]


def customer_cells(s: Star) -> DataFrame:
    """The cells of a star, laid out by block of customers and sorted by day in it."""
    def build() -> DataFrame:
        # sales are shuffled to their customers' numbers with nothing but their cell and revenue, and reduced behind that
        sales = s.named(s.fact).select("ID_Cliente", *CELL, "Faturamento")
        words, = dictionaries(sales, tuple(CELL_TEXTS))  # the texts of a cell travel as one number
        cell = ["Data_Venda", words.code] if words else CELL
        numbered = (words.encoded(sales) if words else sales).join(dense_numbers(s.customers, "ID_Cliente"), "ID_Cliente")
        sums = dict(zip(SUMS, (F.lit(1), F.col("Faturamento"), F.col("Faturamento").isNotNull().cast("bigint"))))
        cells = sets_by_cell(numbered.select(NUMBER, *cell, "Faturamento"), cell, sums)
        return by_block(cells, cell, words.decoded if words else None)
    return written_once(s, "customer_cells_by_block", build)


def kpi_merged(s: Star, p: KpiParams = DEFAULT) -> DataFrame:
    """D5 (+D16) from the cells of the selection: total revenue, mean ticket, orders, distinct customers."""
    g = merged_counts(customer_cells(s).where(sale_filter(p)), [], SUMS, "clientes_unicos")
    return g.select(
        money_out(F.coalesce(F.col("_sum"), F.lit(0))).alias("faturamento_total"),
        ratio_out(to_units("_sum", 2), F.col("_present") * F.lit(100), 2).alias("ticket_medio"),
        F.coalesce("_rows", F.lit(0).cast("bigint")).alias("total_pedidos"), "clientes_unicos")


def state_merged(s: Star) -> DataFrame:
    """Q4 from the cells: per state distinct customers, sales, revenue and mean ticket."""
    g = merged_counts(customer_cells(s), ["Estado"], SUMS, "clientes_unicos")
    return g.select("Estado", "clientes_unicos", F.col("_rows").alias("qtd_vendas"),
                    money_out("_sum").alias("faturamento_total"), mean_money_out("_sum", "_present").alias("ticket_medio")) \
        .orderBy(F.col("faturamento_total").desc())


def profile_merged(s: Star) -> DataFrame:
    """E10 from the cells and the dimension: rows, distinct customers and product names."""
    g = merged_counts(customer_cells(s), [], ["_rows"], "clientes_unicos")
    # every product of the dimension has a sale
    names = s.products.agg(F.count_distinct("Nome_Produto")).scalar()
    return g.select(F.coalesce("_rows", F.lit(0).cast("bigint")).alias("linhas"), "clientes_unicos", names.alias("produtos_unicos"))
