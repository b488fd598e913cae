"""Star schema: customer and product dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.ordering import global_row_index

# Fixed value: surrogate product key format, numbered from 1.
PRODUCT_KEY_FORMAT = "PRD%04d"
PRODUCT_KEYS = ("Nome_Produto", "Categoria_Produto")
# Fixed value: the columns of the fact table, in order.
FACT_COLUMNS = ("ID_Transacao", "ID_Cliente", "ID_Produto", "Data_Venda", "Valor_Unitario",
                "Quantidade", "Faturamento", "Cidade", "Estado", "Pais",
                "Metodo_Pagamento", "Status_Pedido")


def dim_customers(clean: DataFrame) -> DataFrame:
    """M1: distinct customer ids (a set; order it when presenting)."""
    return clean.select("ID_Cliente").distinct()


def dim_products(clean: DataFrame) -> DataFrame:
    """M2 + M3: distinct (name, category) with a dense key PRD0001... in
    (category, name) order, NULLs last.

    The dense numbering uses the distributed global row index, never a
    single-partition window.
    """
    pairs = clean.select(*PRODUCT_KEYS).distinct()
    order = [F.col("Categoria_Produto").asc_nulls_last(), F.col("Nome_Produto").asc_nulls_last()]
    indexed, _ = global_row_index(pairs, order)
    return indexed.select(
        F.format_string(PRODUCT_KEY_FORMAT, F.col("_row") + 1).alias("ID_Produto"), *PRODUCT_KEYS)


def fact_sales(clean: DataFrame, products: DataFrame, columns=FACT_COLUMNS) -> DataFrame:
    """M4 + M5: left join on (name, category), NULL matching NULL, 12 columns.

    Whether `products` is broadcast is the caller's choice (see warehouse.by_size).
    """
    cond = (clean["Nome_Produto"].eqNullSafe(products["Nome_Produto"])
            & clean["Categoria_Produto"].eqNullSafe(products["Categoria_Produto"]))
    joined = clean.join(products, cond, "left")
    return joined.select(*[clean[c] if c != "ID_Produto" else products[c] for c in columns])


def enriched_sales(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Fact inner join product -> fact columns plus product name and category.

    Whether `products` is broadcast is the caller's choice (see Star.named).
    """
    return fact.join(products, "ID_Produto").select(*FACT_COLUMNS, "Nome_Produto", "Categoria_Produto")
