"""Customer lifecycle kept up to date from batches of sales.

A customer's state is mergeable: the last purchase is a maximum, the two
half-year flags are disjunctions. A batch is reduced to one state per customer
in it and merged into the kept states, so the cost follows the batch and the
number of customers, not the history. Recency is taken against the latest sale
of all, when the table is read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = ("ID_Cliente", "ultima_compra", "comprou_h1", "comprou_h2")


def lifecycle_state(sales: DataFrame, cut: dt.date) -> DataFrame:
    """D1 + D2 of some sales: one state per customer."""
    day = F.col("Data_Venda")
    return sales.groupBy("ID_Cliente").agg(
        F.max(day).alias("ultima_compra"), F.bool_or(day < F.lit(cut)).alias("comprou_h1"),
        F.bool_or(day >= F.lit(cut)).alias("comprou_h2"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state per customer from the states of disjoint (or repeated) sets of sales."""
    rows = states[0].select(*STATE)
    for s in states[1:]:
        rows = rows.unionByName(s.select(*STATE))
    return rows.groupBy("ID_Cliente").agg(
        F.max("ultima_compra").alias("ultima_compra"), F.bool_or("comprou_h1").alias("comprou_h1"),
        F.bool_or("comprou_h2").alias("comprou_h2"))


def lifecycle_of(state: DataFrame) -> DataFrame:
    """The lifecycle table: recency against the last sale of the whole history."""
    last_day = state.agg(F.max("ultima_compra")).scalar()
    return state.select("ID_Cliente", "ultima_compra",
                        F.datediff(last_day, F.col("ultima_compra")).alias("recencia_dias"), "comprou_h1", "comprou_h2")
