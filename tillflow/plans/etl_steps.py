"""Query views of the individual cleaning and modelling operators.

Row-local operators are shown on every raw record (id, input, output);
row-removing operators show the records that survive, in pipeline order.
Money leaves as DOUBLE through the exact converters.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.money import money_out, to_units, units_out
from tillflow.operators import cleaning as C
from tillflow.operators.ledger import KeyLedger
from tillflow.operators.lifecycle import lifecycle_of, lifecycle_state, merge_states
from tillflow.operators.ordering import default_partitions
from tillflow.plans import warehouse
from tillflow.plans.kpis import KpiParams
from tillflow.session import scratch_path
from tillflow.sources.sinks import write_table
from tillflow.sources.tables import ORDINAL, RAW_COLUMNS


def price_out(c) -> F.Column:
    return units_out(to_units(c, 6), 6)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales records as landed once per session (see warehouse.raw)."""
    return warehouse.raw(spark, sf_dir)


def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records without exact repeats."""
    return _raw(spark, sf_dir).select(*RAW_COLUMNS).transform(C.dedupe_rows)


def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First raw record of every transaction id."""
    return _raw(spark, sf_dir).transform(C.dedupe_keep_first).select(*RAW_COLUMNS)


def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated records that have customer and transaction ids."""
    return (_raw(spark, sf_dir).transform(C.dedupe_keep_first).transform(C.drop_null_keys)
            .select(*RAW_COLUMNS))


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 (+C5): quantity filled with the exact median of the C1-C3 rows, then truncated.

    Reads the ETL's staged rows (C1-C3 done, row-local parsing only, the
    quantity not yet filled) instead of de-duplicating the raw records again.
    """
    keyed = warehouse.star(spark, sf_dir).memo["parsed"]
    filled = keyed.transform(C.impute_median).transform(C.to_int)
    return filled.select("ID_Transacao", F.col("Quantidade"))


def impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing payment method -> 'Nao Informado' (per raw record)."""
    return _raw(spark, sf_dir).transform(C.impute_constant).select("ID_Transacao", "Metodo_Pagamento")


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date text -> DATE by the first matching format (per raw record)."""
    raw = _raw(spark, sf_dir)
    return raw.select("ID_Transacao", F.col("Data_Venda").alias("Data_Venda_texto"),
                      C.parse_multi_format_date(F.col("Data_Venda")).alias("Data_Venda"))


def parse_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price text -> number (per raw record)."""
    raw = _raw(spark, sf_dir)
    return raw.select("ID_Transacao", F.col("Valor_Unitario").alias("Valor_Unitario_texto"),
                      price_out(C.parse_currency(F.col("Valor_Unitario"))).alias("Valor_Unitario"))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 + C10: strip + title case of category, method, status; strip of product name."""
    raw = _raw(spark, sf_dir).transform(C.normalize_text).transform(C.trim_text)
    return raw.select("ID_Transacao", "Nome_Produto", *C.TITLE_COLUMNS)


def parse_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: location text -> city, state, country (per raw record)."""
    raw = _raw(spark, sf_dir).select("ID_Transacao", "Localidade_Venda")
    return raw.withColumn("_src", F.col("Localidade_Venda")) \
        .transform(lambda d: C.split_location(d, "_src"))


def drop_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records whose date parses, with the parsed date."""
    return (_raw(spark, sf_dir).transform(C.parse_dates).transform(C.drop_bad_dates)
            .select("ID_Transacao", "Data_Venda"))


def derive_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue of every clean sale."""
    clean = warehouse.star(spark, sf_dir).clean
    return clean.select("ID_Transacao", price_out("Valor_Unitario").alias("Valor_Unitario"),
                        "Quantidade", money_out("Faturamento").alias("Faturamento"))


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning job's output (13 columns)."""
    clean = warehouse.star(spark, sf_dir).clean
    return clean.select(*[price_out(c).alias(c) if c == "Valor_Unitario"
                          else money_out(c).alias(c) if c == "Faturamento" else F.col(c)
                          for c in C.CLEAN_COLUMNS])


AUDIT = ("linhas_brutas", "linhas_limpas", "clientes", "produtos", "vendas", "precos_invalidos")


def etl_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows, clean rows, customers, products, sales and unparsable prices, as the ETL's own
    writes counted them; no table is read."""
    counted = warehouse.star(spark, sf_dir).audit
    return spark.range(1).select(*[F.lit(counted[n]).cast("bigint").alias(n) for n in AUDIT])


def dedupe_incremental(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """C2 over batches: the raw records arrive in `batches` parts, in input order, and each is compared with
    the ledger of the keys landed before; the rows are those of the one-shot job."""
    raw = _raw(spark, sf_dir)
    place = F.col(f"{ORDINAL}.l_partkey")
    last = raw.agg(F.max(place)).first()[0] or 0
    name = f"ledger_{uuid.uuid4().hex[:12]}"
    ledger = KeyLedger(spark, name, scratch_path(spark, name), buckets=default_partitions(raw))
    for i in range(batches):
        part = raw.where((place * batches >= i * (last + 1)) & (place * batches < (i + 1) * (last + 1)))
        ledger.land(part, i)
    return ledger.rows().select(*RAW_COLUMNS)


def lifecycle_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + D2 kept up to date: the states of the sales of each year, merged one after the other."""
    fact, cut = warehouse.star(spark, sf_dir).fact, KpiParams().cut
    first, last = fact.agg(F.min(F.year("Data_Venda")), F.max(F.year("Data_Venda"))).first()
    state = lifecycle_state(fact.limit(0), cut)
    for year in range(first or 0, (last or -1) + 1):
        days = F.col("Data_Venda").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31)))
        path = scratch_path(spark, f"lifecycle-{uuid.uuid4().hex[:12]}")
        state = write_table(merge_states(state, lifecycle_state(fact.where(days), cut)), path)
    return lifecycle_of(state)


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: customer dimension, in id order."""
    return warehouse.star(spark, sf_dir).customers.orderBy("ID_Cliente")


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M3: product dimension with dense surrogate keys, in key order."""
    by_number = F.substring("ID_Produto", 4, 20).cast("long")  # as text, PRD10000 would sort before PRD9999
    return warehouse.star(spark, sf_dir).products.orderBy(by_number)


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M5: sales fact (12 columns)."""
    fact = warehouse.star(spark, sf_dir).fact
    return fact.select(*[price_out(c).alias(c) if c == "Valor_Unitario"
                         else money_out(c).alias(c) if c == "Faturamento" else F.col(c)
                         for c in fact.columns])


def enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact joined to products (fact columns + product name and category)."""
    e = warehouse.enriched(spark, sf_dir)
    return e.select(*[price_out(c).alias(c) if c == "Valor_Unitario"
                      else money_out(c).alias(c) if c == "Faturamento" else F.col(c)
                      for c in e.columns])


STEP_QUERIES = {
    "dedupe_rows": dedupe_rows,
    "dedupe_keep_first": dedupe_keep_first,
    "drop_null_keys": drop_null_keys,
    "impute_median": impute_median,
    "impute_constant": impute_constant,
    "parse_dates": parse_dates,
    "parse_currency": parse_currency,
    "normalize_text": normalize_text,
    "parse_location": parse_location,
    "drop_bad_dates": drop_bad_dates,
    "derive_revenue": derive_revenue,
    "clean_sales": clean_sales,
    "etl_audit": etl_audit,
    "dedupe_incremental": dedupe_incremental,
    "lifecycle_incremental": lifecycle_incremental,
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "fact_sales": fact_sales,
    "enriched_sales": enriched_sales,
}
