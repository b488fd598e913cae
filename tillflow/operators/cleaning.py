"""The sales cleaning job, one operator per step (each usable with .transform).

Order of the composed job: keyed de-duplication keeping the first copy, drop
rows without customer / transaction id, median-impute the quantity (median of
the rows left so far), truncate it to int, fill the payment method, parse the
date and the price, title-case three text columns, trim the product name,
split the location, drop rows whose date did not parse, derive revenue.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.dates import parse_multi_format_date
from tillflow.functions.location import DEFAULT_COUNTRY, parse_location
from tillflow.functions.money import parse_currency, revenue
from tillflow.functions.text import strip, strip_title, title_case
from tillflow.operators.dictionary import dictionaries
from tillflow.operators.quantiles import quantile_values
from tillflow.sources.tables import ORDINAL

# Fixed values used by the cleaning rules.
MISSING_METHOD = "Nao Informado"
CRITICAL_KEYS = ("ID_Cliente", "ID_Transacao")
PRODUCT_TITLES, PLACE_TITLES = ("Categoria_Produto",), ("Metodo_Pagamento", "Status_Pedido")
TITLE_COLUMNS = (*PRODUCT_TITLES, *PLACE_TITLES)
TRANSACTION_KEY = "ID_Transacao"

CLEAN_COLUMNS = ("ID_Transacao", "Data_Venda", "ID_Cliente", "Nome_Produto", "Categoria_Produto",
                 "Valor_Unitario", "Quantidade", "Metodo_Pagamento", "Status_Pedido",
                 "Cidade", "Estado", "Pais", "Faturamento")


def _visible(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ORDINAL]


def _keep_first(df: DataFrame, partition: list[str]) -> DataFrame:
    """First row per group in `_ord` order.

    row_number() = 1 plans a partial WindowGroupLimit before the shuffle, so
    even a key held by a third of all rows reaches the exchange as one row per
    map task.
    """
    if ORDINAL not in df.columns:
        raise ValueError(f"keep-first needs the input-order column {ORDINAL}")
    w = Window.partitionBy(*partition).orderBy(ORDINAL)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows repeated in every visible column (first copy kept).

    With an input ordinal the first copy (and its ordinal) is kept; without
    one the copies are indistinguishable, so a hash aggregate with map-side
    combine (dropDuplicates) gives the same rows without a sort.
    """
    if ORDINAL not in df.columns:
        return df.dropDuplicates()
    return _keep_first(df, _visible(df))


def dedupe_keep_first(df: DataFrame, key: str = TRANSACTION_KEY) -> DataFrame:
    """One row per transaction id, the first in input order.

    Not dropDuplicates([key]), which keeps an arbitrary row. NULL ids form
    one group, as in the reference.
    """
    return _keep_first(df, [key])


def drop_null_keys(df: DataFrame, keys=CRITICAL_KEYS) -> DataFrame:
    """Drop rows lacking any critical key."""
    return df.dropna(subset=list(keys))


def median_of(df: DataFrame, column: str) -> float | None:
    """Exact interpolated median (scalar); see operators.quantiles."""
    return quantile_values(df, [column], [0.5], "double")[(column, 0.5)]


def impute_median(df: DataFrame, column: str = "Quantidade", median: float | None = None) -> DataFrame:
    """C4: NULL -> exact median of the column over df's rows."""
    m = median_of(df, column) if median is None else median
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(m).cast(df.schema[column].dataType)))


def to_int(df: DataFrame, column: str = "Quantidade") -> DataFrame:
    """Truncate toward zero."""
    return df.withColumn(column, F.col(column).cast("int"))


def impute_constant(df: DataFrame, column: str = "Metodo_Pagamento",
                    value: str = MISSING_METHOD) -> DataFrame:
    """NULL -> constant."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def parse_dates(df: DataFrame, column: str = "Data_Venda") -> DataFrame:
    """Multi-format text -> DATE (NULL when no format matches)."""
    return df.withColumn(column, parse_multi_format_date(F.col(column)))


def parse_prices(df: DataFrame, column: str = "Valor_Unitario") -> DataFrame:
    """C8: 'R$ 1.234,56' / '1234.56' -> DECIMAL(18,6)."""
    return df.withColumn(column, parse_currency(F.col(column)))


def normalize_text(df: DataFrame, columns=TITLE_COLUMNS) -> DataFrame:
    """Strip + title case."""
    return df.withColumns({c: strip_title(F.col(c)) for c in columns})


def trim_text(df: DataFrame, column: str = "Nome_Produto") -> DataFrame:
    """Strip only."""
    return df.withColumn(column, strip(F.col(column)))


def split_location(df: DataFrame, column: str = "Localidade_Venda") -> DataFrame:
    """C11 + C14: location text -> Cidade, Estado, Pais (source column dropped).

    Same rule as functions.location.parse_location, staged in projections so
    the stripped text and its pieces are computed once per row.
    """
    src = F.col(column)
    staged = df.withColumn("_loc", strip(src)).withColumn(
        "_loc_kind", F.when(F.col("_loc").contains("/"), 1).when(F.col("_loc").contains("-"), 2)
        .otherwise(3))
    staged = staged.withColumn("_loc_parts", F.when(F.col("_loc_kind") == 1, F.split("_loc", "/"))
                               .when(F.col("_loc_kind") == 2, F.split("_loc", "-"))
                               .otherwise(F.array(F.col("_loc"))))
    part = lambda i: strip(F.try_element_at(F.col("_loc_parts"), F.lit(i)))
    country = F.when((F.col("_loc_kind") == 1) & (F.size("_loc_parts") > 2), part(3)) \
        .otherwise(F.lit(DEFAULT_COUNTRY))
    null = F.lit(None).cast("string")
    return staged.withColumns({
        "Cidade": F.when(src.isNull(), null).otherwise(title_case(part(1))),
        "Estado": F.when(src.isNull(), null).otherwise(F.upper(part(2))),
        "Pais": F.when(src.isNull(), null).otherwise(title_case(country)),
    }).drop(column, "_loc", "_loc_kind", "_loc_parts")


def drop_bad_dates(df: DataFrame, column: str = "Data_Venda") -> DataFrame:
    """Drop rows whose date did not parse."""
    return df.where(F.col(column).isNotNull())


def derive_revenue(df: DataFrame) -> DataFrame:
    """Faturamento = round(Valor_Unitario x Quantidade, 2), exact decimal."""
    return df.withColumn("Faturamento", revenue(F.col("Valor_Unitario"), F.col("Quantidade")))


def row_local_cleaning(df: DataFrame) -> DataFrame:
    """The steps that look at one row at a time (no shuffle)."""
    return df.transform(typed_columns).transform(text_columns)


def typed_columns(df: DataFrame) -> DataFrame:
    """C7 + C8: the steps that make a row narrower."""
    return df.transform(parse_dates).transform(parse_prices)


def text_columns(df: DataFrame) -> DataFrame:
    """C6, C9-C11."""
    return df.transform(place_texts).transform(product_texts)


def place_texts(df: DataFrame) -> DataFrame:
    """C6, C9 and C11 of place, method and status."""
    return (df.transform(impute_constant)
            .transform(lambda d: normalize_text(d, PLACE_TITLES))
            .transform(split_location))


def product_texts(df: DataFrame) -> DataFrame:
    """C9 of the category, C10 of the product."""
    return df.transform(lambda d: normalize_text(d, PRODUCT_TITLES)).transform(trim_text)


def clean_sales(raw: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The whole cleaning job.

    C1 is not run separately: keeping the first copy per transaction id also
    keeps the first of every group of identical rows, so C2 after C1 equals
    C2 alone, and one shuffle is saved.

    `stage` may materialise the de-duplicated, parsed rows (e.g. write them
    to the shared checkpoint folder) so that the median job and the final
    job read them instead of recomputing the upstream joins.
    """
    parsed = parse_stage(raw)
    if stage is not None:
        parsed = stage(parsed)
    return finish_clean(parsed, median_of(parsed, "Quantidade"))


#: Raw text columns that take few values together, and the steps that look at nothing else.
TEXT_GROUPS = {("Localidade_Venda", *PLACE_TITLES): place_texts, ("Nome_Produto", *PRODUCT_TITLES): product_texts}


def parse_stage(raw: DataFrame, stored: bool = False) -> DataFrame:
    """C2 + C3 + the row-local steps C6-C11: the rows the median is taken over.

    Which copy is kept depends on the key and the ordinal alone, so dates and
    prices are parsed before the rows are sorted and shuffled: as text they are wider.
    With `stored` (raw is a written table) text columns travel as numbers (operators.dictionary).
    """
    rows = raw.transform(typed_columns)
    found = dictionaries(raw, *TEXT_GROUPS) if stored else [None] * len(TEXT_GROUPS)
    for words in filter(None, found):
        rows = words.encoded(rows)
    rows = rows.transform(dedupe_keep_first).transform(drop_null_keys).drop(ORDINAL)
    for words, clean in zip(found, TEXT_GROUPS.values()):
        rows = words.decoded(rows, clean(words.values())) if words else clean(rows)
    return rows


def finish_clean(parsed: DataFrame, median: float | None) -> DataFrame:
    """C4 (given the median) + C5, C12, C13 over de-duplicated, parsed rows (row-local)."""
    filled = parsed.transform(lambda d: impute_median(d, median=median)).transform(to_int)
    cleaned = filled.transform(drop_bad_dates).transform(derive_revenue)
    return cleaned.select(*CLEAN_COLUMNS)
