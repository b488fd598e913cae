"""Readers for the driver's parquet tables and the raw sales CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; selecting `columns` here lets the scan prune the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


# Raw sales file layout: ten columns, all nullable. Quantity is DOUBLE because
# a column holding nulls is written as "3.0"; an INT schema would read every
# such value as NULL.
RAW_SALES_SCHEMA = T.StructType([
    T.StructField("ID_Transacao", T.StringType()),
    T.StructField("Data_Venda", T.StringType()),
    T.StructField("ID_Cliente", T.StringType()),
    T.StructField("Nome_Produto", T.StringType()),
    T.StructField("Categoria_Produto", T.StringType()),
    T.StructField("Valor_Unitario", T.StringType()),
    T.StructField("Quantidade", T.DoubleType()),
    T.StructField("Localidade_Venda", T.StringType()),
    T.StructField("Metodo_Pagamento", T.StringType()),
    T.StructField("Status_Pedido", T.StringType()),
])
RAW_COLUMNS = tuple(f.name for f in RAW_SALES_SCHEMA.fields)

# Texts read as missing, as the reference's CSV reader does.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")

ORDINAL = "_ord"
# Whether a raw line could not be read with the schema (too many or too few fields, bad number).
MALFORMED = "_malformed"
_CORRUPT = "_corrupt_record"


def null_na_tokens(df: DataFrame) -> DataFrame:
    """Raw columns: the NA tokens of text columns and NaN in number columns become NULL.

    (Spark's CSV reader turns the text "NaN" into a NaN double; missing values
    must be NULL, which aggregates skip, never NaN, which poisons them.)
    """
    string_cols = {f.name for f in RAW_SALES_SCHEMA.fields if isinstance(f.dataType, T.StringType)}
    double_cols = {f.name for f in RAW_SALES_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)}

    def fix(c: str):
        if c in string_cols:
            return F.when(F.col(c).isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in double_cols:
            return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(F.col(c)).alias(c)
        return F.col(c)
    return df.select(*[fix(c) for c in df.columns])


def csv_reader(reader, multi_line: bool = False):
    """CSV options of the raw sales files: header, RFC 4180 quoting (a quote inside a
    field is doubled). multi_line allows line breaks inside quoted fields; such files
    cannot be split, so it is off unless asked for."""
    return (reader.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line).option("mode", "PERMISSIVE"))


def read_raw_sales_csv(spark: SparkSession, path: str, multi_line: bool = False,
                       mark_malformed: bool = False) -> DataFrame:
    """Raw sales CSV with an explicit schema and an input-order ordinal.

    mark_malformed adds the column `_malformed`: lines that do not fit the
    schema are kept with NULL in the fields that could not be read, and can be
    counted instead of going unnoticed.

    `_ord` orders rows as they appear in the input: by file, then by split,
    then by position inside the split. It is what "keep the first copy" means
    for a file source.
    """
    schema = T.StructType([*RAW_SALES_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    df = csv_reader(spark.read.schema(schema), multi_line).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    marks = [F.col(_CORRUPT).isNotNull().alias(MALFORMED)] if mark_malformed else []
    ordered = df.select(
        *[F.col(c) for c in RAW_COLUMNS], *marks,
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("pos")).alias(ORDINAL),
    )
    return null_na_tokens(ordered)
