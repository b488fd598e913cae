"""Exploratory statistics over the enriched sales fact.

Describe, mode, correlation and IQR outliers. Quantiles are exact and
interpolated (operators.quantiles), never approximate; money stays decimal
until the report edge, where values are rounded half away from zero.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import ratio_out, report_columns, round_double, to_units
from tillflow.operators.modelling import enriched_sales
from tillflow.operators.quantiles import COL, quantile_values
from tillflow.plans.warehouse import Star

# The columns profiled and the IQR fence factor.
NUMERIC_COLS = ("Valor_Unitario", "Quantidade", "Faturamento")
CATEGORICAL_COLS = ("Categoria_Produto", "Metodo_Pagamento", "Status_Pedido", "Estado")
IQR_FACTOR = "1.5"
FENCE = "decimal(38,13)"
EXACT = "decimal(38,6)"  # every numeric column fits: scale 6 price, scale 2 revenue, int quantity


def round2(c: Column, scale: int) -> Column:
    """Exact decimal with `scale` decimals -> round(., 2) as DOUBLE."""
    return ratio_out(to_units(c, scale), F.lit(10 ** scale), 2)


def _rows(one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn per-column structs computed on a 1-row aggregate into one row each."""
    return one_row.select(F.inline(F.array(*structs)))


# The row labels of the two describe reports, in order.
NUMERIC_STAT_LABELS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
CATEGORICAL_STAT_LABELS = ("count", "unique", "top", "freq")
_NUMERIC_FIELDS = ("contagem", "media", "desvio_padrao", "minimo", "q25", "q50", "q75", "maximo")
_CATEGORICAL_FIELDS = ("contagem", "unicos", "moda", "frequencia_moda")


def _stat_by_column_layout(by_col: DataFrame, fields, labels, columns, value_type: str) -> DataFrame:
    """One row per statistic, one column per profiled column (the describe layout).

    The input has one row per profiled column; the result is a pivot of a
    handful of rows (statistics x columns), with the pivot values given.
    """
    label = F.create_map(*[x for f, lab in zip(fields, labels) for x in (F.lit(f), F.lit(lab))])
    long = by_col.select(COL, *[F.col(f).cast(value_type).alias(f) for f in fields]) \
        .unpivot(COL, list(fields), "_campo", "_valor") \
        .withColumn("estatistica", label[F.col("_campo")])
    order = F.create_map(*[x for i, lab in enumerate(labels) for x in (F.lit(lab), F.lit(i))])
    wide = long.groupBy("estatistica").pivot(COL, list(columns)).agg(F.first("_valor"))
    return wide.orderBy(order[F.col("estatistica")]).select("estatistica", *columns)


def numeric_stats(s: Star) -> DataFrame:
    """E1 in the describe layout: rows count, mean, std, min, 25%, 50%, 75%, max;
    one DOUBLE column per numeric variable (count as a number, like describe)."""
    return _stat_by_column_layout(numeric_stats_by_column(s), _NUMERIC_FIELDS,
                                  NUMERIC_STAT_LABELS, NUMERIC_COLS, "double")


def categorical_stats(s: Star) -> DataFrame:
    """E2 in the describe layout: rows count, unique, top, freq; one text column per
    categorical variable (the report mixes numbers and the mode)."""
    return _stat_by_column_layout(categorical_stats_by_column(s), _CATEGORICAL_FIELDS,
                                  CATEGORICAL_STAT_LABELS, CATEGORICAL_COLS, "string")


def numeric_stats_by_column(s: Star) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column (rounded to 2).

    One aggregate pass for the moments and extremes; exact quartiles by
    selection (operators.quantiles).
    """
    df = s.fact
    aggs = []
    for i, c in enumerate(NUMERIC_COLS):
        v = F.col(c).cast(EXACT)
        aggs += [F.count(v).alias(f"n{i}"), F.sum(v).alias(f"t{i}"),
                 round_double(F.stddev_samp(F.col(c).cast("double")), 2).alias(f"sd{i}"),
                 F.min(v).alias(f"mn{i}"), F.max(v).alias(f"mx{i}")]
    one = df.agg(*aggs)
    stats = _rows(one, [F.struct(
        F.lit(c).alias(COL), F.col(f"n{i}").alias("contagem"),
        ratio_out(to_units(F.col(f"t{i}"), 6), F.col(f"n{i}") * F.lit(10 ** 6), 2).alias("media"),
        F.col(f"sd{i}").alias("desvio_padrao"),
        round2(F.col(f"mn{i}"), 6).alias("minimo"),
        round2(F.col(f"mx{i}"), 6).alias("maximo")) for i, c in enumerate(NUMERIC_COLS)])
    q = quartiles(s)
    by_col = F.col(COL)
    quart = {name: F.coalesce(*[F.when(by_col == c, round2(_lit_dec(q[(c, p)]), 13))
                                for c in NUMERIC_COLS])
             for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))}
    return stats.select(COL, "contagem", "media", "desvio_padrao", "minimo",
                        *[v.alias(k) for k, v in quart.items()], "maximo")


def categorical_stats_by_column(s: Star) -> DataFrame:
    """Non-null count, distinct values, mode (ties -> smallest value) and its frequency.

    The category is counted by product key first; only those counts meet the dimension.
    """
    plain = [c for c in CATEGORICAL_COLS if c in s.fact.columns]
    long = s.fact.unpivot([], plain, COL, "valor").where(F.col("valor").isNotNull())
    counts = long.groupBy(COL, "valor").agg(F.count(F.lit(1)).alias("n"))
    per_product = s.named(s.fact.groupBy("ID_Produto").agg(F.count(F.lit(1)).alias("_rows")))
    for c in CATEGORICAL_COLS:
        if c not in plain:
            counts = counts.unionByName(per_product.where(F.col(c).isNotNull()).groupBy(
                F.lit(c).alias(COL), F.col(c).alias("valor")).agg(F.sum("_rows").alias("n")))
    return counts.groupBy(COL).agg(
        F.sum("n").alias("contagem"),
        F.count(F.lit(1)).alias("unicos"),
        F.min_by("valor", F.struct(-F.col("n"), F.col("valor"))).alias("moda"),
        F.max("n").alias("frequencia_moda"),
    )


def correlation_matrix(s: Star) -> DataFrame:
    """Pearson correlation of every pair over rows where both are present, rounded to 3.

    covar / (std * std) through try_divide: NULL when a column has zero
    variance (corr() would raise DIVIDE_BY_ZERO under ANSI mode). One pass.
    """
    df = s.fact.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC_COLS])
    aggs = []
    for i, a in enumerate(NUMERIC_COLS):
        for j, b in enumerate(NUMERIC_COLS):
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            xa, xb = F.when(both, F.col(a)), F.when(both, F.col(b))
            r = F.try_divide(F.covar_samp(xa, xb), F.stddev_samp(xa) * F.stddev_samp(xb))
            aggs.append(round_double(r, 3).alias(f"c{i}_{j}"))
    one = df.agg(*aggs)
    return _rows(one, [F.struct(F.lit(a).alias(COL), *[F.col(f"c{i}_{j}").alias(b)
                                                      for j, b in enumerate(NUMERIC_COLS)])
                       for i, a in enumerate(NUMERIC_COLS)])


def quartiles(s: Star, columns=NUMERIC_COLS) -> dict[tuple[str, float], object]:
    """Exact quartiles of the columns {(col, p): Decimal}, each column once per star."""
    known = s.memo.setdefault("quartiles", {})
    new = [c for c in columns if (c, 0.5) not in known]
    if new:
        known.update(quantile_values(s.fact, new, [0.25, 0.5, 0.75], EXACT))
    return known


def fences(s: Star, columns=NUMERIC_COLS) -> dict[str, tuple]:
    """Exact IQR fences of the columns: {col: (q1, q3, lower, upper)} as decimals (six scalars a column)."""
    q, k, out = quartiles(s, columns), Decimal(IQR_FACTOR), {}
    for c in columns:
        q1, q3 = q[c, 0.25], q[c, 0.75]
        out[c] = (None,) * 4 if q1 is None else (q1, q3, q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def _lit_dec(d) -> Column:
    return F.lit(None).cast("decimal(38,13)") if d is None else F.lit(format(d, "f")).cast("decimal(38,13)")


def _is_outlier(c: str, f: tuple) -> Column:
    _, _, lo, hi = f
    if lo is None:
        return F.lit(False)
    v = F.col(c).cast(FENCE)  # the fences' own type: a comparison must not cut their decimals
    return (v < _lit_dec(lo)) | (v > _lit_dec(hi))


def iqr_bounds(s: Star) -> DataFrame:
    """q1, q3, iqr and the fences q1 - 1.5 iqr, q3 + 1.5 iqr (rounded to 4)."""
    f = fences(s)
    one = s.fact.sparkSession.range(1)

    def r4(d) -> Column:
        return ratio_out(to_units(_lit_dec(d), 13), F.lit(10 ** 13), 4)

    structs = []
    for c in NUMERIC_COLS:
        q1, q3, lo, hi = f[c]
        structs.append(F.struct(F.lit(c).alias(COL), r4(q1).alias("q1"), r4(q3).alias("q3"),
                                r4(None if q1 is None else q3 - q1).alias("iqr"),
                                r4(lo).alias("limite_inferior"), r4(hi).alias("limite_superior")))
    return _rows(one, structs)


def _report_cols(df: DataFrame) -> list[Column]:
    return report_columns(df)


def outlier_rows(s: Star, column: str = "Faturamento") -> DataFrame:
    """E5: sales strictly outside the column's IQR fences."""
    f = fences(s, [column])
    df = s.enriched()
    return df.where(_is_outlier(column, f[column])).select(*_report_cols(df))


def outlier_summary(s: Star) -> DataFrame:
    """Per column the number and share (% of all rows, 2 decimals) of outliers."""
    f = fences(s)
    one = s.fact.agg(F.count(F.lit(1)).alias("_n"),
                           *[F.count_if(_is_outlier(c, f[c])).alias(f"_o{i}")
                             for i, c in enumerate(NUMERIC_COLS)])
    return _rows(one, [F.struct(
        F.lit(c).alias("coluna"), F.col(f"_o{i}").alias("qtd_outliers"),
        ratio_out(F.col(f"_o{i}") * F.lit(100), F.col("_n"), 2).alias("pct_outliers"))
        for i, c in enumerate(NUMERIC_COLS)])


def outlier_detail(s: Star) -> DataFrame:
    """Every outlier sale once per column it is an outlier in, tagged with the column.

    One pass: an array of tags per row, exploded; ids are unique after the
    keep-first de-duplication, so (id, column) pairs are unique as well.
    """
    f = fences(s)
    df = s.enriched()
    tags = F.filter(F.array(*[F.when(_is_outlier(c, f[c]), F.lit(c)) for c in NUMERIC_COLS]),
                    lambda t: t.isNotNull())
    return df.select(*_report_cols(df), F.explode(tags).alias("coluna_outlier"))


def top_outliers(s: Star, column: str = "Faturamento", n: int = 10) -> DataFrame:
    """The n largest outliers of the column (ties by transaction id)."""
    f = fences(s, [column])
    order = [F.col(column).desc(), F.col("ID_Transacao").asc()]
    top = s.fact.where(_is_outlier(column, f[column])).orderBy(*order).limit(n)
    df = enriched_sales(top, s.measured_products()).orderBy(*order)  # n rows
    return df.select(*_report_cols(df))


def boxplot_stats(s: Star) -> DataFrame:
    """The numbers behind a box plot: quartiles, whiskers (extreme values inside
    the fences) and the outlier count, per column (rounded to 2). One pass."""
    f = fences(s)
    df = s.fact
    med = quartiles(s)
    aggs, structs = [], []
    for i, c in enumerate(NUMERIC_COLS):
        q1, q3, lo, hi = f[c]
        v = F.col(c).cast(EXACT)
        inside = F.col(c).cast(FENCE).between(_lit_dec(lo), _lit_dec(hi))
        aggs += [F.min(F.when(inside, v)).alias(f"lo{i}"), F.max(F.when(inside, v)).alias(f"hi{i}"),
                 F.count_if(_is_outlier(c, f[c])).alias(f"o{i}")]
        structs.append(F.struct(
            F.lit(c).alias(COL),
            round2(_lit_dec(q1), 13).alias("q1"),
            round2(_lit_dec(med[(c, 0.5)]), 13).alias("mediana"),
            round2(_lit_dec(q3), 13).alias("q3"),
            round2(F.col(f"lo{i}"), 6).alias("bigode_inferior"),
            round2(F.col(f"hi{i}"), 6).alias("bigode_superior"),
            F.col(f"o{i}").alias("qtd_outliers")))
    return _rows(df.agg(*aggs), structs)


def dataset_profile(s: Star) -> DataFrame:
    """Rows, distinct customers and distinct product names of the enriched fact.

    Rows are counted by product key before the join. Every key of the fact is
    in the dimension (both come from the same rows), so the customers need no join.
    """
    customers = s.fact.where(F.col("ID_Produto").isNotNull()).agg(F.count_distinct("ID_Cliente")).scalar()
    per_product = s.named(s.fact.groupBy("ID_Produto").agg(F.count(F.lit(1)).alias("_rows")))
    return per_product.agg(
        F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias("linhas"),
        customers.alias("clientes_unicos"),
        F.count_distinct("Nome_Produto").alias("produtos_unicos"))
