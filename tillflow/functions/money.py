"""Currency parsing and exact money arithmetic.

Money lives in DECIMAL so that sums are exact and independent of the order in
which partitions are combined. Values leave the engine as DOUBLE only at the
report edge, through ``money_out`` / ``ratio_out``, which round half away
from zero on the exact value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.functions.text import strip as _strip

PRICE_TYPE = "decimal(18,6)"
REVENUE_TYPE = "decimal(18,2)"
WIDE = "decimal(38,0)"

# Fixed value: the currency prefix of locale-formatted prices ("R$ 1.234,56").
CURRENCY_PREFIX = "R$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_currency(c: Column | str) -> Column:
    """'R$ 1.234,56' -> 1234.56 and '1234.56' -> 1234.56 as DECIMAL(18,6).

    With the prefix, '.' groups thousands and ',' is the decimal mark; without
    it the text is a plain number. Text that is neither gives NULL.
    """
    text = _strip(_col(c))
    local = _strip(F.replace(text, F.lit(CURRENCY_PREFIX), F.lit("")))
    local = F.replace(F.replace(local, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(text.startswith(CURRENCY_PREFIX), local.try_cast(PRICE_TYPE)) \
        .otherwise(text.try_cast(PRICE_TYPE))


def revenue(price: Column | str, quantity: Column | str) -> Column:
    """round(unit price x quantity, 2) on the exact product."""
    return F.round(_col(price) * _col(quantity).cast(WIDE), 2).cast(REVENUE_TYPE)


def to_units(c: Column | str, scale: int) -> Column:
    """Exact integral number of 10^-scale units (the value must have <= scale decimals)."""
    return (_col(c) * F.lit(10 ** scale)).cast(WIDE)


def div_round(num: Column, den: Column, scale: int) -> Column:
    """round(num / den * 10^scale), half away from zero, as DECIMAL(38,0).

    num and den are exact integers (DECIMAL(38,0) / BIGINT); NULL when den is
    0 or NULL. Integer arithmetic only, so Spark and any SQL engine agree.
    """
    n = num.cast(WIDE)
    d = den.cast(WIDE)
    a = F.abs(n) * F.lit(2 * 10 ** scale) + F.abs(d)
    b = F.abs(d) * F.lit(2)
    q = ((a - a % b) / b).cast(WIDE)
    sign = (F.signum(n) * F.signum(d)).cast(WIDE)
    return F.when(d == 0, F.lit(None).cast(WIDE)).otherwise(sign * q)


def units_out(units: Column, scale: int) -> Column:
    """DECIMAL(38,0) count of 10^-scale units -> DOUBLE (correctly rounded)."""
    return units.cast("double") / F.lit(float(10 ** scale))


def ratio_out(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale) as DOUBLE for exact integer num and den."""
    return units_out(div_round(num, den, scale), scale)


def money_out(c: Column | str) -> Column:
    """Exact 2-decimal money -> DOUBLE."""
    return units_out(to_units(c, 2), 2)


def mean_money_out(total: Column | str, count: Column | str) -> Column:
    """round(total / count, 2) as DOUBLE for an exact 2-decimal total."""
    return ratio_out(to_units(total, 2), _col(count).cast(WIDE) * F.lit(100), 2)


def percent_out(part: Column | str, whole: Column | str, part_scale: int = 0,
                scale: int = 2) -> Column:
    """round(100 * part / whole, scale) as DOUBLE; part and whole have part_scale decimals."""
    return ratio_out(to_units(part, part_scale) * F.lit(100), to_units(whole, part_scale), scale)


def format_brl(c: Column | str) -> Column:
    """'R$ 1.234,56' display string (thousands '.', decimal ',')."""
    return F.concat(F.lit(CURRENCY_PREFIX + " "),
                    F.translate(F.format_number(_col(c).cast("double"), 2), ",.", ".,"))


def format_int_br(c: Column | str) -> Column:
    """'1.234' display string for a count."""
    return F.translate(F.format_number(_col(c).cast("double"), 0), ",", ".")


def report_columns(df, price_cols=("Valor_Unitario",), money_cols=("Faturamento",)) -> list[Column]:
    """Every column of df, with prices (6 decimals) and money (2 decimals) as DOUBLE."""
    return [units_out(to_units(c, 6), 6).alias(c) if c in price_cols
            else money_out(c).alias(c) if c in money_cols else F.col(c) for c in df.columns]


def round_double(c: Column | str, scale: int) -> Column:
    """round(x, scale) for a DOUBLE statistic, with -0.0 written as 0.0."""
    return F.round(_col(c), scale) + F.lit(0.0)
