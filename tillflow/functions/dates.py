"""Date parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted sale-date text formats, tried in this order; the first
# that parses wins. ISO year-month-day, then day/month/year, then month-day-year.
# One-digit day and month are accepted, trailing text is rejected.
SALE_DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "M-d-yyyy")
# The text shape each format accepts. The shapes do not overlap, so a row is
# parsed with the one format its shape allows (a failed parse is costly).
SALE_DATE_SHAPES = (r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{1,2}-\d{1,2}-\d{4}$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_multi_format_date(c: Column | str, formats=SALE_DATE_FORMATS,
                            shapes=SALE_DATE_SHAPES) -> Column:
    """First format that parses, else NULL (never raises under ANSI mode).

    Equal to coalesce(try_to_date(c, f) for f in formats) because the formats'
    shapes are disjoint; only the format whose shape matches is tried.
    """
    text = _col(c)
    out = None
    for fmt, shape in zip(formats, shapes):
        branch = F.try_to_date(text, fmt)
        out = F.when(text.rlike(shape), branch) if out is None else out.when(text.rlike(shape), branch)
    return out


def weekday_mon0(c: Column | str) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(c))


def week_label(c: Column | str) -> Column:
    """Label of the Monday-Sunday week holding the date: its Sunday."""
    return F.date_add(F.to_date(F.date_trunc("week", _col(c))), 6)


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")
