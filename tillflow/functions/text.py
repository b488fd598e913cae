"""String cleaning expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Title case as Python's str.title(): every run of cased characters starts
# upper-case and continues lower-case ("CORTA-VENTO 5kg" -> "Corta-Vento 5Kg").
# Cased = lower-, upper- or title-case (Unicode properties, which include
# Other_Lowercase such as the ordinal "ª"), as in Python. Spark's initcap only
# starts words after a space, so a private-use mark plus a space is put between
# every uncased character and the cased one after it, initcap is applied, and
# the marks are removed again.
_MARK = "\ue000"
_CASED = r"[\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}]"
_BEFORE_CASED_RUN = r"([^\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}])(?=" + _CASED + ")"

# The characters Python's str.strip() removes (every character with
# str.isspace(); none lies above U+3000). Spark's trim() only removes spaces.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind, exactly like str.strip()."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def title_case(c: Column | str) -> Column:
    """Title case with a new word after every non-letter, like str.title().

    Spark's initcap alone gives "Corta-vento", "5kg"; this gives
    "Corta-Vento", "5Kg". Empty strings stay empty, NULL stays NULL.
    """
    marked = F.regexp_replace(_col(c), _BEFORE_CASED_RUN, "$1" + _MARK + " ")
    return F.replace(F.initcap(marked), F.lit(_MARK + " "), F.lit(""))


def strip_title(c: Column | str) -> Column:
    return title_case(strip(c))
