"""Sale-location text -> (city, state, country)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.functions.text import strip, title_case

# Fixed value: country used when the text names none.
DEFAULT_COUNTRY = "Brasil"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_location(c: Column | str) -> Column:
    """Struct<city, state, country> from 'City/ST/Country' or 'CITY - ST'.

    The '/' form wins when both separators occur; the third '/' piece is the
    country (default Brasil). In the '-' form the pieces are stripped and the
    second is the state. Text with neither separator keeps the whole text as
    the city, a NULL state and the default country. City and country come out
    in title case, state in upper case; NULL input gives three NULLs.
    """
    text = strip(_col(c))
    slash = F.split(text, "/")
    dash = F.split(text, "-")
    has_slash = text.contains("/")
    has_dash = text.contains("-")
    city = F.when(has_slash, F.try_element_at(slash, F.lit(1))).when(has_dash, strip(F.try_element_at(dash, F.lit(1)))).otherwise(text)
    state = F.when(has_slash, F.try_element_at(slash, F.lit(2))).when(has_dash, strip(F.try_element_at(dash, F.lit(2))))
    country = F.when(has_slash & (F.size(slash) > 2), F.try_element_at(slash, F.lit(3))).otherwise(F.lit(DEFAULT_COUNTRY))
    parsed = F.struct(
        title_case(strip(city)).alias("Cidade"),
        F.upper(strip(state)).alias("Estado"),
        title_case(strip(country)).alias("Pais"),
    )
    null_struct = F.lit(None).cast("struct<Cidade:string,Estado:string,Pais:string>")
    return F.when(_col(c).isNull(), null_struct).otherwise(parsed)
