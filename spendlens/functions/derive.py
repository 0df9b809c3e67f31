"""Derived attributes: test flag, channel labels, channel split, country name,
calendar columns, tolerant parsing and ratios."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import as_col
from .text import strip_ws

# channel_3 code -> display label (anything else -> "Unknown").
CHANNEL_LABELS = {
    "fb": "Facebook",
    "bing-search": "Bing Search",
    "bing-shopping": "Bing Shopping",
    "search": "Search",
    "search-shopping": "Search Shopping",
    "max": "Max",
}
# Country code -> country name (anything else -> "Unknown").
COUNTRY_NAMES = {
    "ES": "Spain",
    "GB": "United Kingdom",
    "IE": "Ireland",
    "CH": "Switzerland",
}
UNKNOWN_LABEL = "Unknown"
# Pathway labels of the two funnels.
WEB_PATHWAY = "Website (Self-Service)"
SALES_PATHWAY = "Contact Form (Sales-Assisted)"


def _map_lookup(mapping: dict, c) -> Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(m, as_col(c).cast("string")), F.lit(UNKNOWN_LABEL))


def test_flag(name) -> Column:
    """True when the campaign name contains ``test`` (any case); null -> False."""
    return F.coalesce(F.lower(as_col(name)).contains("test"), F.lit(False))


def channel_label(channel_3) -> Column:
    return _map_lookup(CHANNEL_LABELS, channel_3)


def country_name(country_code) -> Column:
    return _map_lookup(COUNTRY_NAMES, country_code)


def keep_or_overwrite(existing, derived, overwrite: bool) -> Column:
    """Existing value is only filled where null, unless ``overwrite``."""
    return as_col(derived) if overwrite else F.coalesce(as_col(existing), as_col(derived))


def split_channel(channel_5) -> tuple[Column, Column]:
    """Right split on ``_`` with at most two cuts -> (channel_6, channel_7).

    3+ parts: the last two; 2 parts: (second, null); otherwise (null, null).
    """
    text = as_col(channel_5).cast("string")
    cuts = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("_"), F.lit("")))
    last = F.substring_index(text, "_", -1)
    ch6 = (F.when(cuts >= 2, F.substring_index(F.substring_index(text, "_", -2), "_", 1))
           .when(cuts == 1, last))
    ch7 = F.when(cuts >= 2, last)
    return ch6, ch7


def week_start(date_col, start_weekday: int = 2) -> Column:
    """First day of the week containing the date.

    ``start_weekday`` uses 1=Monday..7=Sunday.  The default 2 (Tuesday) is the
    reference behaviour: periods that *end* on Monday.
    """
    d = as_col(date_col).cast("date")
    dow = F.weekday(d) + 1  # 1=Mon..7=Sun
    return F.date_sub(d, F.pmod(dow - F.lit(start_weekday), F.lit(7)).cast("int"))


def add_calendar_columns(df: DataFrame, date_col: str = "date", start_weekday: int = 2,
                         upper: bool = False) -> DataFrame:
    """Year, month, names, ISO week/year, quarter and week start of a date column."""
    d = parse_date(date_col)
    cols = {
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d) + 1,
        "day_name": F.date_format(d, "EEEE"),
        "day_of_year": F.dayofyear(d),
        "week": F.weekofyear(d),
        "iso_year": F.extract(F.lit("YEAROFWEEK"), d),
        "quarter": F.quarter(d),
        "week_start": week_start(d, start_weekday),
    }
    if upper:
        cols = {k.upper(): v for k, v in cols.items()}
    return df.withColumns(cols)


def parse_date(c, *formats: str) -> Column:
    """Tolerant date parse: bad values -> null.  Dates/timestamps pass through."""
    col = as_col(c)
    if not formats:
        return col.try_cast("date")
    return F.coalesce(*[F.try_to_date(col.cast("string"), f) for f in formats])


# Fixed value: spellings of a number; anything else is no number.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_number(c) -> Column:
    """Tolerant numeric parse to double: text that is no plain decimal or
    scientific number (``nan``, ``10d``, ``0x1p3``) and NaN become null;
    spellings of infinity keep their sign."""
    t = F.lower(strip_ws(as_col(c).cast("string")))
    value = F.when(t.rlike(NUMBER), t.try_cast("double"))
    return (value.when(t.isin("inf", "+inf", "infinity", "+infinity"), F.lit(float("inf")))
            .when(t.isin("-inf", "-infinity"), F.lit(float("-inf"))))


def guarded_ratio(num, den) -> Column:
    """``coalesce(num,0)/den`` only when ``coalesce(den,0) > 0``, else null."""
    d = as_col(den).cast("double")
    return F.when(F.coalesce(d, F.lit(0.0)) > 0,
                  F.coalesce(as_col(num).cast("double"), F.lit(0.0)) / d)


def null_on_zero_ratio(num, den) -> Column:
    """``coalesce(num,0)/nullif(den,0)`` in double precision."""
    d = as_col(den).cast("double")
    return F.coalesce(as_col(num).cast("double"), F.lit(0.0)) / F.when(d != 0, d)
