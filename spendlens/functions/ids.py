"""Id repair and key construction as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col
from .text import strip_ws

# Exact strings that mean "no id" before parsing.
NA_ID_STRINGS = ("<NA>", "nan", "None", "")
# Null marker inside surrogate keys.
KEY_NULL = "<null>"


def fix_campaign_id(c) -> Column:
    """Repair campaign ids that went through floats or spreadsheets.

    strip; NA spellings -> null; cut one ``.000000`` then one ``.0`` suffix;
    scientific notation is parsed as a decimal and rounded half-even to an
    integer (unparsable -> null); keep digits only; no digit -> null.
    An id of digits only is left as it is, without these steps.
    """
    raw = as_col(c).cast("string")
    t = strip_ws(raw)
    t = F.when(~t.isin(*NA_ID_STRINGS), t)
    t = F.regexp_replace(t, r"\.000000$", "")
    t = F.regexp_replace(t, r"\.0$", "")
    parsed = F.bround(t.try_cast("decimal(38,10)"), 0).cast("decimal(38,0)").cast("string")
    t = F.when(F.lower(t).contains("e"), parsed).otherwise(t)
    digits = F.regexp_replace(t, r"[^0-9]", "")
    return F.when(raw.rlike(r"^[0-9]+\z"), raw).otherwise(F.when(digits != F.lit(""), digits))


def campaign_key(campaign_id, slug) -> Column:
    """``id || '__' || coalesce(nullif(slug, ''), 'unknown')``; null id -> null."""
    s = as_col(slug)
    return F.concat(as_col(campaign_id), F.lit("__"),
                    F.coalesce(F.when(s != F.lit(""), s), F.lit("unknown")))


def surrogate_key(*cols) -> Column:
    """Deterministic, null-safe md5 key over the given columns.

    Every part carries its length, so values that hold the separator cannot
    run into each other; a null has no length.
    """
    parts = []
    for c in cols:
        t = as_col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit(KEY_NULL)))
    return F.md5(F.concat_ws("|", *parts))
