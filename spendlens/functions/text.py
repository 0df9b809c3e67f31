"""Text normalisers as native Column expressions (no Python UDF).

Every function takes and returns a ``Column`` so it composes inside one
projection and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values that must equal the reference for equal results.
# Spellings that mean "no value" (compared lower-case):
NA_STRINGS = ("<<nan>>", "nan", "none", "<na>", "", "unknown")
# Spellings of "unknown" that the channel repair treats as missing:
UNKNOWN_SPELLINGS = ("unknown", "Unknown", "UNKNOWN")
# Placeholder for null values in profile listings:
NULL_SENTINEL = "<<NaN>>"

# Fixed term repairs of clean_string, in application order (pattern, replacement).
TERM_REPAIRS = (
    (r"p\s*r\s*o\s*s\s*p\s*e\s*c\s*t\s*i\s*n\s*g", "prospecting"),
    (r"s\s*h\s*o\s*p\s*p\s*i\s*n\s*g", "shopping"),
    (r"l\s*a\s*n\s*d\s*i\s*n\s*g", "landing"),
    (r"d\s*e\s*m\s*a\s*n\s*d\s*[-_ ]*\s*g\s*e\s*n", "demandgen"),
    (r"p\s*o\s*s\s*[-_ ]*\s*l\s*i\s*t\s*e", "pos-lite"),
)
# Fixed separator and prefix repairs, in application order, after the term repairs.
SEPARATOR_REPAIRS = (
    (r"\s*-\s*", "-"),
    (r"\s*_\s*", "_"),
    (" ", "_"),
    (r"bing_search_+", "bing-search_"),
    (r"search_shopping_+", "search-shopping_"),
    (r"_+", "_"),
)


# White space of any alphabet, and the four separators U+001C..U+001F.
WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip_ws(c) -> Column:
    """Remove leading and trailing white space of any kind (not only blanks)."""
    return F.regexp_replace(as_col(c), f"^{WS}+|{WS}+$", "")


def clean_string(c) -> Column:
    """Canonical campaign/channel text normaliser.

    lower + strip, collapse white space, repair spaced-out product terms,
    normalise separators to ``-``/``_``, fix search prefixes, squeeze and strip
    ``_``.  Null stays null; the function is idempotent.
    """
    t = F.regexp_replace(strip_ws(F.lower(as_col(c))), f"{WS}+", " ")
    for pattern, repl in TERM_REPAIRS + SEPARATOR_REPAIRS:
        t = F.regexp_replace(t, pattern, repl)
    return F.regexp_replace(t, r"^_+|_+$", "")


def remove_spaced_letters(c) -> Column:
    """Delete white space between single letters: ``p o s lite`` -> ``pos lite``."""
    return F.regexp_replace(as_col(c), rf"(?U)(?<=\b\p{{L}}){WS}+(?=\p{{L}}\b)", "")


def normalize_country(c) -> Column:
    """``upper(trim(x))``."""
    return F.upper(F.trim(as_col(c)))


def nullif_blank(c) -> Column:
    """``nullif(trim(x), '')``."""
    t = F.trim(as_col(c))
    return F.when(t != F.lit(""), t)


def cast_id(c) -> Column:
    """Warehouse id cast: ``cast(trim(cast(id as varchar)) as varchar)``."""
    return F.trim(as_col(c).cast("string"))


def normalize_na(c) -> Column:
    """Null when the lower-cased text is one of the NA spellings (or null)."""
    s = as_col(c).cast("string")
    return F.when(~F.lower(s).isin(*NA_STRINGS), s)


def unknown_to_null(c) -> Column:
    """``unknown``/``Unknown``/``UNKNOWN`` -> null, other values unchanged."""
    s = as_col(c)
    return F.when(~s.isin(*UNKNOWN_SPELLINGS), s)


def fill_unknown(c, value: str = "unknown") -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def null_sentinel(c) -> Column:
    """Null shown as ``<<NaN>>`` (profiling output)."""
    return F.coalesce(as_col(c).cast("string"), F.lit(NULL_SENTINEL))


def name_slug(c) -> Column:
    """Slug of a campaign name: clean, trim, white space -> ``_``, lower."""
    return F.lower(F.regexp_replace(F.trim(clean_string(c)), r"\s+", "_"))
