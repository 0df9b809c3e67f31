"""Column functions (scalar, no UDF)."""

from .derive import (  # noqa: F401
    CHANNEL_LABELS, COUNTRY_NAMES, SALES_PATHWAY, WEB_PATHWAY, add_calendar_columns,
    channel_label, country_name, guarded_ratio, keep_or_overwrite, null_on_zero_ratio,
    parse_date, parse_number, split_channel, test_flag, week_start,
)
from .ids import campaign_key, fix_campaign_id, surrogate_key  # noqa: F401
from .text import (  # noqa: F401
    NA_STRINGS, NULL_SENTINEL, cast_id, clean_string, fill_unknown, name_slug,
    normalize_country, normalize_na, null_sentinel, nullif_blank, remove_spaced_letters,
    strip_ws, unknown_to_null,
)
