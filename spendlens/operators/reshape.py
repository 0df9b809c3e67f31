"""Long <-> wide reshaping (R-1 .. R-3, A-14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.derive import parse_number

# Source metric -> funnel stage name, in source order.
WEB_STAGES = {
    "nb_of_sessions": "sessions",
    "nb_of_signups": "signups",
    "nb_of_orders": "orders",
    "nb_of_poslite_items_ordered": "poslite_items_ordered",
}
LEADS_STAGES = {
    "total_impressions": "impressions",
    "total_clicks": "clicks",
    "total_leads": "leads",
    "total_sqls": "sqls",
    "total_meeting_done": "meeting_done",
    "total_signed_leads": "signed_leads",
    "total_pos_lite_deals": "pos_lite_deals",
    "total_fake_leads": "fake_leads",
}
# The 18 id columns of the long/wide funnel tables.
FUNNEL_INDEX = ("date", "country_code", "campaign_id", "pathway", "spend_value",
                "country_name", "year", "month", "week", "day_of_year", "week_start",
                "channel", "channel_3", "channel_4", "channel_5", "channel_6", "channel_7",
                "test")


def _metric(df: DataFrame, name: str) -> Column:
    """A metric as a number: text is parsed, NaN counts as no value."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return parse_number(name)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value) if kind in ("double", "float") else value


def to_long(df: DataFrame, ids: Sequence[str], stages: Mapping[str, str],
            stage_col: str = "funnel_stage", value_col: str = "metric_value") -> DataFrame:
    """Unpivot the metrics present in ``df`` to (stage, value) rows (R-1, R-3).

    Metrics are renamed to their stage names first (no per-row map) and
    parsed to double (bad values -> null).  Null values are kept, like melt.
    """
    present = [m for m in stages if m in df.columns]
    ids = [c for c in ids if c in df.columns]
    prepared = df.select(*ids, *[_metric(df, m).alias(stages[m]) for m in present])
    return prepared.unpivot(ids, [stages[m] for m in present], stage_col, value_col)


def long_to_wide(long_df: DataFrame, index: Sequence[str], stages: Sequence[str],
                 stage_col: str = "funnel_stage", value_col: str = "metric_value",
                 drop_null_keys: bool = True) -> DataFrame:
    """Pivot (stage, value) rows back to one column per stage, summing (R-2, A-14).

    A cell with rows whose values are all null is 0; a stage without any row
    for an index tuple is null.  Rows with a null index column are dropped
    (``pivot_table`` behaviour) unless ``drop_null_keys=False``.

    Written as conditional aggregates over the explicit stage list: one hash
    aggregate with partial aggregation and one exchange (the ``pivot`` API
    plans a second aggregation and shuffle for this).
    """
    index = [c for c in index if c in long_df.columns]
    src = long_df.na.drop(how="any", subset=index) if drop_null_keys else long_df
    st, v = F.col(stage_col), F.col(value_col)
    aggs = []
    for s in stages:
        hit = st == F.lit(s)
        aggs.append(F.when(F.count(F.when(hit, F.lit(1))) > 0,
                           F.coalesce(F.sum(F.when(hit, v)), F.lit(0.0))).alias(s))
    return src.groupBy(*index).agg(*aggs)


def facts_to_wide(df: DataFrame, index: Sequence[str], stages: Mapping[str, str],
                  drop_null_keys: bool = True, dealt_by: Sequence[str] = ()) -> DataFrame:
    """``long_to_wide(to_long(df, index, stages), index, stage names)`` without
    materialising the long rows: every index group holds every stage, so each
    cell is ``coalesce(sum(metric), 0)`` (R-1 + R-2 fused).  ``dealt_by`` names index
    columns to deal the rows by, so that a later aggregate over them needs no exchange."""
    index = [c for c in index if c in df.columns]
    present = [m for m in stages if m in df.columns]
    src = df.na.drop(how="any", subset=index) if drop_null_keys else df
    if dealt_by:
        src = src.select(*index, *present).repartition(*dealt_by)
    return src.groupBy(*index).agg(*[
        F.coalesce(F.sum(_metric(df, m)), F.lit(0.0)).alias(stages[m]) for m in present])
