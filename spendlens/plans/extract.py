"""BI extract of the notebook: derived attributes, long and wide funnel
tables, and the final per-grain table (F-9 .. F-15, R-1 .. R-3, A-5, A-6,
A-14, U-2, P-9, P-15, P-16, S-5, S-6, Q-8).

Plan: everything up to the final table is narrow except the two wide tables
(one hash aggregate each on those of the 18 index columns that decide the others,
partial aggregation first, computed straight from the derived facts) and the final
grain aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import (SALES_PATHWAY, WEB_PATHWAY, add_calendar_columns, channel_label,
                                country_name, keep_or_overwrite, split_channel, test_flag)
from ..operators.aggregates import max_by_grain
from ..operators.quality import assert_unique
from ..operators.reshape import FUNNEL_INDEX, LEADS_STAGES, WEB_STAGES, facts_to_wide, to_long
from ..operators.setops import present, require_columns, union_by_name
from ..sources.io import write_csv

# Grain, metrics and dimensions of the final BI table.
GRAIN = ("date", "country_code", "campaign_id", "pathway", "channel")
FINAL_METRICS = ("spend_value", "orders", "poslite_items_ordered", "sessions", "signups",
                 "clicks", "fake_leads", "impressions", "leads", "meeting_done",
                 "pos_lite_deals", "signed_leads", "sqls")
FINAL_DIMS = ("country_name", "channel_3", "channel_4", "channel_5", "channel_6", "channel_7",
              "test")
DUPLICATE_KEY = ("campaign_id", "date", "pathway")
# Index columns that are worked out from another index column, or are a constant.
FROM_OTHERS = ("pathway", "country_name", "year", "month", "week", "day_of_year", "week_start", "channel",
               "channel_6", "channel_7")


def derive_channel_viz(df: DataFrame, name_col: str = "campaign_name", test_col: str = "test",
                       channel_col: str = "channel", overwrite: bool = False) -> DataFrame:
    """Test flag from the name, channel label from channel_3, channel_6/7 from
    a right split of channel_5 (F-9 .. F-12).  Existing test/channel values are
    only filled where null unless ``overwrite``."""
    cols = {}
    if name_col in df.columns:
        t = test_flag(name_col)
        cols[test_col] = keep_or_overwrite(test_col, t, overwrite) if test_col in df.columns else t
    if "channel_3" in df.columns:
        ch = channel_label("channel_3")
        cols[channel_col] = (keep_or_overwrite(channel_col, ch, overwrite)
                             if channel_col in df.columns else ch)
    if "channel_5" in df.columns:
        cols["channel_6"], cols["channel_7"] = split_channel("channel_5")
    return df.withColumns(cols)


def add_country_name(df: DataFrame, country_col: str = "country_code",
                     out_col: str = "country_name") -> DataFrame:
    """Country name of the code, ``Unknown`` otherwise (F-13)."""
    src = F.col(country_col) if country_col in df.columns else F.lit(None).cast("string")
    return df.withColumn(out_col, country_name(src))


def derive_all(df: DataFrame) -> DataFrame:
    """Notebook stage 7 for one fact."""
    return add_calendar_columns(add_country_name(derive_channel_viz(df)), "date")


def _spend_value(df: DataFrame, prefer: tuple[str, str]) -> F.Column:
    for c in prefer:
        if c in df.columns:
            return F.col(c)
    return F.lit(None).cast("double")


def prep_frame(df: DataFrame, pathway: str, spend_prefer: tuple[str, str]) -> DataFrame:
    """The derived source before unpivoting: lower-case headers, parsed date,
    pathway and spend_value (P-8, P-15, P-16, Q-10)."""
    d = df.toDF(*[c.strip().lower() for c in df.columns])
    require_columns(d, ["date", "campaign_id"], pathway)
    d = d.withColumns({"date": d["date"].try_cast("date"), "pathway": F.lit(pathway),
                       "spend_value": _spend_value(d, spend_prefer)})
    return require_columns(d, FUNNEL_INDEX, pathway)


def final_grain(all_wide: DataFrame) -> DataFrame:
    """Column-wise max per (date, country, campaign, pathway, channel); dims from
    the first row in pivot-index order (A-5, A-6, P-9)."""
    require_columns(all_wide, GRAIN, "all_wide")
    order = [c for c in FUNNEL_INDEX if c not in GRAIN and c in all_wide.columns]
    return max_by_grain(all_wide, GRAIN, present(all_wide, FINAL_METRICS),
                        present(all_wide, FINAL_DIMS), order=order)


def fact_groups(df: DataFrame, pathway: str, spend_prefer: tuple[str, str], stages: Mapping[str, str],
                dealt_by: Sequence[str] = ()) -> DataFrame:
    """The groups of one fact's wide table with their stages, keyed by the index columns that decide
    the others (``FROM_OTHERS``; a label that the fact brings along decides for itself)."""
    full = prep_frame(derive_all(df), pathway, spend_prefer)
    brought = {c.strip().lower() for c in df.columns} & {"channel"}
    own = [c for c in FUNNEL_INDEX if c not in FROM_OTHERS or c in brought]
    # The rest of the index is null only with the column that it is worked out from.
    rows = full.na.drop(how="any", subset=[*own, "channel_6", "channel_7"])
    return facts_to_wide(rows, own, stages, dealt_by=dealt_by)


def fact_wide(df: DataFrame, pathway: str, spend_prefer: tuple[str, str], stages: Mapping[str, str]) -> DataFrame:
    """The wide table of one fact: ``facts_to_wide`` of its derived rows over the whole index.  What
    other index columns decide is worked out again from each group's key, not shuffled as text."""
    groups = fact_groups(df, pathway, spend_prefer, stages)
    wide = derive_all(groups).withColumn("pathway", F.lit(pathway))
    return wide.select(*FUNNEL_INDEX, *[c for c in groups.columns if c not in FUNNEL_INDEX])


def fact_final(df: DataFrame, pathway: str, spend_prefer: tuple[str, str], stages: Mapping[str, str]) -> DataFrame:
    """``final_grain`` of one fact's wide table: one exchange, by the grain, for both aggregates.

    A grain holds rows of one pathway, and its calendar and country are the same in all of them, so
    only the columns that may differ are ranked; what they decide is worked out from the first row."""
    dealt = [c for c in GRAIN if c not in FROM_OTHERS]
    groups = derive_channel_viz(fact_groups(df, pathway, spend_prefer, stages, dealt_by=dealt))
    order = [c for c in groups.columns if c in FUNNEL_INDEX and c not in GRAIN and c not in FROM_OTHERS]
    best = max_by_grain(groups, [c for c in GRAIN if c != "pathway"], present(groups, FINAL_METRICS),
                        [c for c in order if c in FINAL_DIMS], order=order, complete_dims=True)
    return add_country_name(derive_channel_viz(best)).withColumn("pathway", F.lit(pathway))


def build_extract(web: DataFrame, leads: DataFrame) -> dict[str, DataFrame]:
    """All notebook outputs from imputed web and leads facts.

    The wide tables are computed straight from the derived facts (the pivot of
    an unpivot is a group-by), so the long rows are only produced for the long
    outputs themselves.
    """
    facts = ((web, WEB_PATHWAY, ("total_spend_eur", "total_spend"), WEB_STAGES),
             (leads, SALES_PATHWAY, ("total_spend", "total_spend_eur"), LEADS_STAGES))
    wl, ll = [to_long(prep_frame(derive_all(df), pathway, prefer), FUNNEL_INDEX, stages)
              for df, pathway, prefer, stages in facts]
    ww, lw = [fact_wide(*fact) for fact in facts]
    all_wide = union_by_name(ww, lw)
    final = union_by_name(*[fact_final(*fact) for fact in facts])
    final = final.select(*GRAIN, *present(final, FINAL_DIMS), *present(final, FINAL_METRICS))
    return {"web_long": wl, "leads_long": ll, "web_wide": ww, "leads_wide": lw,
            "all_long": union_by_name(wl, ll), "all_wide": all_wide,
            "final": final}


def write_extract(outputs: dict[str, DataFrame], folder: str, unique: tuple = GRAIN, compression: str | None = None) -> None:
    """Long/wide tables as ``;`` CSV (S-5) and the final table as ``,`` CSV (S-6),
    with ``compression`` as ``write_csv`` takes it.

    Nothing is written unless the final table is unique on ``unique`` (those of
    its columns that the table has; Q-8)."""
    if "final" in outputs:
        final = outputs["final"]
        assert_unique(final, [c for c in unique if c in final.columns])
    for name, df in outputs.items():
        write_csv(df, f"{folder.rstrip('/')}/{name}", sep="," if name == "final" else ";", compression=compression)
