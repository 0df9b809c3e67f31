"""Staging projections and fact/dimension models (P-1 .. P-5, S-4, D-8).

The reference mart reads three upstream models it never defines; they are
defined here from the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cast_id, clean_string, normalize_country
from ..operators.dims import dedupe_dim, repair_channels
from ..session import worked_once
from ..sources.schemas import CHANNEL_COLS, LEADS_METRICS, WEB_METRICS

DIM_COLS = ("campaign_id", "campaign_name", "campaign_period_budget_category", *CHANNEL_COLS)


def _keep_rest(df: DataFrame, replaced: dict) -> list:
    return [replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns]


def stg_channels(df: DataFrame) -> DataFrame:
    """Id cast + cleaned name and channels; other columns kept (P-1)."""
    rep = {"campaign_id": cast_id("campaign_id"), "campaign_name": clean_string("campaign_name")}
    rep.update({c: clean_string(c) for c in CHANNEL_COLS})
    return df.select(*_keep_rest(df, rep))


def stg_leads_funnel(df: DataFrame) -> DataFrame:
    """As ``stg_channels``; date and metrics are kept (P-2)."""
    return stg_channels(df)


def stg_web_orders(df: DataFrame) -> DataFrame:
    """Id cast; everything else kept (P-3)."""
    return df.select(*_keep_rest(df, {"campaign_id": cast_id("campaign_id")}))


def dim_campaign_channels(channels: DataFrame) -> DataFrame:
    """One row per campaign id: cleaned, channels repaired from the id's other
    rows, first row in (channel_3, channel_4, channel_5, name, budget) order."""
    staged = worked_once(channels, lambda d: stg_channels(d).withColumn(
        "campaign_period_budget_category", F.trim("campaign_period_budget_category")))
    repaired = repair_channels(staged, "campaign_id", CHANNEL_COLS, fill=False)
    return dedupe_dim(repaired.select(*DIM_COLS), "campaign_id",
                      [*CHANNEL_COLS, "campaign_name", "campaign_period_budget_category"])


def fct_web(web: DataFrame, since=None) -> DataFrame:
    """Web fact with normalised keys (P-4); ``since`` = lookback lower bound."""
    out = web.select("date", normalize_country("country_code").alias("country_code"),
                     cast_id("campaign_id").alias("campaign_id"), "total_spend_eur",
                     *WEB_METRICS)
    return out.where(F.col("date") >= F.lit(since)) if since is not None else out


def fct_leads(leads: DataFrame, since=None, with_fake: bool = False, clean: bool = True) -> DataFrame:
    """Sales-assisted fact with normalised keys and cleaned channels (P-5).

    ``clean=False`` carries the raw channels as ``l_<channel>`` instead: the
    mart cleans only those that the dimension cannot supply.
    """
    metrics = [m for m in LEADS_METRICS if m != "total_fake_leads" or with_fake]
    out = leads.select("date", normalize_country("country_code").alias("country_code"),
                       cast_id("campaign_id").alias("campaign_id"), "total_spend", *metrics,
                       *[clean_string(c).alias(f"l_{c}_clean") if clean else F.col(c).alias(f"l_{c}")
                         for c in CHANNEL_COLS])
    return out.where(F.col("date") >= F.lit(since)) if since is not None else out
