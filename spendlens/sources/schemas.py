"""Declared schemas of the three marketing sources (never inferred: 18-digit
campaign ids lose digits when read as double)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, TS = T.StringType(), T.LongType(), T.DateType(), T.TimestampType()
MONEY = T.DecimalType(18, 4)

WEB_METRICS = ("nb_of_sessions", "nb_of_signups", "nb_of_orders", "nb_of_poslite_items_ordered")
LEADS_METRICS = ("total_impressions", "total_clicks", "total_leads", "total_sqls",
                 "total_meeting_done", "total_signed_leads", "total_pos_lite_deals",
                 "total_fake_leads")
CHANNEL_COLS = ("channel_3", "channel_4", "channel_5")

CHANNELS = T.StructType([
    T.StructField("campaign_id", S),
    T.StructField("campaign_name", S),
    T.StructField("campaign_period_budget_category", S),
    T.StructField("channel_3", S),
    T.StructField("channel_4", S),
    T.StructField("channel_5", S),
])

WEB_ORDERS = T.StructType(
    [T.StructField("date", D), T.StructField("country_code", S),
     T.StructField("campaign_id", S), T.StructField("total_spend_eur", MONEY)]
    + [T.StructField(m, L) for m in WEB_METRICS]
)

LEADS_FUNNEL = T.StructType(
    [T.StructField("date", D), T.StructField("country_code", S),
     T.StructField("campaign_id", S), T.StructField("campaign_name", S)]
    + [T.StructField(c, S) for c in CHANNEL_COLS]
    + [T.StructField("total_spend", MONEY)]
    + [T.StructField(m, L) for m in LEADS_METRICS]
)

LOADED_AT = T.StructField("_etl_loaded_at", TS)


def with_loaded_at(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [LOADED_AT])
