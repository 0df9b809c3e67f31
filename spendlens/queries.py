"""The registered queries (see ``registry``).

Every query reads the driver tables (through the fixture builders) in full;
SQL texts come from ``oracle``.  Queries whose semantics SQL cannot state in
DuckDB are registered without oracle text (rows-only check).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import oracle as O
from .functions import (add_calendar_columns, campaign_key, cast_id, clean_string, fill_unknown,
                        fix_campaign_id, name_slug, normalize_country, normalize_na, null_sentinel,
                        nullif_blank, remove_spaced_letters, surrogate_key, unknown_to_null)
from .functions.derive import SALES_PATHWAY, WEB_PATHWAY, parse_date, parse_number
from .operators import aggregates as A
from .operators import dims as D
from .operators import joins as J
from .operators import kpi as K
from .operators import quality as Q
from .operators import setops as U
from .operators import windows as W
from .operators.reshape import LEADS_STAGES, WEB_STAGES
from .plans import extract as X
from .plans import impute as I
from .plans.facts import dim_campaign_channels, fct_leads, fct_web, stg_leads_funnel, stg_web_orders
from .plans.daily import LEADS_KEY, LEADS_TRACKED, LOADED_AT, REQUIRED, WEB_KEY, run_daily
from .plans.history import History
from .plans.incremental import build_target, incremental_refresh, lookup, read_target, refresh_landed, write_target
from .plans.landing import Landing, MaxState, QualityState
from .plans.mart import build_mart
from .registry import register
from .session import cut_lineage, scratch_path, stored
from .sources import catalog, fixtures as fx
from .sources.io import read_source, read_table, write_csv
from .sources.schemas import CHANNELS

with_fixtures = O.with_fixtures


def sources(spark: SparkSession, sf_dir: str):
    return (fx.web_orders(spark, sf_dir), fx.leads_funnel(spark, sf_dir),
            fx.channels(spark, sf_dir))


def stored_sources(spark: SparkSession, sf_dir: str):
    """The sources with both facts derived once: what follows only reads them."""
    web, leads, ch = sources(spark, sf_dir)
    return stored(web), stored(leads), ch


def mart(spark, sf_dir, grain="country"):
    web, leads, ch = sources(spark, sf_dir)
    return build_mart(web, leads, ch, grain=grain)


def imputed(spark, sf_dir):
    web, leads, ch = sources(spark, sf_dir)
    return I.impute_campaigns(I.prepare_web(web, ch), I.prepare_leads(leads))


def extract(spark, sf_dir):
    # The facts are read twice: for what decides the fill, and for the fill.
    w, l, _ = I.impute_by_value(*stored_sources(spark, sf_dir))
    return X.build_extract(w, l)


# ------------------------------------------------------------------ the mart
@register("mart_country", O.mart_sql("country"))
def mart_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir, "country")


@register("mart_campaign", O.mart_sql("campaign"))
def mart_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir, "campaign")


@register("combine_funnels", with_fixtures(*O.mart_ctes(), body="SELECT * FROM combined"))
def combine_funnels(spark, sf_dir):
    web, leads, _ = sources(spark, sf_dir)
    return J.combine_funnels(fct_web(web), fct_leads(leads))


@register("dim_channels", with_fixtures(*O.DIM_CTES, body="SELECT * FROM dim"))
def dim_channels(spark, sf_dir):
    return dim_campaign_channels(fx.channels(spark, sf_dir))


# --------------------------------------------------------- column functions
_DIRTY = """CASE p_partkey % 6
  WHEN 0 THEN '  ' || upper(p_type) || '  P r o s p e c t i n g__' || p_brand
  WHEN 1 THEN p_brand || ' pos   lite ' || p_type
  WHEN 2 THEN 'Demand - Gen ' || p_type
  WHEN 3 THEN 'bing search ' || lower(p_brand)
  WHEN 4 THEN 'search shopping  ' || p_type || ' _ '
  ELSE chr(9) || p_name || ' ' || chr(9) || '- c_' END"""


def _dirty_text(part: DataFrame):
    m = F.col("p_partkey") % 6
    return (F.when(m == 0, F.concat(F.lit("  "), F.upper("p_type"),
                                     F.lit("  P r o s p e c t i n g__"), F.col("p_brand")))
            .when(m == 1, F.concat("p_brand", F.lit(" pos   lite "), "p_type"))
            .when(m == 2, F.concat(F.lit("Demand - Gen "), "p_type"))
            .when(m == 3, F.concat(F.lit("bing search "), F.lower("p_brand")))
            .when(m == 4, F.concat(F.lit("search shopping  "), "p_type", F.lit(" _ ")))
            .otherwise(F.concat(F.lit("\t"), "p_name", F.lit(" \t- c_"))))


_CLEAN = O.duck_clean("raw_text")


@register("clean_text", f"""
SELECT p_partkey, raw_text, {_CLEAN} AS cleaned, nullif(trim({_CLEAN}), '') AS cleaned_or_null,
       lower(regexp_replace(trim({_CLEAN}), '\\s+', '_', 'g')) AS slug,
       CAST(p_partkey AS VARCHAR) || '__' || coalesce(nullif(lower(regexp_replace(trim({_CLEAN}),
            '\\s+', '_', 'g')), ''), 'unknown') AS campaign_key,
       upper(trim(p_brand)) AS brand_code
FROM (SELECT p_partkey, p_brand, {_DIRTY} AS raw_text FROM part)""")
def clean_text(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    t = part.select("p_partkey", "p_brand", _dirty_text(part).alias("raw_text"))
    return t.select("p_partkey", "raw_text", clean_string("raw_text").alias("cleaned"),
                    nullif_blank(clean_string("raw_text")).alias("cleaned_or_null"),
                    name_slug("raw_text").alias("slug"),
                    campaign_key(F.col("p_partkey").cast("string"), name_slug("raw_text"))
                    .alias("campaign_key"),
                    normalize_country("p_brand").alias("brand_code"))


# Split on white space; a blank goes where both neighbours are single letters.
@register("remove_spaced_letters", r"""
SELECT p_partkey, raw_text,
       array_to_string(list_transform(range(1, len(w) + 1), lambda i: w[i] || CASE
           WHEN i = len(w) THEN ''
           WHEN regexp_matches(w[i], '^(.*[^\p{L}\p{N}_])?\p{L}$') AND regexp_matches(w[i + 1], '^\p{L}([^\p{L}\p{N}_].*)?$') THEN ''
           ELSE ' ' END), '') AS joined
FROM (SELECT p_partkey, raw_text, string_split(raw_text, ' ') AS w
      FROM (SELECT p_partkey, 'p o s lite ' || array_to_string(string_split(p_brand, ''), ' ') AS raw_text FROM part))""")
def spaced_letters(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    raw = F.concat(F.lit("p o s lite "), F.concat_ws(" ", F.split(F.col("p_brand"), "")))
    return part.select("p_partkey", raw.alias("raw_text"),
                       remove_spaced_letters(raw).alias("joined"))


_RAW_ID = """CASE p_partkey % 8
  WHEN 0 THEN CAST(p_partkey AS VARCHAR)
  WHEN 1 THEN CAST(p_partkey AS VARCHAR) || '.0'
  WHEN 2 THEN '  ' || CAST(p_partkey AS VARCHAR) || '.000000 '
  WHEN 3 THEN substr(CAST(p_partkey AS VARCHAR), 1, 1) || '.' || substr(CAST(p_partkey AS VARCHAR), 2, 100) || 'e' || CAST(length(CAST(p_partkey AS VARCHAR)) - 1 AS VARCHAR)
  WHEN 4 THEN upper(substr(CAST(p_partkey AS VARCHAR), 1, 1) || '.' || substr(CAST(p_partkey AS VARCHAR), 2, 100) || 'e' || CAST(length(CAST(p_partkey AS VARCHAR)) - 1 AS VARCHAR))
  WHEN 5 THEN CASE WHEN p_partkey % 16 = 5 THEN 'nan' ELSE 'None' END
  WHEN 6 THEN 'te' || CAST(p_partkey AS VARCHAR) || 't'
  ELSE split_part(p_name, ' ', 1) || CAST(p_partkey AS VARCHAR) END"""
RAW_IDS_CTE = f"raw_ids AS (SELECT p_partkey, {_RAW_ID} AS raw_id FROM part)"


@register("fix_ids", f"""WITH {RAW_IDS_CTE}
SELECT p_partkey, raw_id, {O.duck_fix_id('raw_id')} AS campaign_id FROM raw_ids""")
def fix_ids(spark, sf_dir):
    return fx.raw_ids(spark, sf_dir).withColumn("campaign_id", fix_campaign_id("raw_id"))


_NA_RAW = """CASE p_partkey % 8 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN '<NA>'
  WHEN 3 THEN '' WHEN 4 THEN 'UNKNOWN' WHEN 5 THEN NULL WHEN 6 THEN '  ' || p_brand || ' '
  ELSE 'Unknown' END"""


@register("normalize_na", f"""
SELECT p_partkey, raw_value, {O.duck_na('raw_value')} AS na_normalized,
       {O.duck_unknown('raw_value')} AS unknown_null,
       coalesce({O.duck_unknown('raw_value')}, 'unknown') AS unknown_filled,
       coalesce(CAST({O.duck_na('raw_value')} AS VARCHAR), '<<NaN>>') AS sentinel,
       nullif(trim(raw_value), '') AS blank_null, trim(CAST(raw_value AS VARCHAR)) AS id_cast
FROM (SELECT p_partkey, {_NA_RAW} AS raw_value FROM part)""")
def normalize_na_q(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    m = F.col("p_partkey") % 8
    raw = (F.when(m == 0, "nan").when(m == 1, "None").when(m == 2, "<NA>").when(m == 3, "")
           .when(m == 4, "UNKNOWN").when(m == 5, F.lit(None).cast("string"))
           .when(m == 6, F.concat(F.lit("  "), "p_brand", F.lit(" "))).otherwise("Unknown"))
    t = part.select("p_partkey", raw.alias("raw_value"))
    return t.select("p_partkey", "raw_value", normalize_na("raw_value").alias("na_normalized"),
                    unknown_to_null("raw_value").alias("unknown_null"),
                    fill_unknown(unknown_to_null("raw_value")).alias("unknown_filled"),
                    null_sentinel(normalize_na("raw_value")).alias("sentinel"),
                    nullif_blank("raw_value").alias("blank_null"),
                    cast_id("raw_value").alias("id_cast"))


@register("calendar", """
SELECT o_orderkey, d AS date, year(d) AS year, month(d) AS month, monthname(d) AS month_name,
       day(d) AS day, isodow(d) AS day_of_week, dayname(d) AS day_name,
       dayofyear(d) AS day_of_year, weekofyear(d) AS week, isoyear(d) AS iso_year,
       quarter(d) AS quarter, CAST(d - CAST((isodow(d) - 2 + 7) % 7 AS INTEGER) AS DATE) AS week_start
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def calendar(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey",
                                                   F.col("o_orderdate").cast("date").alias("date"))
    return add_calendar_columns(o, "date")


@register("channel_viz", with_fixtures(*O.PREP_CTES, O.duck_derive(
    "web_p", "web_v", WEB_PATHWAY, "total_spend_eur"), body="""
SELECT date, country_code, campaign_id, test, channel, channel_6, channel_7, country_name
FROM web_v"""))
def channel_viz(spark, sf_dir):
    web, _, ch = sources(spark, sf_dir)
    d = X.add_country_name(X.derive_channel_viz(I.prepare_web(web, ch)))
    return d.select("date", "country_code", "campaign_id", "test", "channel", "channel_6",
                    "channel_7", "country_name")


# ------------------------------------------------------------ dims / joins
@register("prepared_channels", with_fixtures(*O.PREP_CTES, body="SELECT * FROM chp"))
def prepared_channels(spark, sf_dir):
    return I.prepare_channels(fx.channels(spark, sf_dir))


@register("first_last_by_campaign", with_fixtures(body="""
SELECT campaign_id,
       arg_min(country_code, {'a': date, 'b': coalesce(country_code, '')})
           FILTER (WHERE country_code IS NOT NULL) AS first_country,
       arg_min(total_spend_eur, {'a': date, 'b': coalesce(country_code, '')}) AS first_spend,
       arg_max(country_code, {'a': date, 'b': coalesce(country_code, '')})
           FILTER (WHERE country_code IS NOT NULL) AS last_country,
       arg_max(total_spend_eur, {'a': date, 'b': coalesce(country_code, '')}) AS last_spend
FROM web GROUP BY campaign_id"""))
def first_last_by_campaign(spark, sf_dir):
    web = fx.web_orders(spark, sf_dir)
    order = ["date", F.coalesce("country_code", F.lit(""))]
    out = D.first_last_non_null(web, "campaign_id", ["country_code", "total_spend_eur"], order)
    return out.withColumnsRenamed({"first_country_code": "first_country",
                                   "first_total_spend_eur": "first_spend",
                                   "last_country_code": "last_country",
                                   "last_total_spend_eur": "last_spend"})


@register("attach_channels", with_fixtures(*O.PREP_CTES, body="SELECT * FROM web_p"))
def attach_channels(spark, sf_dir):
    web, _, ch = sources(spark, sf_dir)
    return I.prepare_web(web, ch)


@register("update_from_lookup", with_fixtures(*O.PREP_CTES, f"""lk AS (
  SELECT {O.duck_fix_id('campaign_id')} AS campaign_id,
         max({O.duck_clean('campaign_name')}) AS campaign_name,
         max({O.duck_clean('channel_3')}) AS channel_3, max({O.duck_clean('channel_4')}) AS channel_4,
         max({O.duck_clean('channel_5')}) AS channel_5
  FROM channels GROUP BY 1)""", body=f"""
SELECT l.date, l.country_code, l.campaign_id,
       coalesce(k.campaign_name, l.campaign_name) AS campaign_name,
       coalesce(k.channel_3, l.channel_3) AS channel_3, coalesce(k.channel_4, l.channel_4) AS channel_4,
       coalesce(k.channel_5, l.channel_5) AS channel_5, l.total_spend, {', '.join('l.' + m for m in O.ALL_LEADS_M)}
FROM leads_p l LEFT JOIN lk k ON l.campaign_id = k.campaign_id"""))
def update_from_lookup(spark, sf_dir):
    _, leads, ch = sources(spark, sf_dir)
    staged = ch.select(fix_campaign_id("campaign_id").alias("campaign_id"),
                       *[clean_string(c).alias(c) for c in
                         ("campaign_name", "channel_3", "channel_4", "channel_5")])
    lookup = A.reconcile_max(staged, ["campaign_id"],
                             ["campaign_name", "channel_3", "channel_4", "channel_5"])
    return J.update_from_lookup(I.prepare_leads(leads), lookup, "campaign_id")


@register("overlap_rows", with_fixtures(body="""
SELECT * FROM web w WHERE EXISTS (
  SELECT 1 FROM leads l WHERE l.campaign_id = w.campaign_id AND l.date = w.date)"""))
def overlap_rows(spark, sf_dir):
    web, leads, _ = sources(spark, sf_dir)
    return J.restrict_to_overlap(web, leads, ["campaign_id", "date"])


@register("common_campaign_days", with_fixtures(body="""
SELECT campaign_id, date FROM web WHERE campaign_id IS NOT NULL AND date IS NOT NULL
INTERSECT SELECT campaign_id, date FROM leads WHERE campaign_id IS NOT NULL AND date IS NOT NULL"""))
def common_campaign_days(spark, sf_dir):
    web, leads, _ = sources(spark, sf_dir)
    return U.common_ids(web, leads, ["campaign_id", "date"])


@register("referential", with_fixtures(*O.DIM_CTES, RAW_IDS_CTE, body=f"""
SELECT * FROM (SELECT p_partkey, raw_id, {O.duck_fix_id('raw_id')} AS campaign_id FROM raw_ids) f
WHERE campaign_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.campaign_id = f.campaign_id)"""))
def referential(spark, sf_dir):
    ids = fx.raw_ids(spark, sf_dir).withColumn("campaign_id", fix_campaign_id("raw_id"))
    return Q.check_referential(ids, dim_campaign_channels(fx.channels(spark, sf_dir)))


# ---------------------------------------------------------------- imputation
@register("campaign_maps", with_fixtures(*O.IMPUTE_CTES, body="""
SELECT 'id_to_name' AS direction, campaign_id AS map_key, m_name AS map_value FROM id2name
UNION ALL SELECT 'name_to_id', campaign_name, m_id FROM name2id"""))
def campaign_maps(spark, sf_dir):
    web, leads, ch = sources(spark, sf_dir)
    i2n, n2i = I.campaign_maps(I.summarize(I.normalized(I.prepare_web(web, ch), I.prepare_leads(leads))))
    return (i2n.select(F.lit("id_to_name").alias("direction"), F.col(I.KEY_ID).alias("map_key"),
                       F.col("_name").alias("map_value"))
            .unionByName(n2i.select(F.lit("name_to_id").alias("direction"),
                                    F.col(I.KEY_NAME).alias("map_key"),
                                    F.col("_id").alias("map_value"))))


@register("reference_by_id", with_fixtures(*O.IMPUTE_CTES, body="SELECT * FROM ref_id"))
def reference_by_id(spark, sf_dir):
    return imputed(spark, sf_dir)[2]


@register("reference_by_name", with_fixtures(*O.IMPUTE_CTES, body="SELECT * FROM ref_name"))
def reference_by_name(spark, sf_dir):
    web, leads, ch = sources(spark, sf_dir)
    return I.references(I.normalized(I.prepare_web(web, ch), I.prepare_leads(leads)))[3]


@register("impute_web", with_fixtures(*O.IMPUTE_CTES, body="SELECT * FROM web_f"))
def impute_web(spark, sf_dir):
    return imputed(spark, sf_dir)[0]


@register("impute_leads", with_fixtures(*O.IMPUTE_CTES, body="SELECT * FROM leads_f"))
def impute_leads(spark, sf_dir):
    return imputed(spark, sf_dir)[1]


# ------------------------------------------------------------ reshape / grain
_EXTRACT = O.EXTRACT_CTES


@register("web_long", with_fixtures(*_EXTRACT, body=O.duck_long("web_d", O.WEB_STAGE)))
def web_long(spark, sf_dir):
    return extract(spark, sf_dir)["web_long"]


@register("leads_long", with_fixtures(*_EXTRACT, body=O.duck_long("leads_d", O.LEADS_STAGE)))
def leads_long(spark, sf_dir):
    return extract(spark, sf_dir)["leads_long"]


@register("web_wide", with_fixtures(*_EXTRACT, body="SELECT * FROM web_w"))
def web_wide(spark, sf_dir):
    return extract(spark, sf_dir)["web_wide"]


@register("all_wide", with_fixtures(*_EXTRACT, body="SELECT * FROM all_wide"))
def all_wide(spark, sf_dir):
    return extract(spark, sf_dir)["all_wide"]


@register("final_grain", O.FINAL_SQL)
def final_grain(spark, sf_dir):
    return extract(spark, sf_dir)["final"]


def _final_cte_sql(body: str) -> str:
    head, select = O.FINAL_SQL.rsplit("\nSELECT ", 1)
    return head + ",\nfinal AS (SELECT " + select + ")\n" + body


@register("grain_duplicates", _final_cte_sql("""
SELECT f.* FROM final f JOIN (SELECT campaign_id, date, pathway FROM final
  GROUP BY ALL HAVING count(*) > 1) d
  ON f.campaign_id IS NOT DISTINCT FROM d.campaign_id AND f.date IS NOT DISTINCT FROM d.date
 AND f.pathway IS NOT DISTINCT FROM d.pathway"""))
def grain_duplicates(spark, sf_dir):
    # the final table is read twice (count + semi join): materialise it once
    final = stored(extract(spark, sf_dir)["final"])
    return W.duplicate_rows(final, X.DUPLICATE_KEY)


@register("grain_duplicate_groups", _final_cte_sql("""
SELECT campaign_id, date, pathway, count(*) AS n_rows FROM final
GROUP BY ALL HAVING count(*) > 1"""))
def grain_duplicate_groups(spark, sf_dir):
    return A.duplicate_groups(extract(spark, sf_dir)["final"], X.DUPLICATE_KEY)


# ----------------------------------------------------------------- profiling
def _profile_sql(src: str, key: str, other: str) -> str:
    unp = " UNION ALL ".join(
        f"SELECT coalesce(CAST({key} AS VARCHAR), '<<NaN>>') AS {key}, '{c}' AS profile_col, "
        f"coalesce(CAST({c} AS VARCHAR), '<<NaN>>') AS v FROM {src}" for c in O.CH)
    return f"""
SELECT v.{key}, v.profile_col, v.col_values, v.col_nunique,
       o.{other}_values, o.{other}_nunique
FROM (SELECT {key}, profile_col, string_agg(v, '|' ORDER BY v) AS col_values,
             count(*) AS col_nunique
      FROM (SELECT DISTINCT * FROM ({unp})) GROUP BY {key}, profile_col) v
LEFT JOIN (SELECT {key}, string_agg(x, '|' ORDER BY x) AS {other}_values,
                  count(*) AS {other}_nunique
           FROM (SELECT DISTINCT coalesce(CAST({key} AS VARCHAR), '<<NaN>>') AS {key},
                        coalesce(CAST({other} AS VARCHAR), '<<NaN>>') AS x FROM {src})
           GROUP BY {key}) o ON v.{key} = o.{key}"""


@register("profile_leads_by_id", with_fixtures(*O.PREP_CTES, body=_profile_sql(
    "leads_p", "campaign_id", "campaign_name")))
def profile_leads_by_id(spark, sf_dir):
    leads = I.prepare_leads(fx.leads_funnel(spark, sf_dir))
    return A.profile_by(leads, "campaign_id", ["channel_3", "channel_4", "channel_5"],
                        "campaign_name", sep="|")


@register("profile_channels_by_name", with_fixtures(body=_profile_sql(
    "channels", "campaign_name", "campaign_id")))
def profile_channels_by_name(spark, sf_dir):
    return A.profile_by(fx.channels(spark, sf_dir), "campaign_name",
                        ["channel_3", "channel_4", "channel_5"], "campaign_id", sep="|")


def _long_sql(src: str, key: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT coalesce(CAST({key} AS VARCHAR), '<<NaN>>') AS {key}, '{c}' AS profile_col, "
        f"coalesce(CAST({c} AS VARCHAR), '<<NaN>>') AS value, count(*) AS n FROM {src} GROUP BY ALL" for c in cols)


_PROFILED = ("channel_3", "channel_4", "channel_5")


@register("profile_leads_long", with_fixtures(*O.PREP_CTES, body=_long_sql("leads_p", "campaign_id", (*_PROFILED, "campaign_name", "country_code"))))
def profile_leads_long(spark, sf_dir):
    """Every distinct value of every profiled column per campaign, with its number of rows."""
    return A.value_counts(I.prepare_leads(fx.leads_funnel(spark, sf_dir)), "campaign_id", [*_PROFILED, "campaign_name", "country_code"])


@register("profile_channels_long", with_fixtures(body=_long_sql("channels", "campaign_name", (*_PROFILED, "campaign_id"))))
def profile_channels_long(spark, sf_dir):
    return A.value_counts(fx.channels(spark, sf_dir), "campaign_name", [*_PROFILED, "campaign_id"])


@register("distinct_rollup", with_fixtures(body="""
SELECT country_code, count(DISTINCT campaign_id) AS campaigns, count(DISTINCT date) AS days,
       true AS campaigns_within, true AS days_within
FROM web GROUP BY country_code"""))
def distinct_rollup(spark, sf_dir):
    """Campaigns and days per country: exact, and from daily sketches that are merged
    without the facts; the estimates lie within five standard errors (8 %)."""
    web = fx.web_orders(spark, sf_dir)
    daily = cut_lineage(A.distinct_sketches(web.withColumn("day", F.unix_date("date")), ["date", "country_code"], ["campaign_id", "day"]))
    est = A.roll_up_sketches(daily, ["country_code"], ["campaign_id", "day"]).withColumnRenamed("country_code", "_c")
    exact = web.groupBy("country_code").agg(A.count_distinct("campaign_id").alias("campaigns"), A.count_distinct("date").alias("days"))
    near = lambda e, x: F.abs(F.coalesce(e, F.lit(0)) - x) <= 0.08 * x
    return (exact.join(est, exact["country_code"].eqNullSafe(est["_c"]))
            .select("country_code", "campaigns", "days", near(F.col("campaign_id_distinct"), F.col("campaigns")).alias("campaigns_within"),
                    near(F.col("day_distinct"), F.col("days")).alias("days_within")))


@register("attach_dim_large", with_fixtures(*O.DIM_CTES, body="""
SELECT w.*, d.* EXCLUDE (campaign_id) FROM web w LEFT JOIN dim d ON w.campaign_id = d.campaign_id"""))
def attach_dim_large(spark, sf_dir):
    """The channel dimension joined as if it were past the broadcast bound: rows
    without id apart, hot campaigns by broadcast, the rest shuffled."""
    dim = dim_campaign_channels(fx.channels(spark, sf_dir))
    return J.attach_dim(fx.web_orders(spark, sf_dir), dim, max_rows=0)


@register("name_id_cardinality", with_fixtures(body="""
SELECT campaign_name, string_agg(campaign_id, '|' ORDER BY campaign_id) AS campaign_id_values,
       count(*) AS campaign_id_nunique
FROM (SELECT DISTINCT coalesce(campaign_name, '<<NaN>>') AS campaign_name,
             coalesce(campaign_id, '<<NaN>>') AS campaign_id FROM channels)
GROUP BY campaign_name"""))
def name_id_cardinality(spark, sf_dir):
    return A.cardinality(fx.channels(spark, sf_dir), "campaign_name", "campaign_id", sep="|")


@register("bijection", with_fixtures(body="""
SELECT direction, key, n_partners FROM (
  SELECT 'id_to_name' AS direction, campaign_id AS key, count(*) AS n_partners
  FROM (SELECT DISTINCT trim(campaign_id) AS campaign_id, campaign_name FROM channels
        WHERE campaign_id IS NOT NULL AND campaign_name IS NOT NULL) GROUP BY campaign_id
  UNION ALL
  SELECT 'name_to_id', campaign_name, count(*)
  FROM (SELECT DISTINCT trim(campaign_id) AS campaign_id, campaign_name FROM channels
        WHERE campaign_id IS NOT NULL AND campaign_name IS NOT NULL) GROUP BY campaign_name)
WHERE n_partners > 1"""))
def bijection(spark, sf_dir):
    ch = fx.channels(spark, sf_dir).withColumn("campaign_id", cast_id("campaign_id"))
    return Q.check_bijection(ch)


# ------------------------------------------------- history / reconciliation
HISTORY_CTE = f"""history AS (
  SELECT date, country_code, campaign_id,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS total_spend_eur,
         CAST(sum(l_quantity) * 100 AS BIGINT) AS impressions,
         CAST(date AS TIMESTAMP) + INTERVAL 30 HOUR AS _etl_loaded_at
  FROM fact_lines WHERE l_returnflag <> 'R' AND l_linestatus = 'F' GROUP BY date, country_code, campaign_id
  UNION ALL
  SELECT date, country_code, campaign_id,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)),
         CAST(sum(l_quantity) * 100 AS BIGINT), CAST(date AS TIMESTAMP) + INTERVAL 54 HOUR
  FROM fact_lines WHERE l_returnflag <> 'R' GROUP BY date, country_code, campaign_id
)"""


@register("reconcile_max", with_fixtures(HISTORY_CTE, body="""
SELECT campaign_id, date, country_code, max(total_spend_eur) AS total_spend_eur,
       max(impressions) AS impressions
FROM history GROUP BY campaign_id, date, country_code"""))
def reconcile_max(spark, sf_dir):
    h = fx.web_load_history(spark, sf_dir)
    return A.reconcile_max(h, ["campaign_id", "date", "country_code"],
                           ["total_spend_eur", "impressions"])


def _key_part(x: str) -> str:
    t = f"CAST({x} AS VARCHAR)"
    return f"coalesce(length({t}) || ':' || {t}, '<null>')"


_SNAPSHOT_KEY = "md5(concat_ws('|', " + ", ".join(
    _key_part(c) for c in ("campaign_id", "date", "country_code", "_etl_loaded_at")) + "))"


# Rows without campaign id are no versions of each other: their content keeps them apart.
_APART = "CASE WHEN campaign_id IS NULL THEN concat_ws('|', total_spend_eur, impressions) END"


@register("snapshot_history", with_fixtures(HISTORY_CTE, f"""hist_changed AS (
  SELECT *, (lag(_etl_loaded_at) OVER w IS NULL
             OR lag(total_spend_eur) OVER w IS DISTINCT FROM total_spend_eur
             OR lag(impressions) OVER w IS DISTINCT FROM impressions) AS changed
  FROM history WINDOW w AS (PARTITION BY campaign_id, date, country_code, {_APART} ORDER BY _etl_loaded_at))""",
    "kept AS (SELECT * EXCLUDE (changed) FROM hist_changed WHERE changed)", body=f"""
SELECT *, _etl_loaded_at AS valid_from,
       lead(_etl_loaded_at) OVER (PARTITION BY campaign_id, date, country_code, {_APART}
                                  ORDER BY _etl_loaded_at) AS valid_to,
       lead(_etl_loaded_at) OVER (PARTITION BY campaign_id, date, country_code, {_APART}
                                  ORDER BY _etl_loaded_at) IS NULL AS is_current,
       {_SNAPSHOT_KEY} AS snapshot_key
FROM kept"""))
def snapshot_history(spark, sf_dir):
    h = fx.web_load_history(spark, sf_dir)
    s = W.snapshot(h, ["campaign_id", "date", "country_code"], "_etl_loaded_at",
                   ["total_spend_eur", "impressions"], required=["campaign_id", "date"])
    return s.withColumn("snapshot_key", surrogate_key("campaign_id", "date", "country_code",
                                                      "_etl_loaded_at"))


def _leads_load(number: int, where: str, days: int, more: int = 0) -> str:
    return f"""SELECT date, country_code, campaign_id, campaign_name, channel_3, channel_4, channel_5,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS total_spend,
         CAST(sum(l_quantity) * 100 AS BIGINT) AS total_impressions, CAST(sum(l_quantity) + {more} AS BIGINT) AS total_leads,
         CAST(date AS TIMESTAMP) + INTERVAL {24 * days + 6} HOUR AS _etl_loaded_at, {number} AS load
  FROM lead_lines WHERE {where} GROUP BY ALL"""


_LEADS_TEXT_SQL = """lead_lines AS (
  SELECT *, CASE WHEN k % 4 = 0 THEN 'Lead  Campaign_' || CAST(k AS VARCHAR) END AS campaign_name,
         CASE k % 3 WHEN 0 THEN 'Search ' WHEN 1 THEN 'fb' END AS channel_3,
         CASE k % 3 WHEN 0 THEN 'search  prospecting' WHEN 1 THEN 'fb' || chr(160) || 'prospecting' END AS channel_4,
         CASE k % 3 WHEN 0 THEN 'search  prospecting  Generic ' WHEN 1 THEN 'fb prospecting Video' END AS channel_5
  FROM fact_lines WHERE l_returnflag = 'R')"""
# A group without id may hold several campaigns; it has a third load if one of them is a fifth.
_THIRD = """(date, country_code, coalesce(campaign_id, ''), coalesce(campaign_name, ''), coalesce(channel_3, '')) IN (
    SELECT (date, country_code, coalesce(campaign_id, ''), coalesce(campaign_name, ''), coalesce(channel_3, ''))
    FROM lead_lines WHERE k % 5 = 0)"""
LEADS_HISTORY_CTES = (_LEADS_TEXT_SQL, f"""leads_history AS (
  {_leads_load(1, "l_linestatus = 'F'", 1)}
  UNION ALL {_leads_load(2, "true", 2)}
  UNION ALL {_leads_load(3, _THIRD, 2, 1)})""")
_LEADS_W = """(PARTITION BY campaign_id, campaign_name, date, country_code, channel_3, channel_4, channel_5,
      CASE WHEN campaign_id IS NULL THEN concat_ws('|', total_spend, total_impressions, total_leads) END
    ORDER BY _etl_loaded_at, total_spend, total_impressions, total_leads)"""


def leads_history(spark, sf_dir, order: tuple[int, ...] = (1, 2, 2, 3)):
    """The maintained history of the leads after their loads came in ``order``."""
    path = scratch_path(spark, f"leads_history_{uuid.uuid4().hex}")
    loads = cut_lineage(fx.leads_load_history(spark, sf_dir))
    landing = Landing(spark, f"{path}/landing")
    history = History(spark, f"{path}/history", LEADS_KEY, LEADS_TRACKED, LOADED_AT, REQUIRED)
    for number in order:
        landing.land(loads.where(F.col("load") == f"load-{number}").drop("load"), f"load-{number}")
        history.update(landing)
    return landing, history


@register("snapshot_leads", with_fixtures(*LEADS_HISTORY_CTES, f"""changed AS (
  SELECT *, row_number() OVER w = 1 OR lag(total_spend) OVER w IS DISTINCT FROM total_spend
            OR lag(total_impressions) OVER w IS DISTINCT FROM total_impressions
            OR lag(total_leads) OVER w IS DISTINCT FROM total_leads AS changed
  FROM leads_history WINDOW w AS {_LEADS_W})""", "kept AS (SELECT * EXCLUDE (changed, load) FROM changed WHERE changed)", body=f"""
SELECT *, _etl_loaded_at AS valid_from, lead(_etl_loaded_at) OVER w AS valid_to, lead(true) OVER w IS NULL AS is_current,
       md5(concat_ws('|', {", ".join(_key_part(c) for c in (*LEADS_KEY, LOADED_AT))})) AS snapshot_key
FROM kept WINDOW w AS {_LEADS_W}"""))
def snapshot_leads(spark, sf_dir):
    """Leads history by the seven-column business key, maintained load by load: two
    loads, the second one again, and one with the second one's load times (I-4, W-5);
    key over eight columns (F-25)."""
    _, history = leads_history(spark, sf_dir)
    return history.read().withColumn("snapshot_key", surrogate_key(*LEADS_KEY, LOADED_AT))


@register("maintained_max", with_fixtures(HISTORY_CTE, body="""
SELECT campaign_id, date, country_code, max(total_spend_eur) AS total_spend_eur, max(impressions) AS impressions
FROM history GROUP BY campaign_id, date, country_code"""))
def maintained_max(spark, sf_dir):
    """Latest known values maintained over three loads, the last of which (too high
    for every third campaign, with keys of its own) is taken back (A-17, I-5)."""
    path = scratch_path(spark, f"latest_{uuid.uuid4().hex}")
    h = cut_lineage(fx.web_load_history(spark, sf_dir))
    first = F.col("_etl_loaded_at") < F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(2))
    wrong = (h.where(F.coalesce(F.col("campaign_id").cast("int") % 3 == 0, F.lit(True)))
             .withColumns({"total_spend_eur": (F.col("total_spend_eur") + 1000).cast("decimal(18,4)"),
                           "country_code": F.when(F.col("impressions") > 3000, "XX").otherwise(F.col("country_code"))}))
    landing = Landing(spark, f"{path}/landing")
    state = MaxState(spark, f"{path}/latest", ["campaign_id", "date", "country_code"])
    for load, rows in (("1", h.where(first)), ("2", h.where(~first)), ("3", wrong)):
        landing.land(rows.drop("_etl_loaded_at"), load)
        state.update(landing)
    landing.retract("3")
    state.update(landing)
    return state.read().select("campaign_id", "date", "country_code", "total_spend_eur", "impressions")


# ----------------------------------------------------------------------- KPI
def _success_frame(final: DataFrame) -> DataFrame:
    """Spend and success per final row: deals for the sales path, orders for web."""
    return final.select("*", F.col("spend_value").alias("spend"),
                        F.coalesce(F.col("pos_lite_deals"), F.col("orders")).alias("success"))


_SUCCESS = ("final_s AS (SELECT *, spend_value AS spend, coalesce(pos_lite_deals, orders) "
            "AS success FROM final)")


def _cac_sql(by: str, where: str = "") -> str:
    return _final_cte_sql("").rstrip() + f""",
{_SUCCESS}
SELECT {by}, sum(spend) AS total_spend, sum(success) AS total_success,
       CASE WHEN coalesce(CAST(sum(success) AS DOUBLE), 0) > 0
            THEN coalesce(CAST(sum(spend) AS DOUBLE), 0) / CAST(sum(success) AS DOUBLE) END AS cac
FROM final_s {where} GROUP BY {by}"""


_OVERLAP_WHERE = """WHERE campaign_id IN (SELECT campaign_id FROM final_s
  WHERE pathway = 'Website (Self-Service)' INTERSECT SELECT campaign_id FROM final_s
  WHERE pathway = 'Contact Form (Sales-Assisted)')"""


@register("cac_by_pathway_overlap", _cac_sql("pathway", _OVERLAP_WHERE))
def cac_by_pathway_overlap(spark, sf_dir):
    """CAC per pathway over campaigns present in both pathways (K-7, J-9).

    Totals are first reduced to one row per (campaign, pathway); the overlap
    test then runs on that small table (at most two rows per campaign), so
    the final table is read once and no hot campaign lands in one task.
    """
    f = _success_frame(extract(spark, sf_dir)["final"]).where(F.col("campaign_id").isNotNull())
    per = A.segment_totals(f, ["campaign_id", "pathway"], {"spend": "spend", "success": "success"})
    has = lambda path: F.max(F.when(F.col("pathway") == path, 1)).over(Window.partitionBy("campaign_id"))
    both = (per.withColumns({"_web": has(WEB_PATHWAY), "_sales": has(SALES_PATHWAY)})
            .where((F.col("_web") == 1) & (F.col("_sales") == 1)))
    return K.segment_cac(both, ["pathway"])


@register("cac_by_test", _cac_sql("test"))
def cac_by_test(spark, sf_dir):
    return K.segment_cac(_success_frame(extract(spark, sf_dir)["final"]), ["test"])


@register("cac_by_channel", _cac_sql("pathway, channel, channel_3"))
def cac_by_channel(spark, sf_dir):
    return K.segment_cac(_success_frame(extract(spark, sf_dir)["final"]),
                         ["pathway", "channel", "channel_3"])


@register("compare_pathways", _cac_sql("pathway").replace(
    "\nSELECT pathway, sum(spend)", ",\ncac AS (SELECT pathway, sum(spend)", 1) + """)
SELECT cac_a, cac_b, coalesce(cac_b, 0) / nullif(cac_a, 0) AS times_better,
       1.0 - coalesce(cac_a, 0) / nullif(cac_b, 0) AS gain
FROM (SELECT max(CASE WHEN pathway = 'Contact Form (Sales-Assisted)' THEN cac END) AS cac_a,
             max(CASE WHEN pathway = 'Website (Self-Service)' THEN cac END) AS cac_b FROM cac)""")
def compare_pathways(spark, sf_dir):
    cac = K.segment_cac(_success_frame(extract(spark, sf_dir)["final"]), ["pathway"])
    return K.compare_segments(cac, "pathway", SALES_PATHWAY, WEB_PATHWAY)




def _mart_sql(body: str) -> str:
    return O.with_fixtures(*O.mart_ctes("country"), body=body)


@register("conversion_leads_meetings", _mart_sql("""
SELECT channel_3, sum(meeting_done) AS sum_meeting_done, sum(leads) AS sum_leads,
       coalesce(CAST(sum(meeting_done) AS DOUBLE), 0) / nullif(CAST(sum(leads) AS DOUBLE), 0)
         AS conversion
FROM mart GROUP BY channel_3"""))
def conversion_leads_meetings(spark, sf_dir):
    return K.conversion(mart(spark, sf_dir), "meeting_done", "leads", ["channel_3"])


_STEPS = ("impressions", "clicks", "leads", "sqls", "meeting_done", "signed_leads",
          "pos_lite_deals")


@register("step_conversion", _mart_sql(" UNION ALL ".join(
    f"""SELECT country_code, '{a}' AS from_step, '{b}' AS to_step,
       CAST(sum({a}) AS DOUBLE) AS from_total, CAST(sum({b}) AS DOUBLE) AS to_total,
       coalesce(CAST(sum({b}) AS DOUBLE), 0) / nullif(CAST(sum({a}) AS DOUBLE), 0) AS rate
FROM mart GROUP BY country_code""" for a, b in zip(_STEPS, _STEPS[1:]))))
def step_conversion(spark, sf_dir):
    return K.step_conversion(mart(spark, sf_dir), list(_STEPS), ["country_code"])


@register("spend_per_lead", _mart_sql("""
SELECT country_code, sum(total_spend_sales) AS sum_total_spend_sales, sum(leads) AS sum_leads,
       coalesce(CAST(sum(total_spend_sales) AS DOUBLE), 0) / nullif(CAST(sum(leads) AS DOUBLE), 0)
         AS cost_per_lead
FROM mart GROUP BY country_code"""))
def spend_per_lead(spark, sf_dir):
    return K.conversion(mart(spark, sf_dir), "total_spend_sales", "leads", ["country_code"],
                        name="cost_per_lead")


@register("top_campaigns", _mart_sql("""
SELECT campaign_id, campaign_name, sum(total_spend_web) AS total_spend_web,
       sum(total_spend_sales) AS total_spend_sales
FROM mart GROUP BY campaign_id, campaign_name
ORDER BY coalesce(sum(total_spend_web), 0) + coalesce(sum(total_spend_sales), 0) DESC,
         campaign_id LIMIT 20"""))
def top_campaigns(spark, sf_dir):
    t = A.segment_totals(mart(spark, sf_dir), ["campaign_id", "campaign_name"],
                         {"total_spend_web": "total_spend_web",
                          "total_spend_sales": "total_spend_sales"})
    total = F.coalesce("total_spend_web", F.lit(0)) + F.coalesce("total_spend_sales", F.lit(0))
    return W.top_n(t, [total.desc(), F.col("campaign_id").asc()], 20)


# ------------------------------------------------------------------- quality
@register("check_monotonic", _mart_sql(f"""
SELECT * FROM (SELECT *, concat_ws(',', {', '.join(
    f"CASE WHEN {b} > {a} THEN '{b}>{a}' END" for a, b in zip(_STEPS, _STEPS[1:]))})
    AS broken_steps FROM mart) WHERE broken_steps <> ''"""))
def check_monotonic(spark, sf_dir):
    return Q.check_monotonic(mart(spark, sf_dir), list(_STEPS))


_OUTLIERS = {"sessions": 10000, "impressions": 100000, "cac_per_pos_lite_deal": 1000}


@register("flag_outliers", _mart_sql(f"""
SELECT * FROM (SELECT *, concat_ws(',', {', '.join(
    f"CASE WHEN {c} >= {t} THEN '{c}' END" for c, t in _OUTLIERS.items())}) AS outlier_metrics
  FROM mart) WHERE outlier_metrics <> ''"""))
def flag_outliers(spark, sf_dir):
    return Q.flag_outliers(mart(spark, sf_dir), _OUTLIERS)


@register("check_broken_funnel", _mart_sql("""
SELECT * FROM mart WHERE (coalesce(impressions, 0) > 0 OR coalesce(pos_lite_deals, 0) > 0)
  AND (clicks IS NULL OR leads IS NULL OR sqls IS NULL OR meeting_done IS NULL)"""))
def check_broken_funnel(spark, sf_dir):
    return Q.check_broken_funnel(mart(spark, sf_dir), "impressions",
                                 ["clicks", "leads", "sqls", "meeting_done"], "pos_lite_deals")


@register("check_alignment", _mart_sql("""
SELECT *, CASE WHEN coalesce(total_spend_web, 0) <> 0 THEN 'spend_without_metrics'
               ELSE 'metrics_without_spend' END AS misalignment
FROM mart WHERE (coalesce(total_spend_web, 0) <> 0)
             <> (coalesce(sessions, 0) <> 0 OR coalesce(orders, 0) <> 0)"""))
def check_alignment(spark, sf_dir):
    return Q.check_alignment(mart(spark, sf_dir), "total_spend_web", ["sessions", "orders"])


@register("check_predicates", _mart_sql("""
SELECT *, 'deals_within_signed' AS "check" FROM mart WHERE NOT (pos_lite_deals <= signed_leads)
UNION ALL SELECT *, 'non_negative_spend' FROM mart WHERE NOT (total_spend_web >= 0)"""))
def check_predicates(spark, sf_dir):
    m = mart(spark, sf_dir)
    return (Q.check_predicate(m, "deals_within_signed",
                              F.col("pos_lite_deals") <= F.col("signed_leads"))
            .unionByName(Q.check_predicate(m, "non_negative_spend",
                                           F.col("total_spend_web") >= 0)))


@register("accepted_values", with_fixtures(*O.PREP_CTES, body="""
SELECT * FROM chp WHERE campaign_period_budget_category IS NOT NULL
  AND campaign_period_budget_category NOT IN ('alwayson', 'flight', 'abs', 'max')"""))
def accepted_values(spark, sf_dir):
    return Q.check_accepted(I.prepare_channels(fx.channels(spark, sf_dir)),
                            "campaign_period_budget_category",
                            ["alwayson", "flight", "abs", "max"])


@register("null_counts", with_fixtures(*O.PREP_CTES, body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS n_null FROM web_p" for c in O.WEB_P_COLS)))
def null_counts(spark, sf_dir):
    web, _, ch = sources(spark, sf_dir)
    w = I.prepare_web(web, ch)
    return Q.null_counts(w, w.columns)


_NOW = dt.datetime(2001, 8, 2, 20, 0, 0)


def _report_sql() -> str:
    parts = []
    for t in ("web", "leads"):
        parts.append(f"""SELECT 'freshness' AS "check", '{t}' AS table_name,
  '_etl_loaded_at' AS column_name, CAST(0 AS BIGINT) AS n_violations,
  CASE WHEN max(ts) IS NULL THEN 'error'
       WHEN (epoch(TIMESTAMP '{_NOW}') - epoch(max(ts))) / 3600.0 >= 24 THEN 'error'
       WHEN (epoch(TIMESTAMP '{_NOW}') - epoch(max(ts))) / 3600.0 >= 12 THEN 'warn'
       ELSE 'pass' END AS status
FROM (SELECT CAST(date AS TIMESTAMP) + INTERVAL 30 HOUR AS ts FROM {t})""")
        for c in ("date", "country_code", "campaign_id"):
            parts.append(f"""SELECT 'not_null', '{t}', '{c}',
  CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT),
  CASE WHEN sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0 THEN 'error' ELSE 'pass' END
FROM {t}""")
    parts.append("""SELECT 'schema', 'channels', '_etl_loaded_at', CAST(1 AS BIGINT), 'error'""")
    parts.append("""SELECT 'accepted', 'channels', 'campaign_period_budget_category', count(*),
  CASE WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END
FROM channels WHERE campaign_period_budget_category NOT IN ('alwayson', 'flight', 'abs', 'max')""")
    parts.append("""SELECT 'not_null', 'channels', 'campaign_id',
  CAST(sum(CASE WHEN campaign_id IS NULL THEN 1 ELSE 0 END) AS BIGINT),
  CASE WHEN sum(CASE WHEN campaign_id IS NULL THEN 1 ELSE 0 END) > 0 THEN 'error' ELSE 'pass' END
FROM channels""")
    parts.append("""SELECT 'unique', 'channels', 'campaign_id', count(*),
  CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END
FROM (SELECT campaign_id FROM channels GROUP BY campaign_id HAVING count(*) > 1)""")
    return with_fixtures(body="\nUNION ALL\n".join(parts))


@register("source_report", _report_sql())
def source_report(spark, sf_dir):
    web, leads, ch = sources(spark, sf_dir)
    tables = {"web_orders": fx.with_loaded_at(web), "leads_funnel": fx.with_loaded_at(leads),
              "channels": ch}
    rep = Q.source_report(tables, catalog.SOURCES, _NOW)
    return rep.withColumn("table_name", F.when(F.col("table_name") == "web_orders", "web")
                          .when(F.col("table_name") == "leads_funnel", "leads")
                          .otherwise(F.col("table_name")))


@register("not_null_rows", with_fixtures(body="""
SELECT *, concat_ws(',', CASE WHEN country_code IS NULL THEN 'country_code' END,
                    CASE WHEN campaign_id IS NULL THEN 'campaign_id' END) AS failed_columns
FROM leads WHERE country_code IS NULL OR campaign_id IS NULL"""))
def not_null_rows(spark, sf_dir):
    return Q.check_not_null(fx.leads_funnel(spark, sf_dir), ["country_code", "campaign_id"])


@register("referential_facts", with_fixtures(*O.DIM_CTES, body="""
SELECT * FROM web WHERE campaign_id IS NOT NULL AND campaign_id NOT IN (
  SELECT campaign_id FROM dim WHERE CAST(campaign_id AS BIGINT) % 7 <> 0)"""))
def referential_facts(spark, sf_dir):
    """Web rows whose campaign is not in a dimension that lacks every seventh campaign."""
    dim = dim_campaign_channels(fx.channels(spark, sf_dir)).where(F.col("campaign_id").cast("bigint") % 7 != 0)
    return Q.check_referential(fx.web_orders(spark, sf_dir), dim)


@register("bijection_all_tables", with_fixtures(*O.PREP_CTES, "all_pairs AS (" + " UNION ".join(
    f"SELECT campaign_id, campaign_name FROM {t} WHERE campaign_id IS NOT NULL AND campaign_name IS NOT NULL"
    for t in ("chp", "web_p", "leads_p")) + ")", body="""
SELECT 'id_to_name' AS direction, campaign_id AS key, count(*) AS n_partners FROM all_pairs
GROUP BY campaign_id HAVING count(*) > 1
UNION ALL SELECT 'name_to_id', campaign_name, count(*) FROM all_pairs
GROUP BY campaign_name HAVING count(*) > 1"""))
def bijection_all_tables(spark, sf_dir):
    web, leads, ch = sources(spark, sf_dir)
    return Q.check_bijection(I.prepare_channels(ch), I.prepare_web(web, ch), I.prepare_leads(leads))


# ------------------------------------------------ repeats, tolerant parsing
_LOADS = f"""loads AS (SELECT date, country_code, campaign_id, total_spend_eur, impressions AS n_views
  FROM history)"""


def _loads(spark, sf_dir) -> DataFrame:
    """Both loads of the web fact as they come: keys repeat, ids may be null."""
    h = fx.web_load_history(spark, sf_dir)
    return h.select("date", "country_code", "campaign_id", "total_spend_eur", F.col("impressions").alias("n_views"))


@register("combine_repeats", with_fixtures(HISTORY_CTE, _LOADS, """w AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, CASE WHEN campaign_id IS NULL THEN 1 ELSE row_number() OVER (
      PARTITION BY date, country_code, campaign_id
      ORDER BY coalesce(total_spend_eur, 0) DESC, total_spend_eur ASC NULLS LAST, n_views ASC NULLS LAST) END AS rn
    FROM loads) WHERE rn = 1)""", """l AS (
  SELECT date, country_code, campaign_id, total_spend, total_leads FROM leads)""", body="""
SELECT coalesce(w.date, l.date) AS date, coalesce(w.campaign_id, l.campaign_id) AS campaign_id,
       coalesce(w.country_code, l.country_code) AS country_code, w.total_spend_eur, w.n_views,
       l.total_spend, l.total_leads
FROM w FULL OUTER JOIN l ON w.date = l.date AND w.campaign_id = l.campaign_id
 AND w.country_code IS NOT DISTINCT FROM l.country_code"""))
def combine_repeats(spark, sf_dir):
    """J-2 with repeated keys and rows without id: best row per key and side,
    every row without id for itself."""
    leads = fx.leads_funnel(spark, sf_dir).select("date", "country_code", "campaign_id", "total_spend", "total_leads")
    return J.combine_funnels(_loads(spark, sf_dir), leads)


@register("repeated_keys", with_fixtures(HISTORY_CTE, _LOADS, body="""
SELECT date, campaign_id, country_code, count(*) - 1 AS n_aside FROM loads
WHERE date IS NOT NULL AND campaign_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1"""))
def repeated_keys(spark, sf_dir):
    return J.repeated_keys(_loads(spark, sf_dir))


@register("parse_numbers", """
SELECT p_partkey, raw, CASE p_partkey % 9 WHEN 0 THEN p_partkey + 0.5 WHEN 4 THEN p_partkey * 1000.0
  WHEN 6 THEN -p_partkey * 1.0 WHEN 7 THEN 'infinity'::DOUBLE WHEN 8 THEN 0.25 END::DOUBLE AS number
FROM (SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN p_partkey || '.5' WHEN 1 THEN 'nan' WHEN 2 THEN p_partkey || 'd'
  WHEN 3 THEN '' WHEN 4 THEN p_partkey || 'E3' WHEN 5 THEN '0x' || p_partkey
  WHEN 6 THEN ' -' || p_partkey || chr(160) WHEN 7 THEN 'Infinity' ELSE '.25' END AS raw FROM part)""")
def parse_numbers(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    k, m = F.col("p_partkey").cast("string"), F.col("p_partkey") % 9
    raw = (F.when(m == 0, F.concat(k, F.lit(".5"))).when(m == 1, "nan").when(m == 2, F.concat(k, F.lit("d")))
           .when(m == 3, "").when(m == 4, F.concat(k, F.lit("E3"))).when(m == 5, F.concat(F.lit("0x"), k))
           .when(m == 6, F.concat(F.lit(" -"), k, F.lit("\u00a0"))).when(m == 7, "Infinity").otherwise(".25"))
    return part.select("p_partkey", raw.alias("raw"), parse_number(raw).alias("number"))


@register("parse_dates", """
SELECT o_orderkey, raw, CASE o_orderkey % 5 WHEN 0 THEN d WHEN 1 THEN d WHEN 2 THEN d END AS parsed
FROM (SELECT o_orderkey, d, CASE o_orderkey % 5 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d/%m/%Y')
  WHEN 2 THEN strftime(d, '%Y%m%d') WHEN 3 THEN strftime(d, '%Y-13-%d') ELSE 'n/a' END AS raw
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders))""")
def parse_dates(spark, sf_dir):
    d, m = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 5
    raw = (F.when(m == 0, F.date_format(d, "yyyy-MM-dd")).when(m == 1, F.date_format(d, "dd/MM/yyyy"))
           .when(m == 2, F.date_format(d, "yyyyMMdd")).when(m == 3, F.date_format(d, "yyyy-'13'-dd")).otherwise("n/a"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return o.withColumn("parsed", parse_date("raw", "yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd"))


_EXISTING = ("CASE WHEN CAST(campaign_id AS BIGINT) % 2 = 0 THEN true END AS old_test, "
             "CASE WHEN CAST(campaign_id AS BIGINT) % 3 = 0 THEN 'Old' END AS old_channel")


@register("derive_keep_or_overwrite", with_fixtures(*O.PREP_CTES, body=f"""
SELECT campaign_id, coalesce(old_test, t) AS test_kept, coalesce(old_channel, c) AS channel_kept,
       t AS test_over, c AS channel_over
FROM (SELECT campaign_id, {_EXISTING}, coalesce(contains(lower(campaign_name), 'test'), false) AS t,
             {O.CHANNEL_CASE} AS c FROM chp)"""))
def derive_keep_or_overwrite(spark, sf_dir):
    """Existing test and channel columns are filled where null, or replaced."""
    n = F.col("campaign_id").cast("bigint")
    ch = I.prepare_channels(fx.channels(spark, sf_dir)).withColumns({
        "test": F.when(n % 2 == 0, F.lit(True)), "channel": F.when(n % 3 == 0, F.lit("Old"))})
    kept = X.derive_channel_viz(ch).select("campaign_id", F.col("test").alias("test_kept"),
                                           F.col("channel").alias("channel_kept"))
    over = X.derive_channel_viz(ch, overwrite=True).select("campaign_id", F.col("test").alias("test_over"),
                                                           F.col("channel").alias("channel_over"))
    return kept.join(over, "campaign_id")


@register("top_profiles", with_fixtures(*O.PREP_CTES, body="SELECT * FROM (" + _profile_sql(
    "leads_p", "campaign_id", "campaign_name") + """)
ORDER BY campaign_name_nunique DESC NULLS LAST, col_nunique DESC NULLS LAST, campaign_id, profile_col LIMIT 30"""))
def top_profiles(spark, sf_dir):
    """The first 30 profiles in the report's order: most values first."""
    prof = profile_leads_by_id(spark, sf_dir)
    return W.top_n(prof, [F.desc_nulls_last("campaign_name_nunique"), F.desc_nulls_last("col_nunique"),
                          F.asc("campaign_id"), F.asc("profile_col")], 30)


# ------------------------------------------------------- incremental / io
def _built_before(spark, sf_dir, web, leads, ch) -> str:
    """A target built from the given facts; returns its path."""
    path = scratch_path(spark, f"mart_target_{uuid.uuid4().hex}")
    build_target(spark, path, web, leads, ch)
    return path


@register("incremental_refresh", O.mart_sql("country"))
def incremental(spark, sf_dir):
    """Build the mart as it stood 30 days before the newest data, then run one
    incremental refresh."""
    web, leads, ch = stored_sources(spark, sf_dir)
    cutoff = A.high_water_mark(web, "date") - dt.timedelta(days=30)
    target = _built_before(spark, sf_dir, web.where(F.col("date") < F.lit(cutoff)),
                           leads.where(F.col("date") < F.lit(cutoff)), ch)
    return incremental_refresh(spark, target, web, leads, ch, lookback_days=7)


@register("incremental_late_rows", O.mart_sql("country"))
def incremental_late_rows(spark, sf_dir):
    """Whole keys that arrive long after their date: at first every seventh
    campaign lacks all rows older than 60 days."""
    web, leads, ch = stored_sources(spark, sf_dir)
    cutoff = A.high_water_mark(web, "date") - dt.timedelta(days=60)
    there = (F.col("date") >= F.lit(cutoff)) | (F.col("campaign_id").cast("int") % 7 != 0)
    target = _built_before(spark, sf_dir, web.where(there), leads.where(there), ch)
    return incremental_refresh(spark, target, web, leads, ch, lookback_days=7)


@register("incremental_partial_country", O.mart_sql("country"))
def incremental_partial_country(spark, sf_dir):
    """Some countries' rows change, others of the same campaign and day do not;
    rows that are in the target by mistake (doubled spend, a country that goes
    away) are replaced with their day."""
    web, leads, ch = stored_sources(spark, sf_dir)
    wrong = F.when(F.trim("country_code") == "GB", F.lit("XX")).otherwise(F.col("country_code"))
    old_web = web.withColumn("country_code", F.when(F.col("nb_of_orders") == 1, wrong).otherwise(F.col("country_code")))
    target = _built_before(spark, sf_dir, old_web, leads.where(F.col("total_leads") > 10), ch)
    return incremental_refresh(spark, target, web, leads, ch, lookback_days=7)


@register("incremental_schema_change", O.mart_sql("country"))
def incremental_schema_change(spark, sf_dir):
    """A target with an older schema (one column missing, one too many, one of
    another type) takes the new one; read back from the target's own path."""
    web, leads, ch = stored_sources(spark, sf_dir)
    cutoff = A.high_water_mark(web, "date") - dt.timedelta(days=30)
    path = _built_before(spark, sf_dir, web.where(F.col("date") < F.lit(cutoff)),
                         leads.where(F.col("date") < F.lit(cutoff)), ch)
    older = scratch_path(spark, f"mart_older_{uuid.uuid4().hex}")
    write_target(spark, read_target(spark, path).drop("channel_5").withColumn("old_note", F.lit("x"))
                 .withColumn("sessions", F.col("sessions").cast("int")), older)
    incremental_refresh(spark, older, web, leads, ch, lookback_days=7)   # no date table: all dates
    return read_target(spark, older)


def _accepted(spark, web, leads, ch, now) -> list:
    """Failures of the source checks that the fixtures are made to have."""
    from .operators.quality import source_report
    from .sources.catalog import SOURCES
    report = source_report({"web_orders": web, "leads_funnel": leads, "channels": ch}, SOURCES, now)
    return [tuple(r) for r in report.where(F.col("status") == "error").select("check", "table_name", "column_name").collect()]


@register("daily_run", O.mart_sql("country"))
def daily_run(spark, sf_dir):
    """Checks, histories, latest values and mart over a delta load, a full load, and
    the full load again (I-6)."""
    web, leads, ch = sources(spark, sf_dir)
    base = scratch_path(spark, f"daily_run_{uuid.uuid4().hex}")
    paths = {k: f"{base}/{k}" for k in ("report", "web_history", "leads_history", "mart")}
    now = dt.datetime(2001, 8, 3)
    w, l = stored(fx.with_loaded_at(web)), stored(fx.with_loaded_at(leads))
    accepted = _accepted(spark, w, l, ch, now) + [("freshness", t, LOADED_AT) for t in ("web_orders", "leads_funnel")]
    half = F.col("date") < F.lit(dt.date(1996, 1, 1))
    run_daily(spark, w.where(half), l.where(half), ch, paths, now, "load-1", accepted)
    for _ in range(2):
        out = run_daily(spark, w, l, ch, paths, now, "load-2", accepted)
    return out["mart"]


@register("mart_lookup", O.with_fixtures(*O.mart_ctes("country"), body="""
SELECT * FROM mart WHERE campaign_id = '17' AND date BETWEEN DATE '1995-02-10' AND DATE '1995-04-20'"""))
def mart_lookup(spark, sf_dir):
    """One campaign over ten weeks, looked up in the published mart (P-11, P-13)."""
    path = scratch_path(spark, f"mart_lookup_{uuid.uuid4().hex}")
    write_target(spark, mart(spark, sf_dir), path)
    return lookup(spark, path, "17", dt.date(1995, 2, 10), dt.date(1995, 4, 20))


@register("quality_by_partition", with_fixtures("""landed_rows AS (
  SELECT *, CAST(date AS TIMESTAMP) + INTERVAL 30 HOUR AS ts FROM leads
  UNION ALL SELECT *, CAST(date AS TIMESTAMP) + INTERVAL 54 HOUR FROM leads WHERE date >= DATE '1998-01-01')""",
    """repeated AS (
  SELECT count(*) AS n FROM landed_rows WHERE campaign_id IS NOT NULL AND date IS NOT NULL AND country_code IS NOT NULL
  GROUP BY campaign_id, date, country_code HAVING count(*) > 1)""", body="""
SELECT 'freshness' AS "check", 'leads' AS table_name, '_etl_loaded_at' AS column_name, CAST(0 AS BIGINT) AS n_violations,
       CASE WHEN (epoch(TIMESTAMP '2001-08-03 00:00:00') - epoch(max(ts))) / 3600.0 >= 24 THEN 'error'
            WHEN (epoch(TIMESTAMP '2001-08-03 00:00:00') - epoch(max(ts))) / 3600.0 >= 12 THEN 'warn' ELSE 'pass' END AS status FROM landed_rows
UNION ALL SELECT 'not_null', 'leads', 'campaign_id', count(*), CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END FROM landed_rows WHERE campaign_id IS NULL
UNION ALL SELECT 'not_null', 'leads', 'country_code', count(*), CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END FROM landed_rows WHERE country_code IS NULL
UNION ALL SELECT 'unique', 'leads', 'campaign_id,date,country_code', count(*), CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END FROM repeated"""))
def quality_by_partition(spark, sf_dir):
    """Quality figures kept by landed partition: a full load, then the last year again
    under another load, which repeats its keys (Q-1 .. Q-3)."""
    path = scratch_path(spark, f"quality_{uuid.uuid4().hex}")
    leads = cut_lineage(fx.leads_funnel(spark, sf_dir))
    landing = Landing(spark, f"{path}/landing")
    state = QualityState(spark, f"{path}/figures", ["campaign_id", "date", "country_code"], ["campaign_id", "country_code"])
    landing.land(fx.with_loaded_at(leads), "1")
    state.update(landing)
    landing.land(fx.with_loaded_at(leads, 54).where(F.col("date") >= F.lit(dt.date(1998, 1, 1))), "2")
    state.update(landing)
    return state.report("leads", dt.datetime(2001, 8, 3))


@register("landed_refresh", O.mart_sql("country"))
def landed_refresh(spark, sf_dir):
    """The mart refreshed from landed partitions only: rows that come months late, a
    load with wrong figures that lands again corrected, and one that is taken back (I-1, P-13)."""
    web, leads, ch = stored_sources(spark, sf_dir)
    base = scratch_path(spark, f"landed_{uuid.uuid4().hex}")
    made = {}
    for name, key in (("web", WEB_KEY), ("leads", LEADS_KEY)):
        made[name] = Landing(spark, f"{base}/{name}/landing"), MaxState(spark, f"{base}/{name}/latest", key)

    def refresh():
        for landing, state in made.values():
            state.update(landing)
        return refresh_landed(spark, f"{base}/mart", made["web"], made["leads"], ch)
    late = F.coalesce(F.col("campaign_id").cast("int") % 7 == 0, F.lit(False))
    spring = F.col("date").between(dt.date(1996, 3, 1), dt.date(1996, 4, 30))
    doubled = web.withColumn("nb_of_orders", F.when(spring, F.col("nb_of_orders") * 2).otherwise(F.col("nb_of_orders")))
    made["web"][0].land(doubled.where(~late), "1")
    made["leads"][0].land(leads, "1")
    refresh()
    made["web"][0].land(web.where(~late), "1")                          # corrected
    made["leads"][0].land(leads.where(spring).withColumn("total_leads", F.col("total_leads") + 5), "2")   # a mistake
    refresh()
    made["web"][0].land(web.where(late), "3")                           # late
    made["leads"][0].retract("2")
    return refresh()


@register("csv_roundtrip", with_fixtures(*O.PREP_CTES, body="SELECT * FROM chp"))
def csv_roundtrip(spark, sf_dir):
    """Prepared channels written as ``;`` CSV and read back with the declared schema."""
    path = scratch_path(spark, f"channels_csv_{uuid.uuid4().hex}")
    write_csv(I.prepare_channels(fx.channels(spark, sf_dir)), path, sep=";")
    return read_source(spark, path, CHANNELS, fmt="csv", sep=";")


@register("csv_roundtrip_raw", with_fixtures(body="""
SELECT campaign_id, campaign_name || ' "x"; y' AS campaign_name, campaign_period_budget_category,
       channel_3, channel_4, channel_5 FROM channels"""))
def csv_roundtrip_raw(spark, sf_dir):
    """The raw dirty channels (blanks at both ends, quotes and separators inside),
    columns written in another order."""
    path = scratch_path(spark, f"channels_raw_{uuid.uuid4().hex}")
    raw = fx.channels(spark, sf_dir).withColumn("campaign_name", F.concat("campaign_name", F.lit(' "x"; y')))
    write_csv(raw.select(*reversed(raw.columns)), path, sep=";")
    return read_source(spark, path, CHANNELS, fmt="csv", sep=";")


@register("csv_roundtrip_final", O.FINAL_SQL)
def csv_roundtrip_final(spark, sf_dir):
    """The final table written as the export writes it, read back with its schema."""
    path = scratch_path(spark, f"final_csv_{uuid.uuid4().hex}")
    final = extract(spark, sf_dir)["final"]
    write_csv(final, path, compression="gzip")
    return read_source(spark, path, final.schema, fmt="csv")


@register("export_final", O.FINAL_SQL)
def export_final(spark, sf_dir):
    """The guarded export: written only because the final table is unique on its grain
    (S-6, W-4), and read back."""
    path = scratch_path(spark, f"export_{uuid.uuid4().hex}")
    final = stored(extract(spark, sf_dir)["final"])
    X.write_extract({"final": final}, path, compression="gzip")
    return read_source(spark, f"{path}/final", final.schema, fmt="csv")


_SHOWN = ("campaign_id", "date", "pathway", "country_code", "channel")


@register("sorted_duplicates", _final_cte_sql(f"""
SELECT f.* FROM final f JOIN (SELECT campaign_id, date, pathway FROM final
  GROUP BY ALL HAVING count(*) > 1) d
  ON f.campaign_id IS NOT DISTINCT FROM d.campaign_id AND f.date IS NOT DISTINCT FROM d.date
 AND f.pathway IS NOT DISTINCT FROM d.pathway
ORDER BY {', '.join(f'f.{c} ASC NULLS FIRST' for c in _SHOWN)} LIMIT 200"""))
def sorted_duplicates(spark, sf_dir):
    """The first 200 duplicates in the order of the report: by key, then country and channel (T-4)."""
    return W.top_n(grain_duplicates(spark, sf_dir), [F.asc_nulls_first(c) for c in _SHOWN], 200)


@register("stg_leads", with_fixtures(body=f"""
SELECT * REPLACE (trim(CAST(campaign_id AS VARCHAR)) AS campaign_id, {O.duck_clean('campaign_name')} AS campaign_name,
  {', '.join(f"{O.duck_clean(c)} AS {c}" for c in O.CH)}) FROM leads"""))
def stg_leads(spark, sf_dir):
    return stg_leads_funnel(fx.leads_funnel(spark, sf_dir))


@register("stg_web", with_fixtures(body="SELECT * REPLACE (trim(CAST(campaign_id AS VARCHAR)) AS campaign_id) FROM web"))
def stg_web(spark, sf_dir):
    return stg_web_orders(fx.web_orders(spark, sf_dir))


_MASKED = tuple(str(k) for k in range(11, 200, 22))


@register("masked_repair", with_fixtures(f"""c AS (
  SELECT * REPLACE (trim(campaign_id) AS campaign_id, {', '.join(f"CASE WHEN lower(trim({x})) <> 'unknown' THEN {x} END AS {x}" for x in O.CH)})
  FROM channels)""", f"""best AS (SELECT campaign_id, {', '.join(f'min({x}) AS l_{x}' for x in O.CH)} FROM c GROUP BY campaign_id)""", body=f"""
SELECT c.* REPLACE ({', '.join(f"CASE WHEN c.campaign_id IN {_MASKED} THEN coalesce(c.{x}, b.l_{x}) ELSE c.{x} END AS {x}" for x in O.CH)})
FROM c LEFT JOIN best b ON c.campaign_id = b.campaign_id"""))
def masked_repair(spark, sf_dir):
    """Missing channels filled for some campaigns only (P-12); the others keep their nulls."""
    ch = fx.channels(spark, sf_dir).withColumn("campaign_id", cast_id("campaign_id"))
    return D.repair_channels(ch, ids=_MASKED, fill=False)


@register("row_filters", with_fixtures(body="""
SELECT * FROM leads WHERE total_leads > 20 AND country_code IS NOT NULL AND coalesce(channel_3, '') <> 'fb'"""))
def row_filters(spark, sf_dir):
    """Rows that pass every named condition (Q-16)."""
    return Q.apply_row_filters(fx.leads_funnel(spark, sf_dir), {
        "enough leads": F.col("total_leads") > 20, "known country": F.col("country_code").isNotNull(),
        "not social": F.coalesce("channel_3", F.lit("")) != F.lit("fb")})


@register("stream_mart", O.mart_sql("country"))
def stream_mart_q(spark, sf_dir):
    """The mart produced by the streaming job from date-ordered fact drops."""
    from .streaming.mart_stream import stream_mart
    web, leads, ch = sources(spark, sf_dir)
    return stream_mart(spark, web, leads, ch)


@register("stream_late_file", O.mart_sql("country"))
def stream_late_file(spark, sf_dir):
    """As above, but the oldest drop arrives last, and each campaign's rows are
    spread over the drops, so every day is completed by a later file."""
    from .streaming.mart_stream import stream_mart
    web, leads, ch = sources(spark, sf_dir)
    return stream_mart(spark, web, leads, ch, late=True)
