"""DuckDB SQL texts that state, independently of the Spark plans, what each
registered query must return (the driver's correctness oracle).

The fixture sources are written here as CTEs over the pre-registered driver
views; ``duck_clean`` spells the text normaliser as nested ``regexp_replace``.
"""

from __future__ import annotations

# White space of any alphabet, spelled for this engine's patterns.
DUCK_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def duck_clean(x: str) -> str:
    """The text normaliser, rule by rule (stated here on its own)."""
    t = f"regexp_replace(lower({x}), '^{DUCK_WS}+|{DUCK_WS}+$', '', 'g')"
    t = f"regexp_replace({t}, '{DUCK_WS}+', ' ', 'g')"
    spaced = lambda word: " *".join(word)
    for pattern, repl in (
            (spaced("prospecting"), "prospecting"), (spaced("shopping"), "shopping"), (spaced("landing"), "landing"),
            (spaced("demand") + "[-_ ]* *" + spaced("gen"), "demandgen"),
            (spaced("pos") + " *[-_ ]* *" + spaced("lite"), "pos-lite"),
            (" *- *", "-"), (" *_ *", "_"), (" ", "_"), ("bing_search_+", "bing-search_"),
            ("search_shopping_+", "search-shopping_"), ("_+", "_")):
        t = f"regexp_replace({t}, '{pattern}', '{repl}', 'g')"
    return f"regexp_replace({t}, '^_+|_+$', '', 'g')"


def duck_nullif_blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


COUNTRY = ("case c_nationkey % 5 when 0 then ' es ' when 1 then 'GB' when 2 then 'ie' "
           "when 3 then 'CH' end")

FIXTURE_CTES = f"""
ch_base AS (
  SELECT k, ty,
         CASE k % 7 WHEN 0 THEN 'fb' WHEN 1 THEN 'bing-search' WHEN 2 THEN 'bing-shopping'
              WHEN 3 THEN 'search' WHEN 4 THEN 'search-shopping' WHEN 5 THEN 'max'
              ELSE 'demandgen' END AS c3
  FROM (SELECT p_partkey // 10 AS k, min_by(lower(p_type), p_partkey) AS ty
        FROM part GROUP BY p_partkey // 10)
),
channels AS (
  SELECT CAST(k AS VARCHAR) AS campaign_id,
         c3 || '_gb_' || ty || '_prospecting'
            || CASE WHEN k % 10 = 3 THEN '_convgoaltest' ELSE '' END || '_' || CAST(k AS VARCHAR)
            AS campaign_name,
         CASE k % 3 WHEN 0 THEN 'alwayson' WHEN 1 THEN 'unknown' END
            AS campaign_period_budget_category,
         c3 AS channel_3, c3 || ' prospecting' AS channel_4, c3 || ' prospecting ' || ty AS channel_5
  FROM ch_base
  UNION ALL
  SELECT ' ' || CAST(k AS VARCHAR) || ' ',
         chr(160) || upper(c3) || chr(160) || '_gb_' || ty || '__P r o s p e c t i n g'
            || CASE WHEN k % 10 = 3 THEN '_convgoalTest ' ELSE '' END || '_' || CAST(k AS VARCHAR),
         CASE k % 3 WHEN 0 THEN 'alwayson' END,
         c3 || ' ', c3 || '  prospecting ',
         CASE WHEN k % 11 = 0 THEN NULL ELSE c3 || '  prospecting ' || ty END
  FROM ch_base
),
fact_lines AS (
  SELECT CAST(o_orderdate AS DATE) AS date, {COUNTRY} AS country_code,
         l_partkey // 10 AS k,
         CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_partkey // 10 AS VARCHAR) END AS campaign_id, l_returnflag, l_extendedprice,
         l_discount, l_tax, l_quantity, l_linestatus, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
web AS (
  SELECT date, country_code, campaign_id,
         CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) - CASE WHEN campaign_id IS NOT NULL AND sum(l_linenumber) % 17 = 0
              THEN 100000 ELSE 0 END AS DECIMAL(18,4)) AS total_spend_eur,
         CAST(sum(l_quantity) * 10 AS BIGINT) AS nb_of_sessions,
         CAST(sum(l_quantity) AS BIGINT) AS nb_of_signups,
         count(*) AS nb_of_orders,
         CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT)
            AS nb_of_poslite_items_ordered
  FROM fact_lines WHERE l_returnflag <> 'R' GROUP BY date, country_code, campaign_id
),
leads AS (
  SELECT date, country_code, campaign_id, campaign_name, channel_3, channel_4, channel_5,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS total_spend,
         CAST(sum(l_quantity) * 100 AS BIGINT) AS total_impressions,
         CASE WHEN sum(l_linenumber) % 11 <> 0 THEN CAST(sum(l_quantity) * 10 AS BIGINT) END AS total_clicks,
         CAST(sum(l_quantity) AS BIGINT) AS total_leads,
         CAST(sum(l_linenumber) AS BIGINT) AS total_sqls,
         count(*) AS total_meeting_done,
         CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS total_signed_leads,
         CAST(CASE WHEN sum(l_linenumber) % 13 = 0 THEN count(*)
                   ELSE sum(CASE WHEN l_linestatus = 'F' AND l_tax > 0.04 THEN 1 ELSE 0 END) END AS BIGINT)
            AS total_pos_lite_deals,
         CAST(sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_fake_leads
  FROM (SELECT *, CASE WHEN k % 4 = 0 THEN 'Lead  Campaign_' || CAST(k AS VARCHAR) END AS campaign_name,
               CASE k % 3 WHEN 0 THEN 'Search ' WHEN 1 THEN 'fb' END AS channel_3,
               CASE k % 3 WHEN 0 THEN 'search  prospecting' WHEN 1 THEN 'fb' || chr(160) || 'prospecting' END AS channel_4,
               CASE k % 3 WHEN 0 THEN 'search  prospecting  Generic ' WHEN 1 THEN 'fb prospecting Video' END AS channel_5
        FROM fact_lines WHERE l_returnflag = 'R')
  GROUP BY date, country_code, campaign_id, campaign_name, channel_3, channel_4, channel_5
)"""


def with_fixtures(*ctes: str, body: str) -> str:
    parts = [FIXTURE_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------- mart pieces
def _clean_cols(prefix: str = "") -> str:
    return ", ".join(f"{duck_clean(prefix + c)} AS {c}" for c in
                     ("channel_3", "channel_4", "channel_5"))


DIM_CTES = (
    f"""stg_ch AS (
  SELECT trim(CAST(campaign_id AS VARCHAR)) AS campaign_id,
         {duck_clean('campaign_name')} AS campaign_name,
         trim(campaign_period_budget_category) AS campaign_period_budget_category,
         {_clean_cols()}
  FROM channels
)""",
    """ch_nn AS (
  SELECT campaign_id, campaign_name, campaign_period_budget_category,
         CASE WHEN channel_3 NOT IN ('unknown','Unknown','UNKNOWN') THEN channel_3 END AS channel_3,
         CASE WHEN channel_4 NOT IN ('unknown','Unknown','UNKNOWN') THEN channel_4 END AS channel_4,
         CASE WHEN channel_5 NOT IN ('unknown','Unknown','UNKNOWN') THEN channel_5 END AS channel_5
  FROM stg_ch
)""",
    """ch_lookup AS (
  SELECT campaign_id, min(channel_3) AS l3, min(channel_4) AS l4, min(channel_5) AS l5
  FROM ch_nn GROUP BY campaign_id
)""",
    """ch_rep AS (
  SELECT n.campaign_id, n.campaign_name, n.campaign_period_budget_category,
         coalesce(n.channel_3, k.l3) AS channel_3, coalesce(n.channel_4, k.l4) AS channel_4,
         coalesce(n.channel_5, k.l5) AS channel_5
  FROM ch_nn n LEFT JOIN ch_lookup k ON n.campaign_id = k.campaign_id
)""",
    """dim AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY
        channel_3 ASC NULLS LAST, channel_4 ASC NULLS LAST, channel_5 ASC NULLS LAST,
        campaign_name ASC NULLS LAST, campaign_period_budget_category ASC NULLS LAST) AS rn
    FROM ch_rep) WHERE rn = 1
)""",
)

WEB_M = ("nb_of_sessions", "nb_of_signups", "nb_of_orders", "nb_of_poslite_items_ordered")
SALES_M = ("total_impressions", "total_clicks", "total_leads", "total_sqls",
           "total_meeting_done", "total_signed_leads", "total_pos_lite_deals")
TIEBREAK = ("country_code", "total_spend_eur", *WEB_M, "total_spend", *SALES_M)
KEYDIMS = ("date", "country_code", "campaign_id", "campaign_key", "campaign_name",
           "campaign_period_budget_category", "channel_3", "channel_4", "channel_5")


def _order(rank: str) -> str:
    return (f"coalesce({rank}, 0) DESC, "
            + ", ".join(f"{c} ASC NULLS LAST" for c in TIEBREAK))


def mart_ctes(grain: str = "country") -> tuple[str, ...]:
    part = ("campaign_id, campaign_name, date, country_code" if grain == "country"
            else "campaign_id, campaign_name, date")
    # Without an id a one-sided group would also give a row without any metric
    # at the country grain; these are not produced (README).
    real = ("campaign_id IS NOT NULL OR coalesce(nb_of_orders, total_meeting_done) IS NOT NULL"
            if grain == "country" else "true")
    # A row of the other side never stands in for a side that has rows of its own.
    web_first, sales_first = (("nb_of_orders IS NULL, ", "total_meeting_done IS NULL, ")
                              if grain == "country" else ("", ""))
    return DIM_CTES + (
        f"""fct_web AS (
  SELECT date, upper(trim(country_code)) AS country_code,
         trim(CAST(campaign_id AS VARCHAR)) AS campaign_id, total_spend_eur,
         {', '.join(WEB_M)}
  FROM web
)""",
        f"""fct_leads AS (
  SELECT date, upper(trim(country_code)) AS country_code,
         trim(CAST(campaign_id AS VARCHAR)) AS campaign_id, total_spend,
         {', '.join(SALES_M)},
         {duck_clean('channel_3')} AS l_channel_3_clean,
         {duck_clean('channel_4')} AS l_channel_4_clean,
         {duck_clean('channel_5')} AS l_channel_5_clean
  FROM leads
)""",
        f"""combined AS (
  SELECT coalesce(w.date, l.date) AS date, coalesce(w.country_code, l.country_code) AS country_code,
         coalesce(w.campaign_id, l.campaign_id) AS campaign_id,
         w.total_spend_eur, {', '.join('w.' + c for c in WEB_M)},
         l.total_spend, {', '.join('l.' + c for c in SALES_M)},
         l.l_channel_3_clean, l.l_channel_4_clean, l.l_channel_5_clean
  FROM fct_web w FULL OUTER JOIN fct_leads l
    ON w.date = l.date AND w.country_code IS NOT DISTINCT FROM l.country_code
   AND w.campaign_id = l.campaign_id
)""",
        f"""enriched AS (
  SELECT c.date, c.country_code, c.campaign_id,
         c.campaign_id || '__' || coalesce(nullif(lower(regexp_replace(trim({duck_clean('d.campaign_name')}), '\\s+', '_', 'g')), ''), 'unknown') AS campaign_key,
         nullif(trim({duck_clean('d.campaign_name')}), '') AS campaign_name,
         CAST(trim(d.campaign_period_budget_category) AS VARCHAR) AS campaign_period_budget_category,
         coalesce(nullif(trim({duck_clean('d.channel_3')}), ''), nullif(trim(c.l_channel_3_clean), '')) AS channel_3,
         coalesce(nullif(trim({duck_clean('d.channel_4')}), ''), nullif(trim(c.l_channel_4_clean), '')) AS channel_4,
         coalesce(nullif(trim({duck_clean('d.channel_5')}), ''), nullif(trim(c.l_channel_5_clean), '')) AS channel_5,
         c.total_spend_eur, {', '.join('c.' + x for x in WEB_M)},
         c.total_spend, {', '.join('c.' + x for x in SALES_M)}
  FROM combined c LEFT JOIN dim d ON c.campaign_id = d.campaign_id
)""",
        f"""windowed AS (
  SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {web_first}{_order('total_spend_eur')}) AS web_rank,
            row_number() OVER (PARTITION BY {part} ORDER BY {sales_first}{_order('total_spend')}) AS sales_rank
  FROM enriched
)""",
        f"""max_spend_rows AS (
  SELECT {', '.join(f'coalesce(w.{c}, s.{c}) AS {c}' for c in KEYDIMS)},
         w.total_spend_eur AS total_spend_web, {', '.join('w.' + c for c in WEB_M)},
         s.total_spend AS total_spend_sales, {', '.join('s.' + c for c in SALES_M)}
  FROM (SELECT * FROM windowed WHERE web_rank = 1) w
  FULL OUTER JOIN (SELECT * FROM windowed WHERE sales_rank = 1) s
    ON w.date = s.date AND w.campaign_id = s.campaign_id
   AND w.campaign_name IS NOT DISTINCT FROM s.campaign_name
   AND w.country_code IS NOT DISTINCT FROM s.country_code
)""",
        f"""mart AS (
  SELECT date, country_code, campaign_id, campaign_key, campaign_name,
         campaign_period_budget_category, channel_3, channel_4, channel_5,
         nb_of_sessions AS sessions, nb_of_signups AS signups, nb_of_orders AS orders,
         nb_of_poslite_items_ordered AS poslite_items_ordered,
         total_impressions AS impressions, total_clicks AS clicks, total_leads AS leads,
         total_sqls AS sqls, total_meeting_done AS meeting_done,
         total_signed_leads AS signed_leads, total_pos_lite_deals AS pos_lite_deals,
         total_spend_web, total_spend_sales,
         CASE WHEN coalesce(CAST(total_pos_lite_deals AS DOUBLE), 0) > 0
              THEN coalesce(CAST(total_spend_sales AS DOUBLE), 0) / CAST(total_pos_lite_deals AS DOUBLE)
         END AS cac_per_pos_lite_deal,
         CASE WHEN coalesce(CAST(nb_of_poslite_items_ordered AS DOUBLE), 0) > 0
              THEN coalesce(CAST(total_spend_web AS DOUBLE), 0) / CAST(nb_of_poslite_items_ordered AS DOUBLE)
         END AS cac_per_pos_lite_order_web,
         coalesce(CAST(nb_of_poslite_items_ordered AS DOUBLE), 0)
           / nullif(CAST(nb_of_sessions AS DOUBLE), 0) AS web_funnel_throughput,
         coalesce(CAST(total_pos_lite_deals AS DOUBLE), 0)
           / nullif(CAST(total_impressions AS DOUBLE), 0) AS sales_funnel_throughput
  FROM max_spend_rows WHERE {real}
)""",
    )


def mart_sql(grain: str = "country") -> str:
    return with_fixtures(*mart_ctes(grain), body="SELECT * FROM mart")


# ------------------------------------------------------------ id / NA helpers
def duck_fix_id(x: str) -> str:
    t = f"regexp_replace(CAST({x} AS VARCHAR), '^{DUCK_WS}+|{DUCK_WS}+$', '', 'g')"
    t = f"(CASE WHEN {t} IN ('<NA>', 'nan', 'None', '') THEN NULL ELSE {t} END)"
    t = f"regexp_replace(regexp_replace({t}, '\\.000000$', ''), '\\.0$', '')"
    t = (f"(CASE WHEN contains(lower({t}), 'e') THEN CAST(CAST(round_even(TRY_CAST({t} AS "
         f"DECIMAL(38,10)), 0) AS DECIMAL(38,0)) AS VARCHAR) ELSE {t} END)")
    return f"nullif(regexp_replace({t}, '[^0-9]', '', 'g'), '')"


def duck_na(x: str) -> str:
    return (f"CASE WHEN lower(CAST({x} AS VARCHAR)) IN ('<<nan>>', 'nan', 'none', '<na>', '', "
            f"'unknown') THEN NULL ELSE CAST({x} AS VARCHAR) END")


def duck_unknown(x: str) -> str:
    return f"CASE WHEN {x} NOT IN ('unknown', 'Unknown', 'UNKNOWN') THEN {x} END"


ALL_LEADS_M = (*SALES_M, "total_fake_leads")
ATTRS = ("campaign_period_budget_category", "country_code", "channel_3", "channel_4",
         "channel_5")
CH = ("channel_3", "channel_4", "channel_5")


def duck_mode_ref(src: str, key: str, name: str) -> tuple[str, ...]:
    """Per key the mode of each attribute (ties -> smallest) as CTE ``name``."""
    ctes = [f"""{name}_keys AS (SELECT DISTINCT {key} FROM {src} WHERE {key} IS NOT NULL)"""]
    for a in ATTRS:
        ctes.append(f"""{name}_{a} AS (
  SELECT {key}, v AS {a} FROM (
    SELECT {key}, v, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, v ASC) AS rn
    FROM (SELECT {key}, {a} AS v, count(*) AS n FROM {src}
          WHERE {key} IS NOT NULL AND {a} IS NOT NULL GROUP BY {key}, {a})) WHERE rn = 1
)""")
    joins = " ".join(f"LEFT JOIN {name}_{a} USING ({key})" for a in ATTRS)
    ctes.append(f"""{name} AS (SELECT {key}, {', '.join(ATTRS)} FROM {name}_keys {joins})""")
    return tuple(ctes)


def duck_fill(src: str, ref_id: str, ref_name: str, out: str, cols: tuple[str, ...]) -> str:
    sel1 = ", ".join(f"coalesce(s.{c}, r.{c}) AS {c}" if c in ATTRS else f"s.{c}" for c in cols)
    sel2 = ", ".join(f"coalesce(s.{c}, r.{c}) AS {c}" if c in ATTRS else f"s.{c}" for c in cols)
    return f"""{out} AS (
  SELECT {sel2} FROM (
    SELECT {sel1} FROM {src} s LEFT JOIN {ref_id} r ON s.campaign_id = r.campaign_id) s
  LEFT JOIN {ref_name} r ON s.campaign_name = r.campaign_name
)"""


def duck_maps(src: str, out: str, cols: tuple[str, ...]) -> str:
    s1 = ", ".join("coalesce(s.campaign_name, m.m_name) AS campaign_name" if c == "campaign_name"
                   else f"s.{c}" for c in cols)
    s2 = ", ".join("coalesce(s.campaign_id, m.m_id) AS campaign_id" if c == "campaign_id"
                   else f"s.{c}" for c in cols)
    return f"""{out} AS (
  SELECT {s2} FROM (SELECT {s1} FROM {src} s LEFT JOIN id2name m ON s.campaign_id = m.campaign_id) s
  LEFT JOIN name2id m ON s.campaign_name = m.campaign_name
)"""


WEB_P_COLS = ("date", "country_code", "campaign_id", "total_spend_eur", *WEB_M, "campaign_name",
              "campaign_period_budget_category", *CH)
LEADS_P_COLS = ("date", "country_code", "campaign_id", "campaign_name", *CH, "total_spend",
                *ALL_LEADS_M)

PREP_CTES = (
    f"""chp_nn AS (
  SELECT {duck_fix_id('campaign_id')} AS campaign_id, {duck_clean('campaign_name')} AS campaign_name,
         campaign_period_budget_category,
         {', '.join(f"{duck_unknown(duck_clean(c))} AS {c}" for c in CH)}
  FROM channels
)""",
    """chp_lk AS (SELECT campaign_id, min(channel_3) AS l3, min(channel_4) AS l4, min(channel_5) AS l5
  FROM chp_nn GROUP BY campaign_id)""",
    """chp_rep AS (
  SELECT n.campaign_id, n.campaign_name, n.campaign_period_budget_category,
         coalesce(n.channel_3, k.l3, 'unknown') AS channel_3,
         coalesce(n.channel_4, k.l4, 'unknown') AS channel_4,
         coalesce(n.channel_5, k.l5, 'unknown') AS channel_5
  FROM chp_nn n LEFT JOIN chp_lk k ON n.campaign_id = k.campaign_id
)""",
    """chp AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY channel_3 ASC NULLS LAST,
        channel_4 ASC NULLS LAST, channel_5 ASC NULLS LAST, campaign_name ASC NULLS LAST,
        campaign_period_budget_category ASC NULLS LAST) AS rn FROM chp_rep) WHERE rn = 1
)""",
    f"""web_p AS (
  SELECT w.date, w.country_code, {duck_fix_id('w.campaign_id')} AS campaign_id, w.total_spend_eur,
         {', '.join('w.' + m for m in WEB_M)}, c.campaign_name, c.campaign_period_budget_category,
         c.channel_3, c.channel_4, c.channel_5
  FROM web w LEFT JOIN chp c ON {duck_fix_id('w.campaign_id')} IS NOT DISTINCT FROM c.campaign_id
)""",
    f"""leads_p AS (
  SELECT date, country_code, {duck_fix_id('campaign_id')} AS campaign_id,
         {duck_clean('campaign_name')} AS campaign_name,
         {', '.join(f'{duck_clean(c)} AS {c}' for c in CH)}, total_spend, {', '.join(ALL_LEADS_M)}
  FROM leads
)""",
)


def _na_select(src: str, cols: tuple[str, ...]) -> str:
    norm = ("campaign_id", "campaign_name", *ATTRS)
    return ", ".join(f"{duck_na(c)} AS {c}" if c in norm else c for c in cols)


IMPUTE_CTES = PREP_CTES + (
    f"web_n AS (SELECT {_na_select('web_p', WEB_P_COLS)} FROM web_p)",
    f"leads_n AS (SELECT {_na_select('leads_p', LEADS_P_COLS)} FROM leads_p)",
    """pairs AS (SELECT DISTINCT campaign_id, campaign_name FROM (
    SELECT campaign_id, campaign_name FROM leads_n UNION ALL
    SELECT campaign_id, campaign_name FROM web_n)
  WHERE campaign_id IS NOT NULL AND campaign_name IS NOT NULL)""",
    """id2name AS (SELECT campaign_id, min(campaign_name) AS m_name FROM pairs
  GROUP BY campaign_id HAVING count(*) = 1)""",
    """name2id AS (SELECT campaign_name, min(campaign_id) AS m_id FROM pairs
  GROUP BY campaign_name HAVING count(*) = 1)""",
    duck_maps("web_n", "web_m", WEB_P_COLS),
    duck_maps("leads_n", "leads_m", LEADS_P_COLS),
    f"""attr_all AS (SELECT campaign_id, campaign_name, {', '.join(a for a in ATTRS if a in LEADS_P_COLS)}
  FROM leads_m UNION ALL BY NAME SELECT campaign_id, campaign_name, {', '.join(ATTRS)} FROM web_m)""",
) + duck_mode_ref("attr_all", "campaign_id", "ref_id") + duck_mode_ref(
    "attr_all", "campaign_name", "ref_name") + (
    duck_fill("web_m", "ref_id", "ref_name", "web_f", WEB_P_COLS),
    duck_fill("leads_m", "ref_id", "ref_name", "leads_f", LEADS_P_COLS),
)

CHANNEL_CASE = ("CASE channel_3 WHEN 'fb' THEN 'Facebook' WHEN 'bing-search' THEN 'Bing Search' "
                "WHEN 'bing-shopping' THEN 'Bing Shopping' WHEN 'search' THEN 'Search' "
                "WHEN 'search-shopping' THEN 'Search Shopping' WHEN 'max' THEN 'Max' "
                "ELSE 'Unknown' END")
COUNTRY_CASE = ("CASE country_code WHEN 'ES' THEN 'Spain' WHEN 'GB' THEN 'United Kingdom' "
                "WHEN 'IE' THEN 'Ireland' WHEN 'CH' THEN 'Switzerland' ELSE 'Unknown' END")


def duck_derive(src: str, out: str, pathway: str, spend: str) -> str:
    parts = "string_split(channel_5, '_')"
    n = f"len({parts})"
    return f"""{out} AS (
  SELECT *, '{pathway}' AS pathway, {spend} AS spend_value,
         coalesce(contains(lower(campaign_name), 'test'), false) AS test,
         {CHANNEL_CASE} AS channel,
         CASE WHEN {n} >= 3 THEN {parts}[-2] WHEN {n} = 2 THEN {parts}[2] END AS channel_6,
         CASE WHEN {n} >= 3 THEN {parts}[-1] END AS channel_7,
         {COUNTRY_CASE} AS country_name,
         year(date) AS year, month(date) AS month, weekofyear(date) AS week,
         dayofyear(date) AS day_of_year,
         CAST(date - CAST((isodow(date) - 2 + 7) % 7 AS INTEGER) AS DATE) AS week_start
  FROM {src}
)"""


INDEX = ("date", "country_code", "campaign_id", "pathway", "spend_value", "country_name", "year",
         "month", "week", "day_of_year", "week_start", "channel", "channel_3", "channel_4",
         "channel_5", "channel_6", "channel_7", "test")
WEB_STAGE = {"nb_of_sessions": "sessions", "nb_of_signups": "signups",
             "nb_of_orders": "orders", "nb_of_poslite_items_ordered": "poslite_items_ordered"}
LEADS_STAGE = {"total_impressions": "impressions", "total_clicks": "clicks",
               "total_leads": "leads", "total_sqls": "sqls",
               "total_meeting_done": "meeting_done", "total_signed_leads": "signed_leads",
               "total_pos_lite_deals": "pos_lite_deals", "total_fake_leads": "fake_leads"}


def duck_long(src: str, stages: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT {', '.join(INDEX)}, '{st}' AS funnel_stage, CAST({m} AS DOUBLE) AS metric_value "
        f"FROM {src}" for m, st in stages.items())


def duck_wide(src: str, out: str, stages: dict) -> str:
    nn = " AND ".join(f"{c} IS NOT NULL" for c in INDEX)
    sums = ", ".join(f"coalesce(sum(CAST({m} AS DOUBLE)), 0) AS {st}" for m, st in stages.items())
    return (f"{out} AS (SELECT {', '.join(INDEX)}, {sums} FROM {src} WHERE {nn} "
            f"GROUP BY {', '.join(INDEX)})")


EXTRACT_CTES = IMPUTE_CTES + (
    duck_derive("web_f", "web_d", "Website (Self-Service)", "total_spend_eur"),
    duck_derive("leads_f", "leads_d", "Contact Form (Sales-Assisted)", "total_spend"),
    duck_wide("web_d", "web_w", WEB_STAGE),
    duck_wide("leads_d", "leads_w", LEADS_STAGE),
    "all_wide AS (SELECT * FROM web_w UNION ALL BY NAME SELECT * FROM leads_w)",
)
GRAIN = ("date", "country_code", "campaign_id", "pathway", "channel")
FINAL_M = ("spend_value", "orders", "poslite_items_ordered", "sessions", "signups", "clicks",
           "fake_leads", "impressions", "leads", "meeting_done", "pos_lite_deals",
           "signed_leads", "sqls")
FINAL_D = ("country_name", "channel_3", "channel_4", "channel_5", "channel_6", "channel_7", "test")
ORDER_STRUCT = "{" + ", ".join(f"'o{i}': {c}" for i, c in enumerate(
    c for c in INDEX if c not in GRAIN)) + "}"
FINAL_SQL = with_fixtures(*EXTRACT_CTES, body=f"""
SELECT {', '.join(GRAIN)}, {', '.join(f'arg_min({d}, {ORDER_STRUCT}) AS {d}' for d in FINAL_D)},
       {', '.join(f'max({m}) AS {m}' for m in FINAL_M)}
FROM all_wide WHERE {' AND '.join(f'{g} IS NOT NULL' for g in GRAIN)}
GROUP BY {', '.join(GRAIN)}""")
