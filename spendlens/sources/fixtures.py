"""Marketing sources derived from the driver's TPC-H-like tables.

The reference ships only a 120-row channel seed; its two fact files are not
public.  These builders derive sources with the reference's schemas (and its
kinds of dirt) from ``part``, ``lineitem``, ``orders`` and ``customer`` so every
operator runs over whole tables and its work grows with them:

* channels: one campaign for every ten part keys, so their number grows with the
  data; every campaign twice (clean + dirty row; the dirty one has spaced-out
  words, case, blanks and no-break spaces).
* web_orders: non-returned lines per order date x customer country x campaign;
  some lines have no campaign id, some days a negative spend.
* leads_funnel: returned lines per order date x country x campaign, with a name
  for every fourth campaign and dirty channel text for two of three; lines
  without campaign id keep their name and channels, so a day and country may
  hold several rows without id.  Some rows lack clicks or have more deals than
  signed leads.

The same definitions exist as DuckDB SQL in ``spendlens.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import read_table

# Part keys of one campaign.
PARTS_PER_CAMPAIGN = 10
# channel_3 codes chosen by campaign number modulo 7.
CHANNEL_CODES = ("fb", "bing-search", "bing-shopping", "search", "search-shopping", "max",
                 "demandgen")


def _country(nationkey: Column) -> Column:
    k = nationkey % 5
    return (F.when(k == 0, " es ").when(k == 1, "GB").when(k == 2, "ie").when(k == 3, "CH"))


def _campaign(partkey: Column) -> Column:
    return F.floor(partkey / PARTS_PER_CAMPAIGN).cast("bigint")


def _c3(k: Column) -> Column:
    m = k % 7
    expr = F.when(m == 0, CHANNEL_CODES[0])
    for i, code in enumerate(CHANNEL_CODES[1:-1], start=1):
        expr = expr.when(m == i, code)
    return expr.otherwise(CHANNEL_CODES[-1])


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    base = (part.groupBy(_campaign(F.col("p_partkey")).alias("k"))
            .agg(F.min_by(F.lower("p_type"), "p_partkey").alias("ty"))
            .withColumn("c3", _c3(F.col("k"))))
    k, ty, c3 = F.col("k"), F.col("ty"), F.col("c3")
    ks = k.cast("string")
    is_test = (k % 10) == 3
    clean = F.struct(
        ks.alias("campaign_id"),
        F.concat(c3, F.lit("_gb_"), ty, F.lit("_prospecting"),
                 F.when(is_test, "_convgoaltest").otherwise(""), F.lit("_"), ks)
        .alias("campaign_name"),
        F.when(k % 3 == 0, "alwayson").when(k % 3 == 1, "unknown")
        .alias("campaign_period_budget_category"),
        c3.alias("channel_3"),
        F.concat(c3, F.lit(" prospecting")).alias("channel_4"),
        F.concat(c3, F.lit(" prospecting "), ty).alias("channel_5"),
    )
    dirty = F.struct(
        F.concat(F.lit(" "), ks, F.lit(" ")).alias("campaign_id"),
        F.concat(F.lit("\u00a0"), F.upper(c3), F.lit("\u00a0_gb_"), ty, F.lit("__P r o s p e c t i n g"),
                 F.when(is_test, "_convgoalTest ").otherwise(""), F.lit("_"), ks)
        .alias("campaign_name"),
        F.when(k % 3 == 0, "alwayson").alias("campaign_period_budget_category"),
        F.concat(c3, F.lit(" ")).alias("channel_3"),
        F.concat(c3, F.lit("  prospecting ")).alias("channel_4"),
        F.when(k % 11 != 0, F.concat(c3, F.lit("  prospecting "), ty)).alias("channel_5"),
    )
    # one aggregation of part, two rows (clean + dirty) per campaign
    return base.select(F.explode(F.array(clean, dirty)).alias("r")).select("r.*")


def _fact_lines(spark: SparkSession, sf_dir: str, returned: bool) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    li = li.where(F.col("l_returnflag") == "R") if returned else li.where(F.col("l_returnflag") != "R")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # The customer's nation is joined to the narrow orders, so that lines are shuffled once.
    orders = orders.join(cust, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey")
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderdate").cast("date").alias("date"),
                    _country(F.col("c_nationkey")).alias("country_code"),
                    _campaign(F.col("l_partkey")).alias("k"),
                    F.when(F.col("l_partkey") % 97 != 0, _campaign(F.col("l_partkey")).cast("string"))
                    .alias("campaign_id"),
                    "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_linestatus",
                    "l_linenumber"))


def _money(amount: Column, rate: Column) -> Column:
    return F.sum(amount.cast("decimal(12,2)") * rate.cast("decimal(4,2)")).cast("decimal(18,4)")


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def web_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return (_fact_lines(spark, sf_dir, False)
            .groupBy("date", "country_code", "campaign_id")
            .agg((_money(F.col("l_extendedprice"), F.col("l_discount"))
                  - F.when(F.col("campaign_id").isNotNull() & (F.sum("l_linenumber") % 17 == 0), 100000)
                  .otherwise(0)).cast("decimal(18,4)").alias("total_spend_eur"),
                 (F.sum(q) * 10).cast("bigint").alias("nb_of_sessions"),
                 F.sum(q).cast("bigint").alias("nb_of_signups"),
                 F.count(F.lit(1)).alias("nb_of_orders"),
                 _count_if(F.col("l_linestatus") == "F").alias("nb_of_poslite_items_ordered")))


LEAD_TEXT = ("campaign_name", "channel_3", "channel_4", "channel_5")


def _with_lead_text(lines: DataFrame) -> DataFrame:
    k = F.col("k")
    m = k % 3
    return lines.withColumns({
        "campaign_name": F.when(k % 4 == 0, F.concat(F.lit("Lead  Campaign_"), k.cast("string"))),
        "channel_3": F.when(m == 0, "Search ").when(m == 1, "fb"),
        "channel_4": F.when(m == 0, "search  prospecting").when(m == 1, "fb\u00a0prospecting"),
        "channel_5": F.when(m == 0, "search  prospecting  Generic ").when(m == 1, "fb prospecting Video")})


def leads_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, tax = F.col("l_quantity"), F.col("l_tax")
    done = F.col("l_linestatus") == "F"
    lines = _with_lead_text(_fact_lines(spark, sf_dir, True))
    return (lines.groupBy("date", "country_code", "campaign_id", "campaign_name", "channel_3", "channel_4",
                          "channel_5")
            .agg(_money(F.col("l_extendedprice"), tax).alias("total_spend"),
                 (F.sum(q) * 100).cast("bigint").alias("total_impressions"),
                 F.when(F.sum("l_linenumber") % 11 != 0, (F.sum(q) * 10).cast("bigint")).alias("total_clicks"),
                 F.sum(q).cast("bigint").alias("total_leads"),
                 F.sum("l_linenumber").cast("bigint").alias("total_sqls"),
                 F.count(F.lit(1)).alias("total_meeting_done"),
                 _count_if(done).alias("total_signed_leads"),
                 F.when(F.sum("l_linenumber") % 13 == 0, _count_if(tax >= 0))
                 .otherwise(_count_if(done & (tax > 0.04))).alias("total_pos_lite_deals"),
                 _count_if(tax == 0).alias("total_fake_leads")))


def with_loaded_at(df: DataFrame, hours_after: int = 30) -> DataFrame:
    """Add ``_etl_loaded_at`` as a fixed offset after the fact date."""
    return df.withColumn(
        "_etl_loaded_at",
        (F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(hours_after))))


def web_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the web fact: a first, partial load (finished lines only)
    one day after the date and a restated full load two days after it.

    Both loads come from one conditional aggregation (one scan); a first-load
    row exists only where the key had finished lines."""
    q = F.col("l_quantity")
    done = F.col("l_linestatus") == "F"
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")
    agg = (_fact_lines(spark, sf_dir, False)
           .groupBy("date", "country_code", "campaign_id")
           .agg(F.count(F.when(done, 1)).alias("_n1"),
                F.sum(F.when(done, amount)).cast("decimal(18,4)").alias("_s1"),
                (F.sum(F.when(done, q)) * 100).cast("bigint").alias("_i1"),
                F.sum(amount).cast("decimal(18,4)").alias("_s2"),
                (F.sum(q) * 100).cast("bigint").alias("_i2")))
    loads = F.array(
        F.struct(F.lit(1).alias("v"), F.col("_n1").alias("n"), F.col("_s1").alias("s"),
                 F.col("_i1").alias("i")),
        F.struct(F.lit(2).alias("v"), F.lit(1).cast("bigint").alias("n"), F.col("_s2").alias("s"),
                 F.col("_i2").alias("i")))
    return (agg.select("date", "country_code", "campaign_id", F.explode(loads).alias("l"))
            .where(F.col("l.n") > 0)
            .select("date", "country_code", "campaign_id",
                    F.col("l.s").alias("total_spend_eur"), F.col("l.i").alias("impressions"),
                    (F.col("date").cast("timestamp_ntz")
                     + F.make_dt_interval(F.col("l.v"), F.lit(6))).alias("_etl_loaded_at")))


def leads_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads (column ``load``) of the leads fact: finished lines one day after
    the date, all lines two days after it, and for every fifth campaign a third load
    with the second one's time that counts one lead more."""
    q, k = F.col("l_quantity"), F.col("k")
    done = F.col("l_linestatus") == "F"
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")
    lines = _with_lead_text(_fact_lines(spark, sf_dir, True))
    agg = (lines.groupBy("date", "country_code", "campaign_id", *LEAD_TEXT)
           .agg(F.count(F.when(done, 1)).alias("n1"), F.max(k % 5 == 0).cast("long").alias("n3"),
                F.sum(F.when(done, amount)).cast("decimal(18,4)").alias("s1"), F.sum(amount).cast("decimal(18,4)").alias("s2"),
                F.sum(F.when(done, q)).cast("bigint").alias("q1"), F.sum(q).cast("bigint").alias("q2")))

    def load(number: int, n: str, spend: str, count: str, days: int, more: int = 0) -> Column:
        return F.struct(F.lit(f"load-{number}").alias("load"), F.col(n).alias("n"), F.col(spend).alias("total_spend"),
                        (F.col(count) * 100).alias("total_impressions"), (F.col(count) + more).alias("total_leads"),
                        F.lit(days).alias("days"))
    loads = F.array(load(1, "n1", "s1", "q1", 1), load(2, "n2", "s2", "q2", 2), load(3, "n3", "s2", "q2", 2, 1))
    return (agg.withColumn("n2", F.lit(1).cast("long")).select("date", "country_code", "campaign_id", *LEAD_TEXT, F.explode(loads).alias("l"))
            .where(F.col("l.n") > 0)
            .select("date", "country_code", "campaign_id", *LEAD_TEXT, "l.total_spend", "l.total_impressions", "l.total_leads",
                    (F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.col("l.days"), F.lit(6))).alias("_etl_loaded_at"),
                    "l.load"))


def raw_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty id spellings derived from every part key: float suffixes, blanks,
    scientific notation, NA spellings and text with digits."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey").cast("string")
    sci = F.concat(F.substring(k, 1, 1), F.lit("."), F.substring(k, 2, 100), F.lit("e"),
                   (F.length(k) - 1).cast("string"))
    m = F.col("p_partkey") % 8
    raw = (F.when(m == 0, k)
           .when(m == 1, F.concat(k, F.lit(".0")))
           .when(m == 2, F.concat(F.lit("  "), k, F.lit(".000000 ")))
           .when(m == 3, sci)
           .when(m == 4, F.upper(sci))
           .when(m == 5, F.when(F.col("p_partkey") % 16 == 5, F.lit("nan")).otherwise(F.lit("None")))
           .when(m == 6, F.concat(F.lit("te"), k, F.lit("t")))
           .otherwise(F.concat(F.split(F.col("p_name"), " ").getItem(0), k)))
    return part.select(F.col("p_partkey"), raw.alias("raw_id"))
