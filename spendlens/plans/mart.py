"""Campaign performance mart: both funnels at daily grain with CAC and
throughput KPIs (J-2 .. J-4, W-1, W-2, P-6, P-7, F-19 .. F-24, K-1 .. K-4).

Plan (grain="country", the default): one aggregate combines the funnels per
(date, campaign_id, country_code) with partial aggregation before the exchange.
All text work (name, slug, key, channels) is done on the deduped channel
dimension, one row per campaign, before the join; a fact row pays for its own
channel text only where the dimension has no value.  Because the combination
already yields the best row per key and side, the reference's two ranking
windows and its second full outer join are no-ops at this grain and are not
planned.  Rows without campaign id never match; per (date, country) and side
their best row is kept, which is what the reference's ranking keeps of them.

grain="campaign" reproduces the reference's literal ranking per
(campaign_id, campaign_name, date) across countries: one more aggregate takes
the web winner and the sales winner of a key together, and one or two rows come
out of it, as the null-safe full outer join of the winners would give.  It runs
before the dimension is attached (the name follows from the id), so no text of
the dimension is ranked or shuffled, and holds each candidate once, in the order
of the ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import campaign_key
from ..functions.text import clean_string, name_slug, nullif_blank
from ..operators.joins import attach_dim, combine_funnels
from ..operators.kpi import with_kpis
from ..operators.reshape import LEADS_STAGES, WEB_STAGES
from ..sources.schemas import CHANNEL_COLS, WEB_METRICS
from .facts import dim_campaign_channels, fct_leads, fct_web

# The mart's names of the metrics are the stage names; fake leads are not part of it.
WEB_RENAMES = WEB_STAGES
SALES_RENAMES = {m: s for m, s in LEADS_STAGES.items() if s != "fake_leads"}
KEY_DIMS = ("date", "country_code", "campaign_id", "campaign_key", "campaign_name",
            "campaign_period_budget_category", *CHANNEL_COLS)
WEB_SIDE = ("total_spend_eur", *WEB_METRICS)
SALES_SIDE = ("total_spend", *SALES_RENAMES)
TIEBREAK = ("country_code", *WEB_SIDE, *SALES_SIDE)
MART_COLUMNS = (*KEY_DIMS, *WEB_RENAMES.values(), *SALES_RENAMES.values(),
                "total_spend_web", "total_spend_sales", "cac_per_pos_lite_deal",
                "cac_per_pos_lite_order_web", "web_funnel_throughput", "sales_funnel_throughput")


def text_dim(dim: DataFrame) -> DataFrame:
    """The deduped dimension with everything that is derived from its text:
    campaign name, key suffix, trimmed category and non-blank channels.  The
    dimension's text is already clean (``stg_channels``)."""
    name = F.col("campaign_name")
    return dim.select(
        "campaign_id",
        campaign_key(F.lit(""), name_slug(name)).alias("_d_suffix"),
        nullif_blank(name).alias("_d_name"),
        F.trim("campaign_period_budget_category").cast("string").alias("campaign_period_budget_category"),
        *[nullif_blank(F.col(c)).alias(f"_d_{c}") for c in CHANNEL_COLS])


def enrich(combined: DataFrame, dim: DataFrame, clean: bool = False) -> DataFrame:
    """Resolve campaign name, key, budget category and channels from the
    dimension, falling back to the lead-side channels (J-3, F-19 .. F-22);
    ``clean``: these are clean already."""
    r = attach_dim(combined, text_dim(dim), "campaign_id", store=True)
    unknown = F.lit("__unknown")
    return r.select(
        "date", "country_code", "campaign_id",
        F.concat("campaign_id", F.coalesce("_d_suffix", unknown)).alias("campaign_key"),
        F.col("_d_name").alias("campaign_name"),
        "campaign_period_budget_category",
        *[F.coalesce(F.col(f"_d_{c}"), nullif_blank(F.col(f"l_{c}") if clean else clean_string(f"l_{c}"))).alias(c)
          for c in CHANNEL_COLS],
        *WEB_SIDE, *SALES_SIDE)


def _ordered(rank: str, dims: tuple) -> F.Column:
    """A row as a struct of which the ranking's first is the smallest: highest ``coalesce(rank, 0)``,
    then TIEBREAK ascending with nulls last; the dims that are not ranked come last."""
    parts = [(-F.coalesce(F.col(rank), F.lit(0))).alias("_rank")]
    for i, t in enumerate(TIEBREAK):
        parts += [F.col(t).isNull().alias(f"_n{i}"), F.col(t)]
    return F.struct(*parts, *[F.col(d) for d in dims if d not in TIEBREAK])


def recombine_best(rows: DataFrame, partition: tuple, dims: tuple = KEY_DIMS) -> DataFrame:
    """Best web row and best sales row per ``partition``, recombined as a full
    outer join on date, campaign_id (=), campaign_name and country_code
    (null-safe) would do it; keys and other ``dims`` coalesced, web metrics from the
    web winner and sales metrics from the sales winner (W-1, W-2, J-4, D-1 .. D-3).

    One aggregate holds both winners of a key; they share date, id and name, so
    they match where the countries agree and date and id are known, and then
    they are one row, else two.
    """
    best = rows.groupBy(*[F.col(c).alias(f"_p_{c}") for c in partition]).agg(
        F.min(_ordered("total_spend_eur", dims)).alias("w"), F.min(_ordered("total_spend", dims)).alias("s"))
    types = {f.name: f.dataType for f in rows.schema.fields}
    w, s = F.col("w"), F.col("s")
    meet = (w["date"].isNotNull() & w["campaign_id"].isNotNull()
            & w["country_code"].eqNullSafe(s["country_code"]))

    def out(dim, web, sales):
        return F.struct(*[dim(c).alias(c) for c in dims],
                        *[(web[c] if web is not None else F.lit(None).cast(types[c])).alias(c) for c in WEB_SIDE],
                        *[(sales[c] if sales is not None else F.lit(None).cast(types[c])).alias(c) for c in SALES_SIDE])
    found = F.when(meet, F.array(out(lambda c: F.coalesce(w[c], s[c]), w, s))).otherwise(
        F.array(out(lambda c: w[c], w, None), out(lambda c: s[c], None, s)))
    return best.select(F.explode(found).alias("x")).select("x.*")


def finalize(best: DataFrame) -> DataFrame:
    """Rename to mart vocabulary and add the KPIs (P-7, K-1 .. K-4)."""
    renamed = best.select(
        *KEY_DIMS,
        *[F.col(src).alias(dst) for src, dst in WEB_RENAMES.items()],
        *[F.col(src).alias(dst) for src, dst in SALES_RENAMES.items()],
        F.col("total_spend_eur").alias("total_spend_web"),
        F.col("total_spend").alias("total_spend_sales"))
    return with_kpis(renamed).select(*MART_COLUMNS)


def build_mart(web: DataFrame, leads: DataFrame, channels: DataFrame | None = None,
               grain: str = "country", since=None, dim: DataFrame | None = None,
               clean_leads: bool = False) -> DataFrame:
    """The mart from raw web/leads facts and the raw channel table.

    ``since``: lookback lower bound on ``date`` (pushed to the fact scans and
    re-applied at the end, I-1).  ``dim``: an already deduped dimension.
    ``clean_leads``: the leads' channels are clean already (``clean_texts``).
    """
    if dim is None:
        dim = dim_campaign_channels(channels)
    if grain == "country":
        # One row per (date, campaign, country) and side already is the ranking's
        # answer at this grain: rows without id keep their best row per side.
        best = enrich(combine_funnels(fct_web(web, since), fct_leads(leads, since, clean=False),
                                      unmatched="best"), dim, clean_leads)
    elif grain == "campaign":
        # The name follows from the id, and winners of one key that match are one combined row:
        # so the ranking needs no text of the dimension, which is attached to its few winners.
        combined = combine_funnels(fct_web(web, since), fct_leads(leads, since, clean=False))
        winners = recombine_best(combined, ("campaign_id", "date"),
                                 ("date", "country_code", "campaign_id", *[f"l_{c}" for c in CHANNEL_COLS]))
        best = enrich(winners, dim, clean_leads)
    else:
        raise ValueError(f"unknown grain {grain!r}")
    out = finalize(best)
    return out.where(F.col("date") >= F.lit(since)) if since is not None else out
