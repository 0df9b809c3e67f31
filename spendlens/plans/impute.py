"""Gap filling across the web and leads facts (M-1 .. M-7, J-1, J-5 .. J-7,
A-7, A-8, U-1).

Order matters and is kept: NA spellings are normalised; id->name and
name->id maps are built from both tables and applied (name from id first,
then id from the already filled name); two attribute references (mode per id,
mode per name) are built *before* any fill; attributes are filled by id, then
by name.

Scale: both facts are reduced once to a summary, the row count of every
combination of id, name and attributes.  The maps come from the summary, the
maps are applied to the summary, and the references are modes over it weighted by
its counts.  What a row is filled with follows from its id and name alone, so the
maps and references are joined to the pairs of id and name of each fact, and the
fact, read once more, meets only these pairs: one join (broadcast behind a size
check).  Only the summary, the maps, the references and the pairs are
materialised; no fact is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import fix_campaign_id
from ..functions.text import clean_string, normalize_na
from ..operators.aggregates import build_reference
from ..operators.dims import dedupe_dim, repair_channels
from ..operators.joins import (BROADCAST_MAX_ROWS, attach_dim, broadcast_if_small, fill_from_reference, left_lookup,
                               sized)
from ..session import cut_lineage, stored, worked_once
from ..sources.schemas import CHANNEL_COLS

KEY_ID = "campaign_id"
KEY_NAME = "campaign_name"
# Attributes filled from the references, in the reference's order.
ATTR_COLS = ("campaign_period_budget_category", "country_code", "channel_3", "channel_4",
             "channel_5")


def prepare_channels(raw: DataFrame) -> DataFrame:
    """Channel table as the notebook uses it: ids repaired, text cleaned,
    missing channels taken from the id's other rows (``unknown`` when none),
    one row per id (first in channel order), exact duplicates removed."""
    ch = worked_once(raw, lambda d: d.select(
        fix_campaign_id(KEY_ID).alias(KEY_ID),
        clean_string(KEY_NAME).alias(KEY_NAME),
        F.col("campaign_period_budget_category"),
        *[clean_string(c).alias(c) for c in CHANNEL_COLS]))
    ch = repair_channels(ch, KEY_ID, CHANNEL_COLS, fill=True)
    return dedupe_dim(ch, KEY_ID, [*CHANNEL_COLS, KEY_NAME, "campaign_period_budget_category"])


def prepare_web(raw_web: DataFrame, channels: DataFrame) -> DataFrame:
    """Web fact with repaired ids, joined to the prepared channel table (J-1,
    null-safe like pandas ``merge``)."""
    web = raw_web.withColumn(KEY_ID, fix_campaign_id(KEY_ID))
    return attach_dim(web, prepare_channels(channels), KEY_ID, null_safe=True)


def by_value(df: DataFrame, cols: Sequence[str], work: Callable[[DataFrame], DataFrame],
             max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``work(df)``, done once for each combination of values of ``cols``, where ``work``
    changes or adds columns that follow from ``cols`` alone.

    The combinations are found by one pass over these columns and joined back by
    broadcast; past the broadcast bound every row is worked on for itself.
    """
    values = df.select(*cols).distinct().withColumns({f"_raw_{c}": F.col(c) for c in cols})
    small, values = sized(work(values), max_rows, materialize=True)
    if not small:
        return work(df)
    cond = F.lit(True)
    for c in cols:
        cond = cond & df[c].eqNullSafe(values[f"_raw_{c}"])
    added = [c for c in values.columns if c not in df.columns and c not in {f"_raw_{x}" for x in cols}]
    return (df.join(F.broadcast(values), cond, "left")
            .select(*[values[c] if c in cols else df[c] for c in df.columns], *[values[c] for c in added]))


def clean_texts(df: DataFrame, cols: Sequence[str], max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``clean_string`` of ``cols``, worked out once for each combination of their values."""
    return by_value(df, cols, lambda d: d.withColumns({c: clean_string(c) for c in cols}), max_rows)


def prepare_leads(raw_leads: DataFrame) -> DataFrame:
    """Leads fact with repaired ids and cleaned name/channels."""
    return clean_texts(raw_leads, (KEY_NAME, *CHANNEL_COLS)).withColumn(KEY_ID, fix_campaign_id(KEY_ID))


def normalize_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NA spellings -> null in the present columns (F-7)."""
    return df.withColumns({c: normalize_na(c) for c in cols if c in df.columns})


def normalized_by_value(web: DataFrame, leads: DataFrame, channels: DataFrame,
                        attrs: Sequence[str] = ATTR_COLS, max_rows: int = BROADCAST_MAX_ROWS) -> list[DataFrame]:
    """``normalized(prepare_web(web, channels), prepare_leads(leads))``, the text and id work
    done once for each combination of values (``by_value``).  Reads each fact twice: for
    stored facts."""
    text = [KEY_ID, KEY_NAME, *[c for c in attrs if c not in web.columns]]
    names = [KEY_NAME, *CHANNEL_COLS]
    web = by_value(web, [KEY_ID], lambda d: normalize_frame(prepare_web(d, channels), text), max_rows)
    leads = by_value(leads, [KEY_ID, *names], lambda d: normalize_frame(
        d.withColumns({KEY_ID: fix_campaign_id(KEY_ID), **{c: clean_string(c) for c in names}}), [KEY_ID, *names]), max_rows)
    rest = [[c for c in attrs if c not in done] for done in (text, names)]
    return [normalize_frame(df, cols) for df, cols in zip((web, leads), rest)]


def summarize(frames: Sequence[DataFrame], attrs: Sequence[str] = ATTR_COLS, weight: str | None = None) -> DataFrame:
    """Row count ``n`` of every (id, name, attributes) over all frames; columns
    that a frame lacks count as null; ``weight`` names a column that says how many
    rows a row stands for."""
    cols = [KEY_ID, KEY_NAME, *attrs]
    n = F.lit(1).cast("long") if weight is None else F.col(weight)
    parts = [df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in cols], n.alias("_rows"))
             for df in frames]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy(*cols).agg(F.sum("_rows").alias("n"))


def campaign_maps(a: DataFrame, b: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """id->name where the id has exactly one name; name->id where the name has
    exactly one id; judged separately over distinct non-null pairs (M-2)."""
    parts = [df.select(KEY_ID, KEY_NAME) for df in (a, b)
             if df is not None and KEY_ID in df.columns and KEY_NAME in df.columns]
    pairs = parts[0]
    for p in parts[1:]:
        pairs = pairs.unionByName(p)
    pairs = pairs.where(F.col(KEY_ID).isNotNull() & F.col(KEY_NAME).isNotNull()).distinct()
    id_to_name = (pairs.groupBy(KEY_ID)
                  .agg(F.count(F.lit(1)).alias("_n"), F.min(KEY_NAME).alias("_name"))
                  .where(F.col("_n") == 1).select(KEY_ID, "_name"))
    name_to_id = (pairs.groupBy(KEY_NAME)
                  .agg(F.count(F.lit(1)).alias("_n"), F.min(KEY_ID).alias("_id"))
                  .where(F.col("_n") == 1).select(KEY_NAME, "_id"))
    return id_to_name, name_to_id


def apply_campaign_maps(df: DataFrame, id_to_name: DataFrame, name_to_id: DataFrame,
                        max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Fill name from id, then id from the (filled) name (M-3).  The maps must
    be cheap to evaluate twice (see ``impute_campaigns``: materialised)."""
    if KEY_ID not in df.columns or KEY_NAME not in df.columns:
        return df
    cols = df.columns
    m1 = broadcast_if_small(id_to_name.withColumnRenamed(KEY_ID, "_k1"), max_rows)
    step1 = (df.join(m1, df[KEY_ID] == m1["_k1"], "left")
             .select(*[F.coalesce(df[KEY_NAME], F.col("_name")).alias(c) if c == KEY_NAME
                       else df[c] for c in cols]))
    m2 = broadcast_if_small(name_to_id.withColumnRenamed(KEY_NAME, "_k2"), max_rows)
    return (step1.join(m2, step1[KEY_NAME] == m2["_k2"], "left")
            .select(*[F.coalesce(step1[KEY_ID], F.col("_id")).alias(c) if c == KEY_ID
                      else step1[c] for c in cols]))


def references(frames: Sequence[DataFrame], attrs: Sequence[str] = ATTR_COLS
               ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(id->name, name->id, attributes by id, attributes by name) of normalised
    frames, all from one summary (M-2 .. M-4)."""
    return references_of(cut_lineage(summarize(frames, attrs)), attrs)


def references_of(summary: DataFrame, attrs: Sequence[str] = ATTR_COLS
                  ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``references`` from a materialised summary."""
    id_to_name, name_to_id = map(cut_lineage, campaign_maps(summary))
    mapped = cut_lineage(apply_campaign_maps(summary, id_to_name, name_to_id))
    return (id_to_name, name_to_id, *[cut_lineage(build_reference(mapped, None, k, attrs, weight="n"))
                                      for k in (KEY_ID, KEY_NAME)])


def normalized(web: DataFrame, leads: DataFrame, attrs: Sequence[str] = ATTR_COLS) -> list[DataFrame]:
    return [normalize_frame(df, [KEY_ID, KEY_NAME, *attrs]) for df in (web, leads)]


def impute_campaigns(web: DataFrame, leads: DataFrame, attrs: Sequence[str] = ATTR_COLS
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole fill pass over prepared web and leads (M-7).

    Returns (web, leads, ref_by_id); ``ref_by_id`` is the exported
    id -> attributes map (M-6).
    """
    return impute_normalized(normalized(web, leads, attrs), attrs)


def impute_by_value(web: DataFrame, leads: DataFrame, channels: DataFrame, attrs: Sequence[str] = ATTR_COLS,
                    max_rows: int = BROADCAST_MAX_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``impute_campaigns(prepare_web(web, channels), prepare_leads(leads))``.

    What a row is filled with follows from its own id, name and attributes.  So each
    fact is reduced to their combinations and how many rows each stands for; all text
    work, the dimension's join, the maps and the references run over these, and the
    fact meets the filled combinations by one join.  Reads each fact twice, and at first
    these columns only: for stored facts.
    """
    facts, sides = (web, leads), []
    decide = [[c for c in (KEY_ID, KEY_NAME, *attrs, *CHANNEL_COLS) if c in df.columns] for df in facts]
    decide = [list(dict.fromkeys(cols)) for cols in decide]
    for df, cols in zip(facts, decide):
        sides.append(stored(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).withColumn("_raw", F.struct(*cols))))
    frames = normalized(prepare_web(sides[0], channels), prepare_leads(sides[1]), attrs)
    *filled, by_id = impute_normalized(frames, attrs, weight="_n")

    def fill(i: int) -> DataFrame:
        out = [*facts[i].columns, *[c for c in filled[i].columns if c not in (*facts[i].columns, "_n", "_raw")]]
        values = stored(filled[i].select(F.col("_raw").alias("_k"), *[c for c in filled[i].columns if c not in ("_n", "_raw")]))
        rest = [c for c in facts[i].columns if c not in decide[i]]
        rows = facts[i].select(F.struct(*decide[i]).alias("_raw"), *rest)
        return left_lookup(rows, values, "_raw", "_k", max_rows=max_rows, counts=sides[i].select("_raw", "_n")).select(*out)
    return fill(0), fill(1), by_id


def impute_normalized(frames: Sequence[DataFrame], attrs: Sequence[str] = ATTR_COLS, weight: str | None = None
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``impute_campaigns`` of the two normalised facts (``weight``: see ``summarize``)."""
    # One pass over both facts; a row of the summary knows its fact.
    sides = [summarize([df], attrs, weight).withColumn("_side", F.lit(i)) for i, df in enumerate(frames)]
    summary = cut_lineage(sides[0].unionByName(sides[1]))
    id_to_name, name_to_id, by_id, by_name = references_of(summary, attrs)

    def fill(i: int) -> DataFrame:
        pairs = summary.where(F.col("_side") == i).select(KEY_ID, KEY_NAME).distinct()
        blank = pairs.withColumns({"_pair": id_name_pair(KEY_ID, KEY_NAME), **{c: F.lit(None).cast("string") for c in attrs}})
        known = apply_campaign_maps(blank.where(F.col("_pair").isNotNull()), id_to_name, name_to_id)
        known = fill_from_reference(fill_from_reference(known, by_id, KEY_ID, attrs), by_name, KEY_NAME, attrs)
        return fill_by_pair(frames[i], known, attrs)
    return fill(0), fill(1), by_id


def id_name_pair(campaign_id: str, campaign_name: str) -> Column:
    """Id and name as one key, in which either may be null; null where both are."""
    i, n = F.col(campaign_id), F.col(campaign_name)
    return F.when(i.isNotNull() | n.isNotNull(), F.struct(i.alias("id"), n.alias("name")))


def fill_by_pair(df: DataFrame, known: DataFrame, attrs: Sequence[str] = ATTR_COLS,
                 max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Fill nulls of id, name and ``attrs`` from ``known``, which holds the values of
    each pair of id and name (M-3, M-7 in one join)."""
    cols = [c for c in (KEY_ID, KEY_NAME, *attrs) if c in df.columns]
    ref = known.select(F.col("_pair").alias("_k"), *[F.col(c).alias(f"_r_{c}") for c in cols])
    out = left_lookup(df.withColumn("_pair", id_name_pair(KEY_ID, KEY_NAME)), ref, "_pair", "_k", max_rows=max_rows,
                      materialize=True)
    return out.select(*[F.coalesce(c, f"_r_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])
