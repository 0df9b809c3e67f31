"""Joins (J-1 .. J-9).

Design rules
* Dimension/lookup sides are broadcast only after a bounded count proves their
  size (``broadcast_if_small``); beyond the bound the plan stays a shuffle join
  and AQE may still switch it at runtime from measured sizes.
* Funnel combination never emits all pairs of a key: each side contributes at
  most its best row per key, chosen by a partial (map-side) aggregate, so a
  hot key is reduced before the shuffle.
* Rows whose equi-key is null can never match; past the broadcast bound they
  bypass the shuffle instead of piling into the one partition that hashes null, and
  keys that hold more than a thousandth of the rows, of which there are fewer than
  a thousand, are joined by broadcast (``left_lookup``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored

# Bounds of a side to be broadcast (dimension tables, maps keyed by campaign).
BROADCAST_MAX_ROWS = 250_000
BROADCAST_MAX_BYTES = 64 << 20


def sized(df: DataFrame, max_rows: int, materialize: bool, max_bytes: int = BROADCAST_MAX_BYTES) -> tuple[bool, DataFrame]:
    """(whether ``df`` is within the bounds, ``df``, checkpointed with ``materialize``)."""
    if materialize:
        df = cut_lineage(df)
    text = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns]
    size = (df.limit(max_rows + 1).select(sum(text, F.lit(0)).alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first())
    return size.n <= max_rows and (size.b or 0) <= max_bytes, df


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       materialize: bool = False, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when ``df`` has at most ``max_rows`` rows and
    ``max_bytes`` bytes of text.

    The check reads at most ``max_rows + 1`` rows.  With ``materialize`` the
    side is first checkpointed to the shared checkpoint folder, so neither the
    check nor the join recomputes its (long) lineage.  Without the hint the
    facts would be shuffled before AQE could see that the other side is small.
    """
    small, df = sized(df, max_rows, materialize, max_bytes)
    return F.broadcast(df) if small else df


#: A key with more than this share of the rows is hot; fewer keys than its inverse can be.
HOT_SHARE = 0.001


def left_lookup(df: DataFrame, ref: DataFrame, key: str, ref_key: str, null_safe: bool = False,
                max_rows: int = BROADCAST_MAX_ROWS, materialize: bool = False, store: bool = False,
                counts: DataFrame | None = None) -> DataFrame:
    """Left join to a reference that is unique per ``ref_key`` (dropped again).

    A reference within the bound is broadcast.  Beyond it the streamed side is split
    in three: rows without key get nulls without an exchange (they match nothing,
    or with ``null_safe`` the one row without key); rows of hot keys, found by a
    counting pass with sums before the exchange, meet their few reference rows by
    broadcast; only the rest is shuffled, in which no key is hot.  Without hot keys
    ``df`` is evaluated once: rows without key go through the same exchange, dealt by
    their content.  ``store`` says that ``df`` costs more to evaluate than to write: beyond
    the bound it is written once, and both the counting pass and the join read that.
    ``counts`` (key, number of rows), where they are known, save the counting pass.
    """
    small, ref = sized(ref, max_rows, materialize)
    if small:
        cond = df[key].eqNullSafe(ref[ref_key]) if null_safe else df[key] == ref[ref_key]
        return df.join(F.broadcast(ref), cond, "left").drop(ref_key)
    if store:
        df = stored(df)
    known = df.where(F.col(key).isNotNull())
    if counts is None:
        counts = cut_lineage(known.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_n")))
    else:
        counts = counts.toDF("_hot_key", "_n")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    # Counts over HOT_SHARE of all rows: fewer than 1 / HOT_SHARE keys.
    hot = counts.where(F.col("_n") > HOT_SHARE * total).select("_hot_key")
    if hot.isEmpty():
        if not df.schema[key].nullable:
            return df.join(ref, df[key] == ref[ref_key], "left").drop(ref_key)
        spread = F.when(df[key].isNull(), F.xxhash64(*[df[c] for c in df.columns]))
        cols = [c for c in ref.columns if c != ref_key]
        rows = df.withColumn("_spread", spread)
        if null_safe:
            # The one row without key, if there is one, as a column for all rows that lack a key.
            own = ref.where(F.col(ref_key).isNull()).select(F.struct(*cols).alias("_own"))
            rows = rows.join(F.broadcast(own), F.col(key).isNull(), "left")
        # Null for every reference row that can match; no literal, or the exchange would not deal by it.
        none = F.when(F.col(ref_key).isNull(), F.lit(0)).cast("long")
        r = ref.select(none.alias("_none"), *[F.col(c).alias(f"_at_{c}") for c in ref.columns])
        out = rows.join(r, (F.col(key) == F.col(f"_at_{ref_key}")) & F.col("_spread").eqNullSafe(F.col("_none")), "left")
        value = (lambda c: F.coalesce(F.col(f"_at_{c}"), F.col("_own")[c])) if null_safe else (lambda c: F.col(f"_at_{c}"))
        return out.select(*df.columns, *[value(c).alias(c) for c in cols])
    hot = F.broadcast(hot)
    hot_ref = F.broadcast(ref.join(hot, ref[ref_key] == hot["_hot_key"], "left_semi"))
    heavy = known.join(hot, known[key] == hot["_hot_key"], "left_semi")
    light = known.join(hot, known[key] == hot["_hot_key"], "left_anti")
    none = df.where(F.col(key).isNull())
    if null_safe:
        own = F.broadcast(ref.where(F.col(ref_key).isNull()))
        nulls = none.join(own, F.lit(True), "left")
    else:
        nulls = none.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in ref.schema.fields])
    parts = [heavy.join(hot_ref, heavy[key] == hot_ref[ref_key], "left"), light.join(ref, light[key] == ref[ref_key], "left"), nulls]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).drop(ref_key)


def combine_funnels(web: DataFrame, leads: DataFrame,
                    keys: Sequence[str] = ("date", "campaign_id", "country_code"),
                    nullable_keys: Sequence[str] = ("country_code",),
                    web_rank: str = "total_spend_eur",
                    leads_rank: str = "total_spend",
                    unmatched: str = "keep") -> DataFrame:
    """Full outer combination of the two funnels on ``keys`` (J-2).

    Keys not in ``nullable_keys`` use plain equality (null never matches);
    ``nullable_keys`` match null to null.  Output: the keys plus all non-key
    columns of both sides.  When a side holds several rows for one key, its
    row with the highest ``coalesce(rank, 0)`` is kept (ties: smallest content,
    column by column, nulls last, as the mart's ranking does), so duplicate keys
    are reconciled, never paired; ``repeated_keys`` reports what was set aside.

    Rows with a null strict key cannot match.  ``unmatched="keep"`` keeps each
    of them as its own row (like the join); ``"best"`` keeps, per side and
    per remaining key values, only the row with the highest rank (what the
    mart's ranking makes of them).

    Plan: one aggregate over the tagged union, partial aggregation before the
    exchange, one scan of each input.  In ``keep`` mode an unmatchable row is
    grouped by its own content (side + all columns), identical copies are
    counted and re-expanded afterwards: deterministic under task retries, no
    row lost, and such rows spread over partitions instead of piling into the
    one partition that hashes the null key.
    """
    strict = [k for k in keys if k not in nullable_keys]
    w_cols = [c for c in web.columns if c not in keys]
    l_cols = [c for c in leads.columns if c not in keys]
    unmatchable = F.lit(False)
    for k in strict:
        unmatchable = unmatchable | F.col(k).isNull()
    if unmatched not in ("keep", "best"):
        raise ValueError(f"unknown unmatched mode {unmatched!r}")

    def tag(df: DataFrame, cols: list[str], rank: str, name: str, side: str) -> DataFrame:
        ordered = [x for i, c in enumerate(cols) for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c))]
        payload = F.struct((-F.coalesce(F.col(rank), F.lit(0))).alias("_rank"), *ordered)
        if unmatched == "keep":
            u = F.when(unmatchable, F.to_json(F.struct(F.lit(side).alias("_side"),
                                                       *[F.col(k) for k in keys], *cols)))
        else:
            u = F.when(unmatchable, F.lit(side))
        return df.select(*keys, u.alias("_u"), payload.alias(name))

    w = tag(web, w_cols, web_rank, "_w", "w")
    l = tag(leads, l_cols, leads_rank, "_l", "l")
    both = (w.unionByName(l, allowMissingColumns=True)
            .groupBy(*keys, "_u")
            .agg(F.min("_w").alias("_w"), F.min("_l").alias("_l"),
                 F.count(F.lit(1)).alias("_n")))
    if unmatched == "keep":
        copies = F.when(F.col("_u").isNotNull(), F.col("_n")).otherwise(F.lit(1))
        both = both.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
    return both.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in w_cols],
                       *[F.col(f"_l.{c}").alias(c) for c in l_cols])


def repeated_keys(df: DataFrame, keys: Sequence[str] = ("date", "campaign_id", "country_code"),
                  strict: Sequence[str] = ("date", "campaign_id")) -> DataFrame:
    """Keys of one funnel that hold several rows, with the number of rows that
    ``combine_funnels`` sets aside for each (``n_aside``)."""
    known = df
    for k in strict:
        known = known.where(F.col(k).isNotNull())
    return (known.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n_aside")).where("n_aside > 0"))


def attach_dim(facts: DataFrame, dim: DataFrame, key: str = "campaign_id", null_safe: bool = False,
               max_rows: int = BROADCAST_MAX_ROWS, store: bool = False) -> DataFrame:
    """Left join facts -> dimension on ``key`` (J-1, J-3).

    The dimension must be unique per key (see ``dims.dedupe_dim``) or facts
    fan out.  ``null_safe`` matches a null key to a null key (pandas merge).
    The dimension is materialised once (checkpoint), its row count bounded,
    and only then broadcast; a larger dimension stays a shuffle join (``store``: see
    ``left_lookup``).
    """
    return left_lookup(facts, dim.withColumnRenamed(key, "_dim_key"), key, "_dim_key", null_safe, max_rows,
                       materialize=True, store=store)


def update_from_lookup(df: DataFrame, ref: DataFrame, key: str,
                       cols: Sequence[str] | None = None,
                       max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Overwrite shared columns with the lookup's non-null values (J-5,
    ``DataFrame.update`` semantics): ``coalesce(ref.c, df.c)``."""
    cols = [c for c in (cols or ref.columns) if c != key and c in df.columns and c in ref.columns]
    r = ref.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_r_{c}") for c in cols])
    out = left_lookup(df, r, key, "_k", max_rows=max_rows, materialize=True)
    return out.select(*[F.coalesce(f"_r_{c}", c).alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_from_reference(df: DataFrame, ref: DataFrame, key: str,
                        cols: Sequence[str] | None = None,
                        max_rows: int = BROADCAST_MAX_ROWS,
                        materialize: bool = False) -> DataFrame:
    """Fill nulls of ``cols`` from a per-key reference (J-6, J-7):
    ``coalesce(df.c, ref.c)``.  A null key finds nothing."""
    cols = [c for c in (cols or ref.columns) if c != key and c in df.columns and c in ref.columns]
    if not cols:
        return df
    r = ref.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_r_{c}") for c in cols])
    out = left_lookup(df, r, key, "_k", max_rows=max_rows, materialize=materialize)
    return out.select(*[F.coalesce(c, f"_r_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def restrict_to_overlap(df: DataFrame, other: DataFrame,
                        keys: str | Sequence[str] = "campaign_id") -> DataFrame:
    """Rows of ``df`` whose (non-null) key also occurs in ``other`` (J-9, left
    semi join; the key set is deduplicated with partial aggregation first)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    ks = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    for i in range(len(keys)):
        ks = ks.where(F.col(f"_k{i}").isNotNull())
    ks = ks.distinct()
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & (df[k] == ks[f"_k{i}"])
    return df.join(ks, cond, "left_semi")


def missing_in_dim(fact: DataFrame, dim: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Fact rows whose non-null key is absent from the dimension (J-8, left
    anti join; null keys are the not_null check's business)."""
    keys = dim.select(F.col(key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    f = fact.where(F.col(key).isNotNull())
    return f.join(keys, f[key] == keys["_k"], "left_anti")
