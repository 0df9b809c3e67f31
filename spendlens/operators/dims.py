"""Dimension repair and dedupe (A-1 .. A-4, M-1, P-12).

"First"/"last" in row order is not defined on a distributed table, so every
operator here takes an explicit total order (``order``).  Per-key lookups are
computed with partial aggregation (skew safe) and joined back broadcast when
their size is proven small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fill_unknown, unknown_to_null


def _order_struct(order: Sequence[str | Column]) -> Column:
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(cols)])


def first_non_null(df: DataFrame, key: str, cols: Sequence[str],
                   order: Sequence[str | Column] | None = None) -> DataFrame:
    """Per key, the first non-null value of every column in ``order`` (A-1, A-6).

    Without ``order`` the smallest non-null value is taken (deterministic).
    """
    aggs = []
    for c in cols:
        if order:
            o = F.when(F.col(c).isNotNull(), _order_struct(order))
            aggs.append(F.min_by(F.col(c), o).alias(c))
        else:
            aggs.append(F.min(c).alias(c))
    return df.groupBy(key).agg(*aggs)


def last_non_null(df: DataFrame, key: str, cols: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    """Per key, the last non-null value of every column in ``order`` (A-4,
    ``sort_values(order).groupby(key).last()``)."""
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), _order_struct(order))).alias(c)
            for c in cols]
    return df.groupBy(key).agg(*aggs)


def first_last_non_null(df: DataFrame, key: str, cols: Sequence[str],
                        order: Sequence[str | Column]) -> DataFrame:
    """``first_<c>`` and ``last_<c>`` of every column in one aggregate (A-1, A-4)."""
    o = _order_struct(order)
    aggs = []
    for c in cols:
        oc = F.when(F.col(c).isNotNull(), o)
        aggs += [F.min_by(F.col(c), oc).alias(f"first_{c}"), F.max_by(F.col(c), oc).alias(f"last_{c}")]
    return df.groupBy(key).agg(*aggs)


def dedupe_dim(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key in ``order`` (ascending, nulls last) (A-2).

    A null key is one group, like ``drop_duplicates``.  Planned as a ranking
    window whose rank-1 filter Spark turns into a partial WindowGroupLimit
    before the exchange.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    w = Window.partitionBy(key).orderBy(*[c.asc_nulls_last() for c in cols])
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def repair_channels(df: DataFrame, key: str = "campaign_id",
                    cols: Sequence[str] = ("channel_3", "channel_4", "channel_5"),
                    ids: Sequence[str] | None = None, fill: bool = True,
                    order: Sequence[str | Column] | None = None) -> DataFrame:
    """Repair missing channels of a campaign from its other rows (M-1).

    ``unknown`` spellings -> null; per key the first non-null value (A-1, in
    ``order``; smallest value without one) fills the nulls of rows whose key is
    in ``ids`` (all keys when ``ids`` is None, P-12); remaining nulls become
    ``unknown`` when ``fill``.

    The per-key values come from a partially aggregated group-by (a key with
    a third of all rows is reduced map-side) joined back on the key; the
    lookup has one row per key, so Spark's size estimate or AQE decides
    between a broadcast and a skew-split shuffle join.
    """
    cleaned = df.withColumns({c: unknown_to_null(c) for c in cols})
    lookup = first_non_null(cleaned, key, cols, order)
    lookup = lookup.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_l_{c}") for c in cols])
    joined = cleaned.join(lookup, cleaned[key] == lookup["_k"], "left")
    in_scope = cleaned[key].isNotNull()
    if ids is not None:
        in_scope = in_scope & cleaned[key].isin(list(ids))
    out = {}
    for c in cols:
        v = F.when(in_scope, F.coalesce(cleaned[c], F.col(f"_l_{c}"))).otherwise(cleaned[c])
        out[c] = fill_unknown(v) if fill else v
    return joined.select(*[out[c].alias(c) if c in out else cleaned[c] for c in df.columns])
