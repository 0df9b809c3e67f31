"""Aggregations (A-5, A-7 .. A-18).

All are hash/sort aggregates with partial (map-side) aggregation, so a key
holding a large share of the rows is reduced before it is shuffled.  Lists of
values are built over already-distinct (key, value) pairs, and only up to a bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import null_sentinel
from ..session import cut_lineage
from .joins import broadcast_if_small

#: Values of one key and column that are listed in one row.
LIST_MAX = 10_000


def mode_non_null(c) -> Column:
    """Most frequent non-null value, ties -> smallest (A-7)."""
    return F.mode(F.col(c) if isinstance(c, str) else c, deterministic=True)


def build_reference(a: DataFrame, b: DataFrame | None, key: str, attrs: Sequence[str],
                    weight: str | None = None) -> DataFrame:
    """Per key, the mode of every attribute over the union of two tables (A-8).

    Tables may lack some attributes (missing -> null); null keys are dropped;
    ties -> smallest value; ``weight`` names a column that says how many rows a
    row stands for.  Two aggregates: rows are counted by (key, attribute,
    value), map-side first, then the best value of each attribute is taken from
    these counts.
    """
    tables = [t for t in (a, b) if t is not None and key in t.columns]
    present = [c for c in attrs if any(c in t.columns for t in tables)]
    if not tables or not present:
        raise ValueError(f"no key {key!r} or attributes to build a reference from")
    n = F.lit(1).cast("long") if weight is None else F.col(weight)
    parts = [t.select(key, *[c for c in present if c in t.columns], n.alias("_n")) for t in tables]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    counted = (rows.where(F.col(key).isNotNull())
               .unpivot([key, "_n"], list(present), "_attr", "_value")
               .groupBy(key, "_attr", "_value").agg(F.sum("_n").alias("_n")))
    order = F.struct(-F.col("_n"), F.col("_value"))

    def best(c: str) -> Column:
        hit = (F.col("_attr") == c) & F.col("_value").isNotNull()
        return F.min_by("_value", F.when(hit, order)).alias(c)
    return counted.groupBy(key).agg(*[best(c) for c in present])


def count_distinct(c, approx: bool = False, rsd: float = 0.01) -> Column:
    """Distinct count (A-9); ``approx`` uses HyperLogLog++ (fixed memory per
    group, mergeable partial aggregates) for very large groups."""
    col = F.col(c) if isinstance(c, str) else c
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)


def distinct_sketches(df: DataFrame, by: Sequence[str], cols: Sequence[str], lg_k: int = 12) -> DataFrame:
    """HyperLogLog sketches of the distinct values of ``cols`` per group (A-9): a few
    KB a group, mergeable, so coarser groups come from these rows without the facts.
    Relative standard error about 1.04 / sqrt(2 ** lg_k): 1.6 % at 12."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c), lg_k).alias(f"{c}_sketch") for c in cols])


def roll_up_sketches(sketches: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Estimated distinct values per coarser group, from merged sketches (A-9)."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_distinct")
                                       for c in cols])


def distinct_values(c, sep: str | None = None) -> Column:
    """Sorted distinct values with null shown as ``<<NaN>>`` (A-10); joined by
    ``sep`` when given."""
    arr = F.sort_array(F.collect_set(null_sentinel(c)))
    return F.array_join(arr, sep) if sep is not None else arr


def value_counts(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Profile in long form: (key, profile_col, value, n), one row for each distinct
    value of each column under each key (A-10 .. A-13, U-4); nulls show as ``<<NaN>>``.

    One pass, one exchange.  Rows are counted before it, and it deals by value as
    well as key, so the null key's values spread over all tasks.
    """
    return (df.select(null_sentinel(key).alias(key), *[null_sentinel(c).alias(f"_v_{c}") for c in cols])
            .select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("profile_col"), F.col(f"_v_{c}").alias("value"))
                                             for c in cols])).alias("_x"))
            .groupBy(key, F.col("_x.profile_col").alias("profile_col"), F.col("_x.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def listed(counts: DataFrame, key: str, sep: str | None = None, max_list: int = LIST_MAX) -> DataFrame:
    """(key, profile_col, col_values, col_nunique) from the long form.

    A list is built only where it has at most ``max_list`` values; longer ones are
    null (their number is given, and the long form has the values).  Numbers are
    counted before the exchange, so no task sees the values of a large group.
    """
    counts = cut_lineage(counts)
    over = (counts.groupBy(key, "profile_col").agg(F.count(F.lit(1)).alias("col_nunique"))
            .where(F.col("col_nunique") > max_list))
    keys = broadcast_if_small(over.select(key, "profile_col"))
    values = F.sort_array(F.collect_list("value"))
    short = (counts.join(keys, [key, "profile_col"], "left_anti").groupBy(key, "profile_col")
             .agg((F.array_join(values, sep) if sep is not None else values).alias("col_values"),
                  F.count(F.lit(1)).alias("col_nunique")))
    return short.unionByName(over, allowMissingColumns=True)


def profile_by(df: DataFrame, key: str, profile_cols: Sequence[str], other: str,
               sep: str | None = None, max_list: int = LIST_MAX) -> DataFrame:
    """Profile of several columns against a key (A-11, A-12, U-4).

    Output per (profile_col, key): distinct values/count of the profiled column
    and of ``other``; nulls count as ``<<NaN>>`` and a null key is kept.  Lists of
    more than ``max_list`` values are null (``value_counts`` has them all).
    """
    prof = listed(value_counts(df, key, [*profile_cols, other]), key, sep, max_list)
    o = prof.where(F.col("profile_col") == other).select(
        F.col(key).alias("_key"), F.col("col_values").alias(f"{other}_values"), F.col("col_nunique").alias(f"{other}_nunique"))
    v = prof.where(F.col("profile_col") != other)
    return v.join(o, v[key] == o["_key"], "left").drop("_key")


def cardinality(df: DataFrame, key: str, value: str, sep: str | None = None, max_list: int = LIST_MAX) -> DataFrame:
    """Per key (null as ``<<NaN>>``): distinct values of ``value`` and their count
    (A-13); a list of more than ``max_list`` values is null."""
    return listed(value_counts(df, key, [value]), key, sep, max_list).select(
        key, F.col("col_values").alias(f"{value}_values"), F.col("col_nunique").alias(f"{value}_nunique"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once with their group size (A-15)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def max_by_grain(df: DataFrame, keys: Sequence[str], metrics: Sequence[str],
                 dims: Sequence[str], order: Sequence[str] = (),
                 drop_null_keys: bool = True, complete_dims: bool = False) -> DataFrame:
    """Column-wise max of every metric per grain; dims take the first non-null
    value in ``order`` (A-5, A-6).  Null keys are dropped like pandas
    ``groupby`` unless ``drop_null_keys=False``.  ``complete_dims`` says that no
    row lacks a dim: then the first row alone is carried.
    """
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.where(F.col(k).isNotNull())
    aggs = [F.max(m).alias(m) for m in metrics]
    if not order:
        return src.groupBy(*keys).agg(*aggs, *[F.min(d).alias(d) for d in dims]).select(*keys, *dims, *metrics)
    # One value holds all dims of the first complete row; only rows that lack a dim, if any, are
    # ranked for each dim by itself, so the aggregate carries one row of text and not one a dim.
    complete = F.lit(True)
    for d in () if complete_dims else dims:
        complete = complete & F.col(d).isNotNull()
    o = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    aggs.append(F.min(F.when(complete, F.struct(o.alias("o"), *[F.col(d) for d in dims if d not in order]))).alias("_first"))
    for i, d in enumerate(() if complete_dims else dims):
        aggs.append(F.min(F.when(~complete & F.col(d).isNotNull(), F.struct(o.alias("o"), F.col(d).alias("d")))).alias(f"_part{i}"))
    order = list(order)

    def first(i: int, d: str) -> Column:
        value = F.col("_first.o")[f"o{order.index(d)}"] if d in order else F.col(f"_first.{d}")
        if complete_dims:
            return value.alias(d)
        whole = F.when(F.col("_first").isNotNull(), F.struct(F.col("_first.o").alias("o"), value.alias("d")))
        return F.when(F.col(f"_part{i}").isNull(), value).otherwise(F.least(whole, F.col(f"_part{i}"))["d"]).alias(d)
    return src.groupBy(*keys).agg(*aggs).select(*keys, *[first(i, d) for i, d in enumerate(dims)], *metrics)


def high_water_mark(df: DataFrame, col: str = "date"):
    """Scalar max of a column (A-16); one value to the driver."""
    return df.agg(F.max(col)).first()[0]


def reconcile_max(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Latest-known daily values: max of each metric per key (A-17, I-5)."""
    return df.groupBy(*keys).agg(*[F.max(m).alias(m) for m in metrics])


def segment_totals(df: DataFrame, by: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Sum of several columns per segment (A-18, K-6)."""
    return df.groupBy(*by).agg(*[F.sum(src).alias(alias) for alias, src in sums.items()])
