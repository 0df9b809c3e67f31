"""Set operations (U-1 .. U-5) and column-list helpers (P-10, Q-10)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null (U-1, U-2)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def common_ids(a: DataFrame, b: DataFrame, keys: str | Sequence[str] = "campaign_id"
               ) -> DataFrame:
    """Distinct non-null keys present in both tables (U-3)."""
    keys = [keys] if isinstance(keys, str) else list(keys)

    def nn(df: DataFrame) -> DataFrame:
        out = df.select(*keys)
        for k in keys:
            out = out.where(F.col(k).isNotNull())
        return out

    return nn(a).intersect(nn(b))


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The columns of ``cols`` that exist in ``df``, in the given order (P-10)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from ``df``, sorted (U-5)."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str], what: str = "input") -> DataFrame:
    """Raise ``KeyError`` when required columns are missing (Q-10)."""
    miss = missing_columns(df, required)
    if miss:
        raise KeyError(f"Missing required columns in {what}: {miss}")
    return df


def point_lookup(df: DataFrame, **equals) -> DataFrame:
    """Equality filter, e.g. one campaign on one day (P-11).  Literal values
    reach the parquet scan as pushed filters (and prune date partitions)."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(cond)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all non-null (P-14, ``dropna(subset=...)``)."""
    return df.na.drop(how="any", subset=list(keys))
