"""Data-quality checks (Q-1 .. Q-16, W-4).

Each check returns a DataFrame of violations (empty = pass) or a small summary
DataFrame; nothing is collected unless an ``assert_*`` helper is called.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import SourceSpec
from .aggregates import duplicate_groups
from .joins import missing_in_dim

REPORT_SCHEMA = "check string, table_name string, column_name string, n_violations bigint, status string"


def check_freshness(df: DataFrame, now, ts: str = "_etl_loaded_at", warn_after_hours: int = 12,
                    error_after_hours: int = 24, table: str = "") -> DataFrame:
    """Age of the newest load against warn/error limits (Q-1).

    ``now`` is injected (a datetime or Column) so the check is reproducible.
    One row: table_name, max_loaded_at, age_hours, status (pass/warn/error).
    """
    now_c = F.lit(now) if isinstance(now, (_dt.datetime, _dt.date, str)) else now
    newest = F.max(F.col(ts).cast("timestamp_ntz"))
    age = (F.unix_timestamp(now_c.cast("timestamp_ntz").cast("timestamp"))
           - F.unix_timestamp(newest.cast("timestamp"))) / 3600.0
    return (df.agg(newest.alias("max_loaded_at"), age.alias("age_hours"))
            .select(F.lit(table).alias("table_name"), "max_loaded_at", "age_hours",
                    F.when(F.col("max_loaded_at").isNull(), "error")
                    .when(F.col("age_hours") >= error_after_hours, "error")
                    .when(F.col("age_hours") >= warn_after_hours, "warn")
                    .otherwise("pass").alias("status")))


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where any of ``cols`` is null, tagged with the failing columns (Q-2)."""
    failing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return (df.withColumn("failed_columns", F.array_join(failing, ","))
            .where(F.col("failed_columns") != ""))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null count of every column in one pass (Q-11): (column_name, n_null)."""
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                    for c in cols])
    return wide.unpivot([], list(cols), "column_name", "n_null")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once with their count (Q-3, A-15)."""
    return duplicate_groups(df, keys)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats (W-4, Q-8)."""
    if not check_unique(df, keys).isEmpty():
        raise AssertionError(f"Duplicates found on {list(keys)}!")


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose non-null ``col`` is outside the accepted values (Q-4)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def check_referential(fact: DataFrame, dim: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Fact rows whose key is missing from the dimension (Q-5)."""
    return missing_in_dim(fact, dim, key)


def check_predicate(df: DataFrame, name: str, ok: Column) -> DataFrame:
    """Rows violating a business assertion, e.g. ``spend >= 0`` (Q-6).
    A null outcome is not a violation (SQL test semantics)."""
    return df.where(~ok).withColumn("check", F.lit(name))


def check_monotonic(df: DataFrame, steps: Sequence[str]) -> DataFrame:
    """Rows where a funnel step exceeds the step before it (Q-7).

    Adds ``broken_steps`` ("a>b" pairs); null steps are not compared.
    """
    pairs = list(zip(steps, steps[1:]))
    bad = F.array_compact(F.array(*[F.when(F.col(b) > F.col(a), F.lit(f"{b}>{a}"))
                                    for a, b in pairs]))
    return (df.withColumn("broken_steps", F.array_join(bad, ","))
            .where(F.col("broken_steps") != ""))


def check_broken_funnel(df: DataFrame, first: str, middle: Sequence[str], last: str | None = None
                        ) -> DataFrame:
    """Rows where a middle step is missing while the first (or last) step has
    volume (Q-12)."""
    has_volume = F.coalesce(F.col(first), F.lit(0)) > 0
    if last:
        has_volume = has_volume | (F.coalesce(F.col(last), F.lit(0)) > 0)
    missing = reduce(lambda a, b: a | b, [F.col(m).isNull() for m in middle])
    return df.where(has_volume & missing)


def check_alignment(df: DataFrame, spend: str, metrics: Sequence[str]) -> DataFrame:
    """Rows where spend and behaviour are not present together (Q-13): spend
    without any metric, or metrics without spend."""
    has_spend = F.coalesce(F.col(spend), F.lit(0)) != 0
    has_metric = reduce(lambda a, b: a | b,
                        [F.coalesce(F.col(m), F.lit(0)) != 0 for m in metrics])
    return (df.where(has_spend != has_metric)
            .withColumn("misalignment", F.when(has_spend, "spend_without_metrics")
                        .otherwise("metrics_without_spend")))


def flag_outliers(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Rows where any metric reaches its threshold (Q-9), with the metrics hit."""
    hit = F.array_compact(F.array(*[F.when(F.col(c) >= F.lit(t), F.lit(c))
                                    for c, t in thresholds.items()]))
    return df.withColumn("outlier_metrics", F.array_join(hit, ",")).where(
        F.col("outlier_metrics") != "")


def check_bijection(*frames: DataFrame, id_col: str = "campaign_id",
                    name_col: str = "campaign_name") -> DataFrame:
    """Id->name and name->id pairs that are not one-to-one over all given tables
    together (Q-14); tables without both columns are passed over.

    Output: direction, key, n_partners over distinct non-null pairs.
    """
    parts = [f.select(id_col, name_col) for f in frames if {id_col, name_col} <= set(f.columns)]
    pairs = reduce(lambda a, b: a.unionByName(b), parts).where(
        F.col(id_col).isNotNull() & F.col(name_col).isNotNull()).distinct()
    by_id = (pairs.groupBy(F.col(id_col).alias("key")).agg(F.count(F.lit(1)).alias("n_partners"))
             .where("n_partners > 1").withColumn("direction", F.lit("id_to_name")))
    by_name = (pairs.groupBy(F.col(name_col).alias("key"))
               .agg(F.count(F.lit(1)).alias("n_partners"))
               .where("n_partners > 1").withColumn("direction", F.lit("name_to_id")))
    return by_id.unionByName(by_name).select("direction", "key", "n_partners")


def schema_gaps(df: DataFrame, expected: T.StructType) -> list[tuple[str, str]]:
    """(column, problem) for every difference between a table schema and its
    declared one (Q-15); both kinds of timestamp count as one type."""
    def kind(t: T.DataType) -> str:
        return t.simpleString().replace("timestamp_ntz", "timestamp")
    have = {f.name: kind(f.dataType) for f in df.schema.fields}
    return [(f.name, f"missing column {f.name}" if f.name not in have else
             f"column {f.name}: {have[f.name]} != {kind(f.dataType)}")
            for f in expected.fields if have.get(f.name) != kind(f.dataType)]


def check_schema(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences between a table schema and its declared schema (Q-15)."""
    return [problem for _, problem in schema_gaps(df, expected)]


def apply_row_filters(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Keep rows passing every named condition (Q-16)."""
    return reduce(lambda d, c: d.where(c), conditions.values(), df)


def _schema_rows(df: DataFrame, s: SourceSpec) -> list[DataFrame]:
    """One ``schema`` error row per differing column (no Spark job)."""
    gaps = [("schema", s.name, column, 1, "error") for column, _ in schema_gaps(df, s.schema)]
    return [df.sparkSession.createDataFrame(gaps, REPORT_SCHEMA)] if gaps else []


def _table_profile(df: DataFrame, s: SourceSpec, now) -> DataFrame:
    """Freshness and not-null counts of one source in a single aggregate."""
    now_c = F.lit(now).cast("timestamp_ntz").cast("timestamp")
    aggs = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"_nn_{c}")
            for c in s.not_null]
    fresh = s.loaded_at in df.columns
    if fresh:
        aggs.append(F.max(F.col(s.loaded_at).cast("timestamp_ntz")).alias("_newest"))
    one = df.agg(*aggs) if aggs else df.sparkSession.range(1).select(F.lit(0).alias("_x"))
    rows = []
    if fresh:
        age = (F.unix_timestamp(now_c) - F.unix_timestamp(F.col("_newest").cast("timestamp"))
               ) / 3600.0
        status = (F.when(F.col("_newest").isNull(), "error")
                  .when(age >= s.error_after_hours, "error")
                  .when(age >= s.warn_after_hours, "warn").otherwise("pass"))
        rows.append(F.struct(F.lit("freshness").alias("check"), F.lit(s.loaded_at).alias("column_name"),
                             F.lit(0).cast("bigint").alias("n_violations"), status.alias("status")))
    for c in s.not_null:
        n = F.col(f"_nn_{c}")
        rows.append(F.struct(F.lit("not_null").alias("check"), F.lit(c).alias("column_name"),
                             n.alias("n_violations"),
                             F.when(n > 0, "error").otherwise("pass").alias("status")))
    out = one.select(F.explode(F.array(*rows)).alias("r")).select(
        F.col("r.check"), F.lit(s.name).alias("table_name"), F.col("r.column_name"),
        F.col("r.n_violations"), F.col("r.status"))
    return out if rows else out.limit(0)


def source_report(tables: Mapping[str, DataFrame], specs: Sequence[SourceSpec], now
                  ) -> DataFrame:
    """One report over all sources: schema, accepted values (a warning),
    freshness, not_null and unique per column.

    Columns: check, table_name, column_name, n_violations, status.  Freshness
    and not-null counts of a table come from one aggregate (one scan); each
    unique test is one partial-aggregated group-by.  A source without its
    load-time column gets its ``schema`` error row instead of a freshness row.
    """
    parts = []
    for s in specs:
        if s.name not in tables:
            continue
        df = tables[s.name]
        parts += _schema_rows(df, s)
        for c, values in s.accepted_values.items():
            bad = check_accepted(df, c, values).agg(F.count(F.lit(1)).alias("n"))
            parts.append(bad.select(F.lit("accepted").alias("check"), F.lit(s.name).alias("table_name"),
                                    F.lit(c).alias("column_name"), F.col("n").alias("n_violations"),
                                    F.when(F.col("n") > 0, "warn").otherwise("pass").alias("status")))
        if s.not_null or s.loaded_at in df.columns:
            parts.append(_table_profile(df, s, now))
        for u in s.unique:
            dup = check_unique(df, [u]).agg(F.count(F.lit(1)).alias("n"))
            parts.append(dup.select(F.lit("unique").alias("check"),
                                    F.lit(s.name).alias("table_name"),
                                    F.lit(u).alias("column_name"),
                                    F.col("n").alias("n_violations"),
                                    F.when(F.col("n") > 0, "error").otherwise("pass")
                                    .alias("status")))
    return reduce(lambda a, b: a.unionByName(b), parts)
