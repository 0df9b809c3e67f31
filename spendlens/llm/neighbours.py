"""Every row together with its successor in id order, with one shuffle of the rows.

The rows are dealt into ranges of the id whose first ids are known; the first
row of a range travels twice, once to its own range and once to the range
before it.  So each range holds all successors it needs, and no row ever has to
look into another task.  Only the range starts (one id per range) reach the
driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import fresh, shuffle_partitions


def id_ranges(df: DataFrame, id_col: str, n: int) -> list[int]:
    """First ids of at most ``n`` ranges with about equally many rows."""
    qs = [i / n for i in range(1, n)] or [0.5]
    row = df.agg(F.min(id_col).alias("lo"),
                 F.percentile_approx(id_col, qs, 10 * n + 100).alias("cuts")).first()
    if row.lo is None:
        return []
    return sorted({row.lo, *(row.cuts or [])})


def with_range_copies(df: DataFrame, id_col: str, per_partition: int = 4) -> tuple[DataFrame, str, str]:
    """Rows of ``df`` dealt and sorted by id range.

    Returns (rows, range column, copy column).  Within a range the rows come in
    ascending id (null ids first, equal ids by the hash of the whole row); the
    rows with copy = 1 follow at the end and are the first rows of the next
    range (of the first range for the last one).  They are successors only.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark) * per_partition
    starts = id_ranges(df.where(F.col(id_col).isNotNull()), id_col, n)
    rng, cpy, tie, got = fresh(df, "range", "copy", "tie", "dealt")
    # Null ids sort before all others: they belong to the first range and,
    # where there are any, one of them (not the smallest id) is the first row.
    null_first = df.where(F.col(id_col).isNull()).limit(1).count() > 0
    # Twice the range of an id, plus one where the id starts a range after the first.
    later = np.array(starts[1:], np.int64)

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        v = ids.to_numpy(np.int64)
        k = np.searchsorted(later, v, "right")
        return pd.Series(2 * k + ((k > 0) & (later[k - 1] == v) if len(later) else 0))

    at, = fresh(df, "place")
    lowest = starts[0] if starts else 0
    df_at = df.withColumn(at, place(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest - 1))))
    own = F.floor(F.col(at) / 2).cast("int")
    first = F.col(id_col).isNull() if null_first else F.col(id_col) == F.lit(lowest)
    last = F.lit(max(0, len(starts) - 1)).cast("int")
    here = F.struct(own.alias("r"), F.lit(0).alias("c"))
    wrap = F.struct(last.alias("r"), F.lit(1).alias("c"))
    before = F.struct((own - 1).cast("int").alias("r"), F.lit(1).alias("c"))
    deal = F.when(F.coalesce(first, F.lit(False)), F.array(here, wrap)).when(F.col(at) % 2 == 1, F.array(here, before))
    deal = deal.otherwise(F.array(here))
    rows = (df_at.withColumn(got, F.explode(deal))
            .withColumn(rng, F.col(got)["r"]).withColumn(cpy, F.col(got)["c"]).drop(got, at)
            .withColumn(tie, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
            .repartition(shuffle_partitions(spark), F.col(rng))
            .sortWithinPartitions(rng, cpy, F.col(id_col).asc_nulls_first(), tie))
    return rows.drop(tie), rng, cpy
