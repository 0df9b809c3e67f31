"""Small helpers shared by the operators: reading a table of the data folder,
writing an intermediate table to the shared checkpoint folder, and picking an
unused column name."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Word class of the contracts: everything but blank and U+0009..U+000D.
SPACE_CLASS = "[\\x20\\x09-\\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder (any path that Spark's readers can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OPEN: list[list[str]] = []       # folders written inside each open ``temporary`` block


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared checkpoint folder.

    Every call writes a folder of its own, so a retry never meets old files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """A block whose written tables are removed at its end, but for the folders that
    are taken out of the list it gives.  Nothing may read the others after it."""
    folders: list[str] = []
    _OPEN.append(folders)
    try:
        yield folders
    finally:
        _OPEN.remove(folders)
        for path in folders:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with the columns of ``df``."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_bucket(col: str | Column, n: int) -> Column:
    """crc32 of a number written as text, modulo n (null: bucket of the empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def words(col: str | Column) -> Column:
    """Words of a text, in order (null: none)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE_CLASS + "+"), "")


def word_count(col: str | Column) -> Column:
    return F.size(words(col)).cast("long")
