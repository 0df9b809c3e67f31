"""Readers and writers (S-1 .. S-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; projection/filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


CORRUPT = "_corrupt_record"


class CorruptRows(ValueError):
    """Rows of a CSV file that do not fit its header."""


def read_source(spark: SparkSession, path: str, schema: T.StructType | None = None,
                fmt: str | None = None, sep: str = ",", multi_line: bool = False,
                corrupt: str = "fail") -> DataFrame:
    """Read a source with a declared schema.

    CSV: columns are taken by their header name (any order, any case, further
    columns ignored), ids stay strings, CRLF tolerated, quotes doubled inside
    quoted fields; ``multi_line`` for fields with line ends.  A declared column
    that the header lacks is an error.  ``corrupt`` says what happens to rows
    with too many or too few fields: ``fail`` raises with their number,
    ``keep`` returns them with the raw line in ``_corrupt_record``, ``drop``
    leaves them out.  Parquet/ORC/JSON: declared schema when given, else the
    file schema.
    """
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    if fmt != "csv":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.format(fmt).load(path)
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multi_line,
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    header = spark.read.options(**options).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(text).options(**options, mode="PERMISSIVE", enforceSchema=False,
                                            columnNameOfCorruptRecord=CORRUPT).csv(path))
    if schema is None:
        schema = T.StructType(text.fields[:-1])
    by_name = {c.strip().lower(): c for c in header}
    lacking = [f.name for f in schema.fields if f.name.lower() not in by_name]
    if lacking:
        raise ValueError(f"{path}: the header has no column {', '.join(lacking)}")
    # Always true, and a use of every column: the raw line can only be read
    # together with parsed ones.
    rows = rows.where(F.concat_ws("", *[F.col(f"`{c}`") for c in header]) >= "")
    if corrupt == "fail":
        n = rows.where(F.col(CORRUPT).isNotNull()).count()
        if n:
            raise CorruptRows(f"{path}: {n} rows do not fit the header")
    elif corrupt == "drop":
        rows = rows.where(F.col(CORRUPT).isNull())
    elif corrupt != "keep":
        raise ValueError(f"unknown corrupt mode {corrupt!r}")
    cols = [F.col(f"`{by_name[f.name.lower()]}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*cols, *([CORRUPT] if corrupt == "keep" else []))


def normalize_headers(df: DataFrame) -> DataFrame:
    """Strip and lower-case every column name (P-8)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", compression: str | None = None) -> None:
    """Headered CSV, one folder of part files (S-5 with ``sep=';'``, S-6 with ``','``).
    Values are written as they are: blanks kept, quotes doubled.  ``compression``
    (``gzip`` …) names the codec of the part files, which readers know by their ending."""
    (df.write.mode(mode).options(header=True, sep=sep, quote='"', escape='"',
                                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
     .csv(path, compression=compression))


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
