"""Token counts as delta-maintained rollups.

A change of a document is an insert (no old count), a delete (no new count) or
a revision (both).  ``deltas`` turns changes into signed rows: the new count is
added to its group, the old count is taken from its group, so a revision may
also move a document to another source, language or tokenizer version.

``TokenLedger`` keeps the deltas of every batch, summed by (source, lang,
tokenizer), as one partition of a table.  A commit replaces exactly the
partition of its batch, so a batch that is committed again after a failure
counts once; batches may arrive in any order.  The totals are the sums over all
committed batches; ``compact`` folds old batches into one partition, number -1,
and keeps the highest number folded as a watermark in that partition's mark row.  A
batch at or below the watermark is closed: committing it again changes nothing.

Groups are summed before the shuffle, so a source with a third of all rows
costs a row per task.

Defined results: a null source or language is a group of its own; null counts
are zero tokens of one document; repeated rows count each time (the batch
identity, not the row, makes a commit idempotent); an empty batch clears its
partition; a group whose sums are all zero leaves the totals.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import read, word_count, written

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long, batch_id long"


def deltas(changes: DataFrame) -> DataFrame:
    """Signed rows (source, lang, tokenizer, docs, tokens) of changes with the
    nullable struct columns ``old`` and ``new`` (source, lang, tokenizer, tokens)."""
    def side(name: str, sign: int) -> Column:
        c = F.col(name)
        return F.when(c.isNotNull(), F.struct(
            c["source"].alias("source"), c["lang"].alias("lang"), c["tokenizer"].alias("tokenizer"),
            F.lit(sign).cast("long").alias("docs"),
            (F.coalesce(c["tokens"], F.lit(0)) * sign).cast("long").alias("tokens")))
    both = F.array_compact(F.array(side("new", 1), side("old", -1)))
    return changes.select(F.explode(both).alias("d")).select("d.*")


class TokenLedger:
    """Committed batches of signed counts below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch_id: int, signed: DataFrame) -> bool:
        """Write the sums of a batch; the same batch again replaces itself.

        A batch that ``compact`` has folded is left as it is; the result says
        whether the batch was written.  Negative numbers are reserved."""
        if batch_id < 0:
            raise ValueError("batch numbers start at 0")
        if batch_id <= self.watermark():
            return False
        sums = (signed.select("source", "lang", F.coalesce("tokenizer", F.lit("")).alias("tokenizer"), "docs", "tokens")
                .groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")))
        self._replace(sums.unionByName(self._mark(0)).withColumn("batch_id", F.lit(batch_id).cast("long")))
        return True

    def _mark(self, value: int) -> DataFrame:
        """A row without a tokenizer marks a batch, so that an empty batch has a partition too."""
        return self.spark.range(1).select(*[F.lit(None).cast("string").alias(k) for k in KEYS],
                                          F.lit(0).cast("long").alias("docs"), F.lit(value).cast("long").alias("tokens"))

    def watermark(self) -> int:
        """Highest batch number that was compacted (-1: none); reads one small partition."""
        try:
            marks = self.batches().where((F.col("batch_id") == -1) & F.col("tokenizer").isNull())
            found = marks.agg(F.max("tokens")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            found = None
        return -1 if found is None else found

    def _replace(self, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.path))

    def batches(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all committed batches."""
        return (self.batches().where(F.col("tokenizer").isNotNull())
                .groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where((F.col("docs") != 0) | (F.col("tokens") != 0)))

    def compact(self, path: str, upto: int) -> "TokenLedger":
        """A new ledger in which the batches up to ``upto`` are one batch, -1.

        It is written to a folder of its own, so readers of the old one are not
        disturbed; batches after ``upto`` keep their identity and may still be
        committed again, earlier ones are closed."""
        closed = max(upto, self.watermark())
        at = F.when(F.col("batch_id") <= closed, F.lit(-1).cast("long")).otherwise(F.col("batch_id"))
        rows = (self.batches().withColumn("batch_id", at).where((F.col("batch_id") >= 0) | F.col("tokenizer").isNotNull())
                .groupBy(*KEYS, "batch_id").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")))
        out = TokenLedger(self.spark, path)
        out._replace(rows.unionByName(self._mark(closed).withColumn("batch_id", F.lit(-1).cast("long"))))
        return out


#: Tokenizer versions that Spark functions count: words, and UTF-8 bytes.
def _counts(text: Column) -> list[tuple[str, Column]]:
    text = F.coalesce(text, F.lit(""))
    return [("words-v1", word_count(text)), ("bytes-v1", F.octet_length(text).cast("long"))]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: every document is
    inserted; documents of several lines are revised without their last line;
    documents with fewer than 50 words left are deleted.  The second batch is
    committed twice, as after a lost acknowledgement."""
    docs = read(spark, sf_dir, "documents").select("text", "source", "lang")
    shorter = F.regexp_replace("text", "\\n[^\\n]*\\z", "")
    was, now = dict(_counts(F.col("text"))), dict(_counts(shorter))
    versions = F.array(*[F.struct(F.lit(v).alias("tokenizer"), was[v].alias("was"), now[v].alias("now")) for v in was])
    many = F.coalesce(F.contains("text", F.lit("\n")), F.lit(False))
    counts = written(docs.select("source", "lang", many.alias("revised"), now["words-v1"].alias("words_left"),
                                 versions.alias("versions")), "token-counts")
    rows = counts.select("source", "lang", "revised", "words_left", F.explode("versions").alias("v"))

    def count(col: str) -> Column:
        return F.struct("source", "lang", F.col("v.tokenizer").alias("tokenizer"), F.col(f"v.{col}").alias("tokens"))

    none = F.lit(None).cast("struct<source:string,lang:string,tokenizer:string,tokens:bigint>")
    insert = rows.select(none.alias("old"), count("was").alias("new"))
    revise = rows.where("revised").select(count("was").alias("old"), count("now").alias("new"))
    delete = rows.where("words_left < 50").select(count("now").alias("old"), none.alias("new"))
    ledger = TokenLedger(spark, scratch_path(spark, f"token-ledger-{uuid.uuid4().hex}"))
    for batch, changes in ((1, insert), (2, revise), (3, delete), (2, revise)):
        ledger.commit(batch, deltas(changes))
    return ledger.totals()


SQL = r"""
WITH left_over AS (
  SELECT source, lang, regexp_replace(coalesce(text, ''), '\n[^\n]*\z', '') AS text FROM documents),
counted AS (
  SELECT source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, strlen(text) AS bytes FROM left_over),
versions AS (
  SELECT source, lang, 'words-v1' AS tokenizer, words AS tokens FROM counted WHERE words >= 50
  UNION ALL SELECT source, lang, 'bytes-v1', bytes FROM counted WHERE words >= 50)
SELECT source, lang, tokenizer, count(*)::BIGINT AS docs, sum(tokens)::BIGINT AS tokens
FROM versions GROUP BY source, lang, tokenizer
"""
