"""Training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes to the shared checkpoint folder as Parquet and reads again as the next
stage's documents.  All stages but the last return the columns of the documents;
the last adds the piece ids, their parity and their number.  Rows with null or empty text are
ordinary rows of every stage (the quality rules reject them); an empty table
passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import hostrules, pu, raking, simhash, spm, tables


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier predicts as good."""
    return pu.keep_good(docs, tables.read(spark, sf_dir, "labels").select("doc_id", "quality"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return hostrules.apply_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.deduplicate(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their raked probabilities."""
    return raking.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, whether both libraries agree on them, and the number of ids."""
    out = spm.encode(docs)
    ids = out.columns[-2]
    n, = tables.fresh(out, "n_pieces")
    return out.withColumn(n, F.size(ids).cast("long"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: The classifier is trained, so SQL cannot state the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order.  When a stage's table is written, what it worked with (its
    own tables and the table before) is removed; the last stage's table stays."""
    docs, before = tables.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with tables.temporary(spark) as folders:
            docs = tables.written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
            own = folders.pop()
        if before:
            tables.remove(spark, before)
        before = own
    return docs
