"""The incremental mart as a Structured Streaming job (I-1, I-6 as a stream).

Daily web and leads facts land as parquet files in one folder (a tagged
union: ``source`` = ``web`` | ``leads``).  A file stream picks up new drops;
``foreachBatch`` turns each micro-batch into one incremental refresh of the
mart table:

* the rows of the batch are first stored in the stream's own fact table, in a
  partition (month, batch): a retried batch replaces its own rows;
* the batch recomputes exactly the dates it touched, however old they are, from
  the stored rows of those months (partition pruning), which hold this batch and
  the earlier ones only; rows of files that later batches will bring are not
  seen before;
* the rebuilt dates replace the same dates in the target
  (``plans.incremental.replace_dates``), so a retry gives the same table.

State lives in the fact table, the target table and the stream checkpoint, all
on shared storage; nothing is kept in executor memory across batches, so the
job survives executor and driver restarts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.incremental import on_dates, read_target, replace_dates, write_target
from ..plans.impute import clean_texts
from ..plans.mart import build_mart
from ..session import scratch_path
from ..sources.versions import VersionedTable
from ..sources.schemas import CHANNEL_COLS, LEADS_FUNNEL, WEB_ORDERS

WEB_COLS = [f.name for f in WEB_ORDERS.fields]
LEADS_COLS = [f.name for f in LEADS_FUNNEL.fields]


def landing_schema() -> T.StructType:
    fields = {f.name: f for f in list(WEB_ORDERS.fields) + list(LEADS_FUNNEL.fields)}
    return T.StructType([T.StructField("source", T.StringType())] + list(fields.values()))


def to_landing(web: DataFrame, leads: DataFrame) -> DataFrame:
    """Tag and union both facts into the landing layout."""
    schema = landing_schema()
    w = web.select(F.lit("web").alias("source"), *WEB_COLS)
    l = leads.select(F.lit("leads").alias("source"), *LEADS_COLS)
    u = w.unionByName(l, allowMissingColumns=True)
    return u.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def store_batch(batch: DataFrame, epoch: int, facts_dir: str) -> None:
    """Add the rows of one micro-batch; the same batch again replaces itself."""
    # Dealt by month, so that a month has few files; adaptive execution splits a large one.
    (batch.withColumns({"month": F.trunc("date", "month"), "batch": F.lit(epoch).cast("long")})
     .hint("rebalance", F.col("month"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch").parquet(facts_dir))


def refresh_batch(spark: SparkSession, batch: DataFrame, epoch: int, channels: DataFrame,
                  target_path: str, facts_dir: str) -> None:
    """One micro-batch: store it, then recompute and replace the dates it touched.
    The batch is read once; its dates are those of its stored rows."""
    store_batch(batch, epoch, facts_dir)
    schema = landing_schema().add("month", T.DateType()).add("batch", T.LongType())
    stored = spark.read.schema(schema).parquet(facts_dir)
    own = stored.where(F.col("batch") == epoch)
    dates = [r[0] for r in own.select("date").distinct().collect()]     # one value per day
    if not dates:
        return
    months = {None if d is None else d.replace(day=1) for d in dates}
    stored = on_dates(on_dates(stored, months, "month"), dates)
    stored = stored.where(F.col("batch") <= epoch)
    web = stored.where(F.col("source") == "web").select(*WEB_COLS)
    leads = stored.where(F.col("source") == "leads").select(*LEADS_COLS)
    new = build_mart(web, clean_texts(leads, CHANNEL_COLS), channels, clean_leads=True)
    if VersionedTable(spark, target_path).current() is not None:
        replace_dates(spark, target_path, new, dates)
    else:
        write_target(spark, new, target_path)


def run_mart_stream(spark: SparkSession, landing_dir: str, channels: DataFrame,
                    target_path: str, checkpoint_path: str,
                    max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stream; with ``available_now`` it processes every landed file
    and stops.  Returns the StreamingQuery."""
    facts_dir = f"{target_path.rstrip('/')}_facts"
    reader = spark.readStream.schema(landing_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda b, epoch: refresh_batch(
                  spark, b, epoch, channels, target_path, facts_dir))
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def stream_mart(spark: SparkSession, web: DataFrame, leads: DataFrame, channels: DataFrame,
                n_drops: int = 3, late: bool = False) -> DataFrame:
    """Land the facts as ``n_drops`` drops, run the stream to completion and
    return the resulting mart table.

    Each drop is landed and processed before the next one.  Drops are ranges of
    the date, in order; with ``late`` the newest comes first and a third of the
    campaigns of every range come one drop late.
    """
    base = scratch_path(spark, f"mart_stream_{uuid.uuid4().hex}")
    landing, target = f"{base}/landing", f"{base}/target"
    to_landing(web, leads).write.parquet(f"{base}/rows")
    rows = spark.read.schema(landing_schema()).parquet(f"{base}/rows")
    ends = rows.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    days = (ends.hi - ends.lo).days + 1
    part = F.least(F.floor(F.date_diff("date", F.lit(ends.lo)) * n_drops / days), F.lit(n_drops - 1))
    if late:
        part = (n_drops - 1 - part) + F.when(F.pmod(F.xxhash64("campaign_id"), F.lit(3)) == 0, 1).otherwise(0)
    rows = rows.withColumn("_drop", part.cast("int"))
    for k in range(n_drops + late):
        rows.where(F.col("_drop") == k).drop("_drop").write.mode("append").parquet(landing)
        run_mart_stream(spark, landing, channels, target, f"{base}/checkpoint").awaitTermination()
    return read_target(spark, target)
