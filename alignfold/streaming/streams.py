"""Structured Streaming forms of ingest, scoring, dedup and monitoring.

The batch operators are pure Column expressions, so the same code runs on a
stream. State exists only where it must: dedup (bounded by the watermark) and
event-time window aggregates (finalised and evicted by the watermark, append mode).
"""

from __future__ import annotations

import hashlib
import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.lexicon import Lexicon
from alignfold.functions.rows import keep_rows
from alignfold.functions.text import as_instant, content_hash, count_hits
from alignfold.operators import metrics as M
from alignfold.operators import rewards as R
from alignfold.session import checkpoint_dir, cut_lineage
from alignfold.sources import io


# ---------- X1 ----------
def stream_keyword_filter(spark: SparkSession, path: str, schema: T.StructType, col: str, terms: Sequence[str],
                          min_hits: int = 1, max_files_per_trigger: int = 64) -> DataFrame:
    """Incremental corpus ingest (JSONL files as they arrive) + keyword filter; stateless.

    Malformed lines are not lost: they pass with their text in ``_corrupt_record`` (null on the
    records that hit), so the sink can route them.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    s = io.parse_lines(lines, schema).withColumn("hits", count_hits(col, terms))
    return keep_rows(s, (F.col("hits") >= min_hits) | F.col(io.CORRUPT).isNotNull())


def stream_checkpoint(spark: SparkSession, sink: str) -> str:
    """The checkpoint of the stream into ``sink``: the same at every start, so a restart goes on where
    the last run ended. It lies in the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", hashlib.sha256(sink.encode()).hexdigest()[:32])


# ---------- X2 ----------
def stream_score(df: DataFrame, lex: Lexicon, content: str = "content") -> DataFrame:
    """Reward columns on a stream of new completions (same expressions as batch ``score``)."""
    return R.score(df, lex, content)


# ---------- X3 ----------
def stream_prompt_set(df: DataFrame, watermark: str, ts: str = "ts", col: str = "question",
                      min_len: int = 8) -> DataFrame:
    """Streaming prompt dedup on a content hash; state is bounded by the watermark, so an exact
    copy arriving later than the watermark may pass again."""
    df = df.withColumn(ts, as_instant(df, ts))
    return (df.filter(F.length(col) >= min_len).withColumn("question_hash", content_hash(col))
            .withWatermark(ts, watermark).dropDuplicatesWithinWatermark(["question_hash"]))


def exact_batch(batch: DataFrame, batch_id: int, sink: str, seen: str, col: str, min_len: int = 8, buckets: int = 64) -> None:
    """The prompts of a micro-batch that no batch before it had, into ``sink``/batch_id=...

    ``seen`` holds the content hashes of all prompts that went out, by hash bucket and batch. A batch reads
    the hashes of earlier batches, of its own buckets only, and writes its own anew each time it runs.
    """
    spark = batch.sparkSession
    hashed = batch.filter(F.length(col) >= min_len).withColumn("_hash", content_hash(col)).dropDuplicates(["_hash"])
    hashed = hashed.withColumn("_bucket", F.pmod(F.xxhash64("_hash"), F.lit(buckets)).cast("int"))
    new = cut_lineage(hashed)
    if batch_id > 0 and io.exists(spark, seen):
        known = spark.read.schema("_hash string, batch_id long, _bucket int").parquet(seen).filter(F.col("batch_id") < batch_id)
        new = new.join(known.select("_bucket", "_hash"), ["_bucket", "_hash"], "left_anti")
    new.drop("_hash", "_bucket").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    new.select("_hash", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{seen}/batch_id={batch_id}")


def run_exact_prompt_set(stream: DataFrame, sink: str, col: str = "question", min_len: int = 8) -> str:
    """X3 without a watermark: each content once, however late its copies come. The hashes of what went out lie
    in the shared folder, not in the state of the stream. Processes what is available; a later call goes on."""
    spark = stream.sparkSession
    checkpoint = stream_checkpoint(spark, sink)
    q = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, batch_id: exact_batch(batch, batch_id, sink, checkpoint + "-seen", col, min_len))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


# ---------- X4 ----------
def stream_metrics(df: DataFrame, window: str, slide: str | None, watermark: str, ts: str = "ts") -> DataFrame:
    """Mean / std / count per run and metric in event-time windows; late rows dropped by the watermark."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    # event time must be an instant (TIMESTAMP_NTZ is read as UTC, as in the batch twin)
    df = df.withColumn(ts, as_instant(df, ts))
    return (df.withWatermark(ts, watermark).groupBy("run", "metric", w.alias("w"))
            .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.count(F.lit(1)).alias("n"))
            .select("run", "metric", F.unix_timestamp("w.start").alias("window_start"), "mean", "sd", "n"))


def kl_alerts(batch: DataFrame, kl_metric: str, explode: float = 1.0, high: float = 0.5, low: float = 0.1) -> DataFrame:
    """M14's KL rule on finalised window means (used inside ``foreachBatch``: no row frames on streams)."""
    m = F.col("mean")
    flag = F.when(m > explode, "explosion").when(m >= high, "high").when(m < low, "conservative").otherwise("ok")
    return batch.filter(F.col("metric") == kl_metric).withColumn("kl_flag", flag)


def stream_kl_alerts(windows: DataFrame, sink: str, kl_metric: str, explode: float = 1.0, high: float = 0.5,
                     low: float = 0.1, checkpoint: str | None = None, available_now: bool = True):
    """X4 + M14: KL flags on each micro-batch of finalised window means, in ``sink`` (Parquet).

    Each batch replaces its own folder ``batch_id=...``: a batch that is run again after a failure
    leaves one copy."""
    ck = checkpoint or stream_checkpoint(windows.sparkSession, sink)

    def write(batch: DataFrame, batch_id: int) -> None:
        kl_alerts(batch, kl_metric, explode, high, low).filter(F.col("kl_flag") != "ok") \
            .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = windows.writeStream.outputMode("append").option("checkpointLocation", ck).foreachBatch(write)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


# ---------- X4 with M14's other rules ----------
BUCKETS = "run string, metric string, bucket long, mean double, n_nan long, n long"


def stream_buckets(df: DataFrame, bucket: str, watermark: str, ts: str = "ts") -> DataFrame:
    """The buckets of ``metrics.training_health`` on a stream: each comes once, when the watermark has closed it."""
    size = M.BUCKET_SECONDS[bucket]
    df = df.withColumn(ts, as_instant(df, ts))
    b = df.withWatermark(ts, watermark).groupBy("run", "metric", F.window(ts, f"{size} seconds").alias("w")).agg(*M.bucket_facts())
    return b.select("run", "metric", F.unix_timestamp("w.start").alias("bucket"), "mean", "n_nan", "n")


def health_state(spark: SparkSession, sink: str) -> str:
    """The folder of the buckets that ``run_health`` still has to look back at."""
    return stream_checkpoint(spark, sink) + "-health"


def health_batch(batch: DataFrame, batch_id: int, sink: str, state: str, **rules) -> None:
    """Flags of one micro-batch of closed buckets, into ``sink``/batch_id=..., and the state after it.

    A batch looks back at the state that the batch before it left: the last ``window`` buckets of each
    run and metric. It writes its own and its own flags anew each time it runs, so a batch that is
    run again after a failure changes nothing, and the state does not grow with the history.
    """
    spark, window = batch.sparkSession, rules.get("window", 3)
    batch = batch.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in BUCKETS.split(", ")])
    known = batch.withColumn("_new", F.lit(True))
    if io.exists(spark, f"{state}/batch_id={batch_id - 1}"):
        old = spark.read.schema(BUCKETS).parquet(f"{state}/batch_id={batch_id - 1}")
        known = known.unionByName(old.withColumn("_new", F.lit(False)))
    held = cut_lineage(known)
    new = held.filter("_new").select("run", "metric", F.col("bucket").alias("bucket_ts"))
    M.health_flags(held.drop("_new"), **rules).join(new, ["run", "metric", "bucket_ts"], "left_semi") \
        .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    last = Window.partitionBy("run", "metric").orderBy(F.desc("bucket"))
    held.withColumn("_k", F.row_number().over(last)).filter(F.col("_k") <= window).drop("_k", "_new") \
        .write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
    io.delete(spark, f"{state}/batch_id={batch_id - 2}")  # this batch may run again; the one before it not


def run_health(buckets: DataFrame, sink: str, **rules) -> str:
    """X4 + M14: KL, loss and reward flags of every closed bucket of a stream, as ``metrics.training_health`` gives
    them, in ``sink`` (Parquet). Processes what is available; a later call goes on from there."""
    spark = buckets.sparkSession
    state = health_state(spark, sink)
    q = (buckets.writeStream.outputMode("append").option("checkpointLocation", stream_checkpoint(spark, sink))
         .foreachBatch(lambda batch, batch_id: health_batch(batch, batch_id, sink, state, **rules))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sink


def run_available_now(stream: DataFrame, sink: str, fmt: str = "parquet", output_mode: str = "append",
                      checkpoint: str | None = None) -> str:
    """Process everything available now, then stop. A second run into the same sink goes on from there."""
    ck = checkpoint or stream_checkpoint(stream.sparkSession, sink)
    q = (stream.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", ck)
         .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return sink
