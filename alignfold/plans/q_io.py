"""Registered plans: sources and sinks (S1-S12), streams.

Each plan derives its files from a whole given table, writes them below the shared checkpoint
folder and reads them back through the library.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.text import count_hits_sql, hash_unit, hash_unit_sql, strip_sql
from alignfold.operators import metrics as M
from alignfold.operators import prompts as P
from alignfold.operators import rewards as R
from alignfold.operators import splits as S
from alignfold.plans import fixtures as FX
from alignfold.plans.q_filters import KEYWORDS
from alignfold.plans.q_metrics import HEALTH, health_sql
from alignfold.plans.q_prompts import SFTQ_SQL
from alignfold.plans.q_rewards import LEX, SCORED_SQL
from alignfold.plans.registry import query
from alignfold.session import checkpoint_dir
from alignfold.sources import io
from alignfold.streaming import streams as X

SEED = 42


def folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/plans/{name}-{uuid.uuid4().hex}"


# ---------- S1 ----------
TURN_SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                            T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
TURN_KEY_SQL = "(CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR))"


def _turn_lines(spark, sf):
    """JSON lines of all turns, a share of them truncated, wrong-typed, blank or followed by other text."""
    c = FX.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    u = hash_unit(SEED, F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")))
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    odd = F.to_json(F.struct("conv_id", F.concat(F.lit("t"), "turn").alias("turn"), "role", "text"))
    c = c.withColumn("u", u).withColumn("line", line).withColumn("odd", odd)
    return c.select(F.when(F.col("u") < 0.1, F.expr("left(line, length(line) - 2)")).when(F.col("u") < 0.2, F.col("odd"))
                    .when(F.col("u") < 0.25, F.lit("  ")).when(F.col("u") < 0.3, F.concat("line", F.lit(" tail")))
                    .otherwise(F.col("line")).alias("value"))


@query("jsonl_quarantine", f"""WITH t AS (SELECT *, {hash_unit_sql(SEED, TURN_KEY_SQL)} AS u FROM conversations)
    SELECT 'good' AS kind, conv_id, CAST(turn AS BIGINT) AS turn, role, CAST(length(text) AS BIGINT) AS n FROM t WHERE u >= 0.3
    UNION ALL
    SELECT 'bad', NULL, NULL, NULL, count(*) FROM t WHERE u < 0.2 OR (u >= 0.25 AND u < 0.3)""")
def jsonl_quarantine(spark, sf):
    """Good and bad lines of a damaged file together are all its lines that are not blank."""
    path = folder(spark, "jsonl")
    _turn_lines(spark, sf).write.text(path)
    good, bad = io.quarantine(io.read_jsonl(spark, path, TURN_SCHEMA))
    return good.select(F.lit("good").alias("kind"), "conv_id", "turn", "role", F.length("text").cast("long").alias("n")) \
        .unionByName(bad.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("bad").alias("kind"), F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"),
            F.lit(None).cast("string").alias("role"), "n"))


@query("json_dirs", f"""SELECT CASE WHEN {hash_unit_sql(SEED, 'conv_id')} < 0.2 THEN 'validation' ELSE 'train' END AS split,
    CAST(count(*) AS BIGINT) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1""")
def json_dirs(spark, sf):
    """JSON files in nested folders, one split per folder."""
    path = folder(spark, "json-dirs")
    c = FX.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    val = hash_unit(SEED, "conv_id") < 0.2
    io.write_jsonl(c.filter(~val), f"{path}/train/deep/er")
    io.write_jsonl(c.filter(val), f"{path}/val")
    splits = io.read_json_dir(spark, f"{path}/train", TURN_SCHEMA, f"{path}/val")
    out = None
    for name, d in splits.items():
        good, _ = io.quarantine(d)
        part = good.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")) \
            .select(F.lit(name).alias("split"), "n", "chars").filter("n > 0")
        out = part if out is None else out.unionByName(part)
    return out


# ---------- S4 ----------
@query("text_lines", f"""WITH b AS (SELECT text, item_id % 4 AS g, row_number() OVER (PARTITION BY item_id % 4 ORDER BY item_id) - 1 AS k
        FROM benchmark)
    SELECT g, 2 * k AS line_key, {strip_sql("replace(replace(text, chr(13), ' '), chr(10), ' ')")} AS line FROM b
    UNION ALL SELECT g, 2 * k + 1, '' FROM b""")
def text_lines(spark, sf):
    """Stripped lines of four files, blank ones kept; a line's key is its place in its file."""
    path = folder(spark, "lines")
    b = FX.table(spark, sf, "benchmark").select((F.col("item_id") % 4).alias("g"), "item_id", F.regexp_replace("text", "[\\r\\n]", " ").alias("value"))
    b = b.repartition("g").sortWithinPartitions("g", "item_id")
    b.select("g", F.concat(F.lit("  "), "value", F.lit("\t\n "))).write.partitionBy("g").text(path)
    return io.read_lines(spark, path).select(F.regexp_extract("file", r"/g=(\d+)/", 1).cast("long").alias("g"), "line_key", "line")


# ---------- S9 ----------
@query("csv_bom", """SELECT marked, doc_id, lang, n_chars FROM documents, (SELECT unnest([true, false]) AS marked)""")
def csv_bom(spark, sf):
    """CSV files with a byte-order mark before the header and without one read alike."""
    d = FX.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    out = None
    for marked in (True, False):
        path = folder(spark, "csv")
        d.withColumnRenamed("doc_id", "\ufeffdoc_id" if marked else "doc_id").write.option("header", "true").csv(path)
        part = io.read_csv_bom(spark, path, schema=d.schema).withColumn("marked", F.lit(marked))
        out = part if out is None else out.unionByName(part)
    return out.select("marked", "doc_id", "lang", "n_chars")


# ---------- S5 / S11 ----------
@query("named_dataset", "SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def named_dataset(spark, sf):
    """A dataset built when it is absent, then read by its name and split."""
    base = folder(spark, "datasets")
    build = lambda: FX.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    io.ensure_stage(spark, f"{base}/corpus/train", build)
    io.ensure_stage(spark, f"{base}/corpus/train", lambda: build().limit(0))  # there already: not built again
    return io.read_table(spark, "corpus", "train", base_dir=base).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


# ---------- S7 / S10 / P17 ----------
@query("results_roundtrip", f"""SELECT CASE WHEN {hash_unit_sql(SEED, 'doc_id')} < 0.5 THEN doc_id END AS q_id,
    CAST(length(text) AS INTEGER) AS q_len, CAST(n_chars AS VARCHAR) AS "Output" FROM documents""")
def results_roundtrip(spark, sf):
    """Inference results, half of whose inputs are question records, written and read back."""
    d = FX.table(spark, sf, "documents")
    record = F.to_json(F.struct(F.col("doc_id").alias("id"), "source", F.col("text").alias("question")))
    d = d.select("doc_id", F.when(hash_unit(SEED, "doc_id") < 0.5, record).otherwise(F.col("text")).alias("question"),
                 F.col("n_chars").cast("string").alias("answer"))
    path = folder(spark, "results")
    io.write_results(P.to_results(d, "question", "answer"), path)
    good, _ = io.quarantine(io.read_results(spark, path))
    return good.select("q_id", F.length("q_text").cast("int").alias("q_len"), "Output")


# ---------- S8 / S12 / M15 ----------
METRICS = ("view", "click", "purchase", "error", "signup")


@query("metrics_roundtrip", "SELECT run, " + ", ".join(
    f"round(avg(CASE WHEN event_type = '{m}' THEN value END), 6) AS {m}" for m in METRICS) +
    " FROM (SELECT CAST(CAST(floor(epoch(ts)) AS BIGINT) // 3600 % 24 AS VARCHAR) AS run, "
    "event_type, value FROM events) GROUP BY run")
def metrics_roundtrip(spark, sf):
    """Metric files by run (hour of the day), read back and listed one column a metric."""
    from alignfold.functions.text import epoch_seconds

    e = FX.table(spark, sf, "events")
    hour = (F.floor(epoch_seconds(e, "ts") / 3600) % 24).cast("long").cast("string")
    long = e.groupBy(hour.alias("run"), F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    path = folder(spark, "metrics")
    io.write_metrics(long.withColumn("phase", F.lit("train")), path)
    back = io.read_metrics(spark, f"{path}/*/*/part-*")
    wide = M.list_metrics(back, names=METRICS)
    return wide.select("run", *[F.round(m, 6).alias(m) for m in METRICS])


# ---------- P5 / T12 ----------
@query("prompt_records", FX.with_ctes("SELECT question, '' AS answer FROM sftq UNION ALL SELECT question, response_chosen FROM pref",
                                      FX.PREF_SQL, SFTQ_SQL))
def prompt_records(spark, sf):
    """P5: question records without an answer (first user turns) and with one (preference rows)."""
    from alignfold.plans.q_prompts import sft_questions

    pref = FX.pref(spark, sf).withColumnRenamed("response_chosen", "answer")
    return P.to_prompt_records(sft_questions(spark, sf)).unionByName(P.to_prompt_records(pref))


@query("validation_rule", f"""SELECT doc_id, CASE WHEN rn < ceil(n * 0.1) THEN 'validation' ELSE 'train' END AS split FROM (
      SELECT doc_id, row_number() OVER (ORDER BY md5('{SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rn,
             count(*) OVER () AS n FROM documents)""")
def validation_rule(spark, sf):
    """No validation split is given, so a tenth of the training rows becomes one."""
    d = FX.table(spark, sf, "documents").select("doc_id")
    splits = S.ensure_validation({"train": d}, 0.1, SEED, "doc_id")
    out = None
    for name in ("train", "validation"):
        part = splits[name].select("doc_id", F.lit(name).alias("split"))
        out = part if out is None else out.unionByName(part)
    return out


# ---------- X1-X4 ----------
@query("stream_keywords", f"""SELECT doc_id, CAST({count_hits_sql('text', KEYWORDS)} AS INTEGER) AS hits FROM documents
                               WHERE {count_hits_sql('text', KEYWORDS)} >= 3""")
def stream_keywords(spark, sf):
    """JSON lines as they arrive, filtered by keyword hits."""
    path, sink = folder(spark, "stream-in"), folder(spark, "stream-out")
    io.write_jsonl(FX.table(spark, sf, "documents").select("doc_id", "text"), path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    s = X.stream_keyword_filter(spark, path, schema, "text", KEYWORDS, 3)
    X.run_available_now(s.filter(F.col(io.CORRUPT).isNull()).select("doc_id", "hits"), sink)
    X.run_available_now(s.filter(F.col(io.CORRUPT).isNull()).select("doc_id", "hits"), sink)  # a restart adds nothing
    return spark.read.parquet(sink).select("doc_id", F.col("hits").cast("int").alias("hits"))


@query("stream_rewards", FX.with_ctes(
    f"""SELECT prompt_id, gen_id, {R.combined_from_bp_sql('e_bp', 'st_bp', 'sa_bp', 'ln_bp')} AS combined FROM scored""",
    FX.COMPLETIONS_SQL, SCORED_SQL))
def stream_rewards(spark, sf):
    """Rewards of a stream of completions, by the expressions of the batch."""
    path, sink = folder(spark, "stream-in"), folder(spark, "stream-out")
    c = FX.completions(spark, sf)
    c.write.parquet(path)
    s = X.stream_score(spark.readStream.schema(c.schema).parquet(path), LEX)
    X.run_available_now(s.select("prompt_id", "gen_id", "combined"), sink)
    return spark.read.parquet(sink)


@query("stream_dedup", "SELECT DISTINCT text AS question FROM documents WHERE length(text) >= 8")
def stream_dedup(spark, sf):
    """Streaming dedup by content hash within the watermark (all documents have one event time)."""
    path, sink = folder(spark, "stream-in"), folder(spark, "stream-out")
    d = FX.table(spark, sf, "documents").select(F.col("text").alias("question"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts"))
    d.write.parquet(path)
    s = X.stream_prompt_set(spark.readStream.schema(d.schema).parquet(path), "1 hour")
    X.run_available_now(s.select("question"), sink)
    return spark.read.parquet(sink)


@query("stream_dedup_exact", "SELECT DISTINCT text AS question FROM documents WHERE length(text) >= 8")
def stream_dedup_exact(spark, sf):
    """All documents come a second time, a year of event time later and after a restart; each text goes out once."""
    path, sink = folder(spark, "stream-in"), folder(spark, "stream-out")
    d = FX.table(spark, sf, "documents").select(F.col("text").alias("question"))
    for turn in range(2):
        part = d.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000 + turn * 31_536_000)))
        part.write.mode("append").parquet(path)
        X.run_exact_prompt_set(spark.readStream.schema(part.schema).parquet(path).select("question"), sink)
    return spark.read.parquet(sink).select("question")


@query("stream_windows", FX.with_ctes(
    """SELECT run, metric, CAST(epoch(ws) AS BIGINT) AS window_start, round(avg(value), 6) AS mean,
              round(stddev_samp(value), 6) AS sd, CAST(count(*) AS BIGINT) AS n
       FROM (SELECT run, metric, value, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS ws
             FROM metrics_long)
       WHERE ws + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY ALL""", FX.METRICS_LONG_SQL))
def stream_windows(spark, sf):
    """Event-time windows of a stream: exactly those that the watermark has closed."""
    sink = folder(spark, "stream-out")
    e = FX.metrics_long(spark, sf)
    path = folder(spark, "stream-in")
    e.write.parquet(path)
    w = X.stream_metrics(spark.readStream.schema(e.schema).parquet(path), "2 hours", "1 hour", "1 hour")
    X.run_available_now(w, sink)
    return spark.read.parquet(sink).select("run", "metric", "window_start", F.round("mean", 6).alias("mean"),
                                           F.round("sd", 6).alias("sd"), "n")


HEALTH_RULES = {k: v for k, v in HEALTH.items() if k != "bucket"}


@query("stream_health", health_sql("WHERE bucket + 86400 <= epoch((SELECT max(ts) FROM events)) - 3600"))
def stream_health(spark, sf):
    """X4 + M14: all health flags on a stream that is stopped in the middle and gets rows that are too late."""
    e, sink, path = FX.metrics_long(spark, sf), folder(spark, "health-out"), folder(spark, "health-in")
    ends = e.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(ends["a"] + (ends["b"] - ends["a"]) / 2)
    e.filter(F.col("ts") < middle).write.parquet(path)
    for turn in range(2):
        if turn:
            late = e.filter(F.col("ts") < F.lit(ends["a"] + (ends["b"] - ends["a"]) / 4)).withColumn("value", F.lit(1e9))
            e.filter(F.col("ts") >= middle).unionByName(late).write.mode("append").parquet(path)
        X.run_health(X.stream_buckets(spark.readStream.schema(e.schema).parquet(path), HEALTH["bucket"], "1 hour"), sink, **HEALTH_RULES)
    h = spark.read.parquet(sink)
    return h.select("run", "metric", "bucket_ts", F.round("mean", 6).alias("mean"), "n", "kl_flag", "loss_flag", "reward_flag")
