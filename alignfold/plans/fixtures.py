"""Operator inputs derived from the driver's tables, in Spark and as SQL CTEs for the DuckDB oracle.

Every derivation reads whole tables (no id subsets or row caps): the work grows with the data.

| input            | derived from                                                                |
| sft (D1)         | conversations grouped by conv_id, ordered by turn; user->human, assistant->gpt |
| pref (D3)        | user turn t; chosen = assistant turn t+1; rejected = assistant turn t+1 of conv_id+1 |
| completions (D12)| assistant turns; prompt_id = conv_id, gen_id = turn                        |
| docs_scored      | documents joined with labels (model = source, accuracy = quality, cot = 1 - toxic) |
| metrics_long     | events: run = user_id, metric = event_type, ts, value                      |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alignfold.functions.lexicon import load_lexicon

SYNTHETIC_LEXICON = "synthetic"


_SHARED: dict = {}


def shared(fn):
    """Reuse one lazy DataFrame per (session, table dir) for sub-plans several plans start from.

    Only the plan object is shared (nothing is cached or collected); it saves rebuilding the
    same expression trees on the driver for every plan.
    """
    def wrapper(spark, sf_dir, *args):
        key = (fn.__module__, fn.__qualname__, spark.sparkContext.applicationId, id(spark), sf_dir, args)
        if key not in _SHARED:
            _SHARED[key] = fn(spark, sf_dir, *args)
        return _SHARED[key]
    wrapper.__name__, wrapper.__doc__, wrapper.__wrapped__ = fn.__name__, fn.__doc__, fn
    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon():
    return load_lexicon(SYNTHETIC_LEXICON)


# ---------- sft ----------
def _role():
    return F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))


@shared
def sft(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    t = c.select("conv_id", F.struct(F.col("turn"), _role().alias("from"), F.col("text").alias("value")).alias("t"))
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("_ts"))
    convs = F.transform("_ts", lambda x: F.struct(
        x["from"].alias("from"), x["value"].alias("value"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("content")))
    return g.select("conv_id", convs.alias("conversations"), F.lit(None).cast("string").alias("system_prompt"))


def turns_long(spark, sf_dir) -> DataFrame:
    """One row per turn with the SFT role names (user -> human, assistant -> gpt)."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", _role().alias("from"), F.col("text").alias("value"))


SFT_SQL = """sft AS (
  SELECT conv_id,
         list(struct_pack("from" := CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END,
                          value := text, role := NULL::VARCHAR, content := NULL::VARCHAR) ORDER BY turn) AS conversations,
         NULL::VARCHAR AS system_prompt
  FROM conversations GROUP BY conv_id)"""


# ---------- preference pairs ----------
@shared
def pref(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = c.filter(F.col("role") == "assistant")
    ch = a.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response_chosen"))
    rj = a.select((F.col("conv_id") - 1).alias("conv_id"), (F.col("turn") - 1).alias("turn"),
                  F.col("text").alias("response_rejected"))
    return u.join(ch, ["conv_id", "turn"]).join(rj, ["conv_id", "turn"])


PREF_SQL = """pref AS (
  SELECT u.conv_id, u.turn, u.text AS question, c.text AS response_chosen, r.text AS response_rejected
  FROM conversations u
  JOIN conversations c ON c.conv_id = u.conv_id AND c.turn = u.turn + 1 AND c.role = 'assistant'
  JOIN conversations r ON r.conv_id = u.conv_id + 1 AND r.turn = u.turn + 1 AND r.role = 'assistant'
  WHERE u.role = 'user')"""


# ---------- completions ----------
@shared
def completions(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "assistant").select(
        F.col("conv_id").alias("prompt_id"), F.col("turn").cast("int").alias("gen_id"), F.col("text").alias("content"))


COMPLETIONS_SQL = """completions AS (
  SELECT conv_id AS prompt_id, CAST(turn AS INTEGER) AS gen_id, text AS content
  FROM conversations WHERE role = 'assistant')"""


# ---------- scored documents as evaluation results ----------
@shared
def docs_scored(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lab = table(spark, sf_dir, "labels")
    from alignfold.operators.rewards import nonblank_lines

    nl = nonblank_lines(F.col("text"))
    return d.join(lab, "doc_id").select(
        F.col("source").alias("model"), F.col("doc_id").alias("question_id"), "lang", "source", "text",
        F.col("quality").alias("accuracy"), F.when(nl >= 3, 2).when(nl == 2, 1).otherwise(0).alias("structure"),
        F.length("text").cast("long").alias("n_chars"), (1 - F.col("toxic")).alias("cot"), "quality", "toxic")


def _docs_scored_sql():
    from alignfold.operators.rewards import nonblank_lines_sql

    nl = nonblank_lines_sql("d.text")
    return f"""docs_scored AS (
  SELECT d.source AS model, d.doc_id AS question_id, d.lang, d.source, d.text, l.quality AS accuracy,
         CASE WHEN {nl} >= 3 THEN 2 WHEN {nl} = 2 THEN 1 ELSE 0 END AS structure,
         CAST(length(d.text) AS BIGINT) AS n_chars, 1 - l.toxic AS cot, l.quality, l.toxic
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


DOCS_SCORED_SQL = _docs_scored_sql()


# ---------- training metrics ----------
@shared
def metrics_long(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("run"), F.col("event_id").alias("step"), "ts",
                    F.col("event_type").alias("metric"), "value")


METRICS_LONG_SQL = """metrics_long AS (
  SELECT CAST(user_id AS VARCHAR) AS run, event_id AS step, ts, event_type AS metric, value FROM events)"""


def with_ctes(body: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
