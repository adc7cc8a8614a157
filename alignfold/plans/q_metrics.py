"""Registered plans: evaluation reports (M7-M11), training health (M14), metric windows (X4 batch twin),
result joins (J2, J3) and batched inference (U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignfold.operators import infer as INF
from alignfold.operators import metrics as M
from alignfold.plans import fixtures as FX
from alignfold.functions.text import strip_sql
from alignfold.operators import prompts as P
from alignfold.plans.q_prompts import PREFQ_SQL, SFTQ_SQL, pref_questions, sft_questions
from alignfold.operators import splits as S
from alignfold.plans.registry import query

REPORT_SQL = """report AS (
  SELECT model, avg(accuracy + structure + cot) AS total, avg(accuracy) AS accuracy, avg(structure) AS structure,
         avg(cot) AS cot, count(*) AS n FROM docs_scored GROUP BY model)"""


@FX.shared
def report(spark, sf):
    return M.score_report(FX.docs_scored(spark, sf))


def _r6(df, cols):
    return [F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns]


@query("score_report", FX.with_ctes(
    """SELECT model, round(total, 6) AS total, round(accuracy, 6) AS accuracy, round(structure, 6) AS structure,
              round(cot, 6) AS cot, CAST(n AS BIGINT) AS n FROM report""", FX.DOCS_SCORED_SQL, REPORT_SQL))
def score_report(spark, sf):
    """M7: mean total / accuracy / structure / cot per model."""
    r = report(spark, sf)
    return r.select(*_r6(r, {"total", "accuracy", "structure", "cot"}))


@query("stage_gain", FX.with_ctes(
    """SELECT model, round(total, 6) AS total, round(total - lag(total) OVER (ORDER BY model), 6) AS gain_prev,
              round(total - first_value(total) OVER (ORDER BY model), 6) AS gain_base FROM report""",
    FX.DOCS_SCORED_SQL, REPORT_SQL))
def stage_gain(spark, sf):
    """M8: gain of each stage (models in name order) over the previous stage and over the first."""
    g = M.stage_gain(report(spark, sf).select("model", "total"), "model")
    return g.select("model", *[F.round(c, 6).alias(c) for c in ("total", "gain_prev", "gain_base")])


@query("best_per_metric", FX.with_ctes(
    """SELECT model, metric, round(value, 6) AS value FROM (
         SELECT model, metric, value, rank() OVER (PARTITION BY metric ORDER BY value DESC) AS rk FROM (
           UNPIVOT (SELECT model, total, accuracy, structure, cot FROM report)
           ON total, accuracy, structure, cot INTO NAME metric VALUE value)) WHERE rk = 1""",
    FX.DOCS_SCORED_SQL, REPORT_SQL))
def best_per_metric(spark, sf):
    """M9: the best model(s) in each metric column (ties all starred)."""
    b = M.best_per_metric(report(spark, sf), "model", ["total", "accuracy", "structure", "cot"])
    return b.filter(F.col("rank") == 1).select("model", "metric", F.round("value", 6).alias("value"))


@query("score_breakdown", FX.with_ctes(
    """SELECT lang, source, round(avg(accuracy + structure + cot), 6) AS mean, CAST(count(*) AS BIGINT) AS n
       FROM docs_scored GROUP BY ROLLUP (lang, source)""", FX.DOCS_SCORED_SQL))
def score_breakdown(spark, sf):
    """Mean total score by language and source with subtotals."""
    d = FX.docs_scored(spark, sf).withColumn("total", F.col("accuracy") + F.col("structure") + F.col("cot"))
    b = M.breakdown(d, ["lang", "source"], "total")
    return b.select("lang", "source", F.round("mean", 6).alias("mean"), "n")


@query("length_stats", FX.with_ctes(
    """SELECT model, round(avg(length(text)), 6) AS mean_len, CAST(min(length(text)) AS INTEGER) AS min_len,
              CAST(max(length(text)) AS INTEGER) AS max_len, round(quantile_cont(length(text), 0.5), 6) AS median_len
       FROM (SELECT source AS model, text FROM documents) GROUP BY model"""))
def length_stats(spark, sf):
    """Text length statistics per source over all documents."""
    s = M.length_stats(FX.table(spark, sf, "documents").withColumnRenamed("source", "model"))
    return s.select("model", F.round("mean_len", 6).alias("mean_len"), F.col("min_len").cast("int").alias("min_len"),
                    F.col("max_len").cast("int").alias("max_len"), F.round("median_len", 6).alias("median_len"))


HEALTH = dict(kl_metric="view", loss_metric="error", reward_metric="purchase", bucket="day", window=3,
              kl_explode=40.0, kl_high=25.0, kl_low=5.0, jump=2.0, spike_sd=3.0, flat_sd=0.5)


def health_sql(closed: str = "") -> str:
    return FX.with_ctes(f"""SELECT run, metric, bucket AS bucket_ts, round(mean, 6) AS mean, CAST(n AS BIGINT) AS n,
          CASE WHEN metric <> 'view' THEN NULL WHEN mean > 40.0 THEN 'explosion' WHEN mean >= 25.0 THEN 'high'
               WHEN mean < 5.0 THEN 'conservative' ELSE 'ok' END AS kl_flag,
          CASE WHEN metric <> 'error' THEN NULL WHEN n_nan > 0 THEN 'nan'
               WHEN prev IS NOT NULL AND mean > prev * 2.0 THEN 'jump' ELSE 'ok' END AS loss_flag,
          CASE WHEN metric <> 'purchase' THEN NULL WHEN t_sd IS NOT NULL AND mean > t_mean + t_sd * 3.0 THEN 'spike'
               WHEN t_sd IS NOT NULL AND t_sd < 0.5 THEN 'flat' ELSE 'ok' END AS reward_flag
        FROM (SELECT *, lag(mean) OVER w AS prev,
                     avg(mean) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS t_mean,
                     stddev_samp(mean) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS t_sd
              FROM (SELECT run, metric, CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT) AS bucket,
                           avg(CASE WHEN NOT isnan(value) THEN value END) AS mean,
                           sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END) AS n_nan, count(*) AS n
                    FROM metrics_long GROUP BY ALL)
              WINDOW w AS (PARTITION BY run, metric ORDER BY bucket)) {closed}""", FX.METRICS_LONG_SQL)


@query("training_health", health_sql())
def training_health(spark, sf):
    """KL / loss / reward health flags on daily bucket means per run and metric."""
    h = M.training_health(FX.metrics_long(spark, sf), **HEALTH)
    return h.select("run", "metric", "bucket_ts", F.round("mean", 6).alias("mean"), "n", "kl_flag", "loss_flag",
                    "reward_flag")


@query("metric_windows", FX.with_ctes(
    """SELECT run, metric, CAST(epoch(ws) AS BIGINT) AS window_start, round(avg(value), 6) AS mean,
              round(stddev_samp(value), 6) AS sd, CAST(count(*) AS BIGINT) AS n
       FROM (SELECT run, metric, value, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS ws
             FROM metrics_long) GROUP BY ALL""", FX.METRICS_LONG_SQL))
def metric_windows(spark, sf):
    """X4 batch twin: mean / std / count per run and metric in 2-hour windows sliding by 1 hour."""
    w = M.metric_windows(FX.metrics_long(spark, sf), "2 hours", "1 hour")
    return w.select("run", "metric", "window_start", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), "n")


@query("results_join", FX.with_ctes(
    """SELECT q.doc_id AS id, q.lang AS scene, q.source AS perspective, CAST(length(r.text) AS INTEGER) AS output_len
       FROM documents r JOIN documents q ON q.doc_id = r.doc_id"""))
def results_join(spark, sf):
    """Results whose Input is the question record as JSON text, joined back to the question set by id."""
    r = FX.table(spark, sf, "documents").select(
        F.to_json(F.struct(F.col("doc_id").alias("id"), "source", F.col("lang").alias("scene"),
                           F.col("source").alias("perspective"), F.col("text").alias("question"))).alias("Input"),
        F.col("text").alias("Output"))
    q = FX.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("scene"),
                                                F.col("source").alias("perspective"))
    j = M.join_results(r, q, "id")
    return j.select("id", "scene", "perspective", F.length("Output").cast("int").alias("output_len"))


LANGS = ("de", "en", "es", "fr")  # models with a column of their own; all others share one
SIDE_BY_SIDE_SQL = ("SELECT source, " + ", ".join(f"round(avg(CASE WHEN lang = '{x}' THEN accuracy + structure + cot END), 6) AS {x}" for x in LANGS)
                    + f", round(avg(CASE WHEN coalesce(lang, '') NOT IN {LANGS} THEN accuracy + structure + cot END), 6) AS other"
                    " FROM docs_scored GROUP BY source")


def _side_by_side(d):
    """One row per source: the mean total of each named model, and of all that are not named."""
    d = d.withColumn("model", F.when(F.col("lang").isin(*LANGS), F.col("lang")).otherwise("other"))
    means = M.model_means(d, "source", "model", "total").withColumn("total", F.round("total", 6))
    return M.compare_models({x: means.filter(F.col("model") == x) for x in (*LANGS, "other")}, "source", "total")


@query("model_compare", FX.with_ctes(
    f"""SELECT m.*, {", ".join(f"s.{x}" for x in (*LANGS, "other"))} FROM (
          SELECT source, lang AS model, round(avg(accuracy + structure + cot), 6) AS total, CAST(count(*) AS BIGINT) AS n
          FROM docs_scored GROUP BY source, lang) m
        JOIN ({SIDE_BY_SIDE_SQL}) s ON s.source IS NOT DISTINCT FROM m.source""", FX.DOCS_SCORED_SQL))
def model_compare(spark, sf):
    """All models (here the languages) on one question set (the sources): one row per model found, beside the
    means of the named models and of all others."""
    d = FX.docs_scored(spark, sf).withColumn("total", F.col("accuracy") + F.col("structure") + F.col("cot"))
    means = M.model_means(d, "source", "lang", "total").select("source", F.col("lang").alias("model"), F.round("total", 6).alias("total"), "n")
    side = _side_by_side(d).withColumnRenamed("source", "_source")
    return means.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


@query("model_compare_wide", FX.with_ctes(SIDE_BY_SIDE_SQL, FX.DOCS_SCORED_SQL))
def model_compare_wide(spark, sf):
    """A column for each named model and one for all that are not named."""
    return _side_by_side(FX.docs_scored(spark, sf).withColumn("total", F.col("accuracy") + F.col("structure") + F.col("cot")))


@query("sample_counts", FX.with_ctes(
    """SELECT round(avg(total), 6) AS mean_total, CAST(count(*) AS BIGINT) AS samples
       FROM (SELECT accuracy + structure + cot AS total FROM docs_scored)""", FX.DOCS_SCORED_SQL))
def sample_counts(spark, sf):
    """M6: a metrics row with its number of samples."""
    d = FX.docs_scored(spark, sf).withColumn("total", F.col("accuracy") + F.col("structure") + F.col("cot"))
    return M.with_counts(d.agg(F.round(F.avg("total"), 6).alias("mean_total")), d)


def _echo_generator(prompts, system_prompt):
    # stand-in for a language model: deterministic, cheap, and contains the stop string
    return [f" {system_prompt}{p[::-1]} </s>ignored" for p in prompts]


@query("batch_infer", FX.with_ctes(
    f"""SELECT question AS "Input", {strip_sql("' ' || reverse(question) || ' '")} AS "Output"
        FROM (SELECT question FROM sftq UNION SELECT question FROM prefq) WHERE length(question) >= 8""",
    FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def batch_infer(spark, sf):
    """U3 + P16 + P17: batched generation over the whole prompt set (stub generator), matched by key."""
    ps = S.build_prompt_set(sft_questions(spark, sf), pref_questions(spark, sf), sort=False)
    ps = ps.withColumn("id", F.sha2("question", 256))
    out = INF.batch_infer(ps, _echo_generator, key="id", prompt="question", batch=4, system_prompt="")
    return P.to_results(ps.select("id", "question").join(out.select("id", "Output"), "id"), "question", "Output")
