"""Evaluation and training-health aggregates (M1-M15) and result joins.

All per-row work is native columns; every aggregate is a partial + final hash
aggregate, so a hot group is combined map-side before the shuffle. Windows only
run over already-aggregated rows (one row per model, or per time bucket).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alignfold.functions.lexicon import Lexicon
from alignfold.functions.schemas import EVAL_QUESTION
from alignfold.operators import rewards as R


# ---------- pair metrics (M2-M5) ----------
def pair_scores(pref: DataFrame, lex: Lexicon, keep: Sequence[str] = ("conv_id", "turn")) -> DataFrame:
    """R5 score of each side of a preference pair."""
    def comb(c):
        return R.combined_from_bp(R.entity_bp(c, lex), R.structure_bp(c, lex), R.safety_bp(c, lex), R.length_bp(c))
    return pref.select(*keep, comb("response_chosen").alias("chosen_score"),
                       comb("response_rejected").alias("rejected_score"))


def _d(chosen: str = "chosen_score", rejected: str = "rejected_score") -> Column:
    return F.col(chosen) - F.col(rejected)


def logsigmoid_loss(d: Column) -> Column:
    """-log sigmoid(d) = log1p(exp(-|d|)) + max(-d, 0): finite for any d (naive form overflows at d = -800)."""
    return F.log1p(F.exp(-F.abs(d))) + F.greatest(-d, F.lit(0.0))


def pairwise_logloss(df: DataFrame, chosen: str = "chosen_score", rejected: str = "rejected_score") -> DataFrame:
    """M2 (+ M6 count)."""
    return df.agg(F.avg(logsigmoid_loss(_d(chosen, rejected))).alias("logloss"), F.count(F.lit(1)).alias("n"))


def pair_distance(df: DataFrame, chosen: str = "chosen_score", rejected: str = "rejected_score") -> DataFrame:
    """M3: predictions are the chosen scores, labels the rejected ones."""
    d = _d(chosen, rejected)
    return df.agg(F.avg(F.pow(d, 2)).alias("mse"), F.avg(F.abs(d)).alias("mae"))


def perplexity(loss) -> Column:
    """M4: exp(loss); overflow gives +infinity natively."""
    return F.exp(F.col(loss) if isinstance(loss, str) else loss)


def preference_metrics(df: DataFrame, chosen: str = "chosen_score", rejected: str = "rejected_score") -> DataFrame:
    """M5: preference margin, mean chosen reward, pairwise accuracy."""
    d = _d(chosen, rejected)
    return df.agg(F.avg(d).alias("margin"), F.avg(chosen).alias("chosen_reward"),
                  F.avg(F.when(d > 0, 1.0).otherwise(0.0)).alias("accuracy"))


# ---------- M1 / M6 ----------
def funnel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per pipeline stage: one count aggregate per stage, unioned into one (stage, n) table."""
    out = None
    for i, (name, d) in enumerate(stages.items()):
        part = d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def observe_counts(df: DataFrame, stage: str):
    """M1 without an extra pass: count rows as they flow through the next action that runs ``df``.

    Returns (df, observation); after the action, ``observation.get`` is {stage: n}.
    """
    from pyspark.sql import Observation

    obs = Observation(stage)
    return df.observe(obs, F.count(F.lit(1)).alias(stage)), obs


def with_counts(metrics: DataFrame, df: DataFrame, name: str = "samples") -> DataFrame:
    """M6: attach the sample count to a one-row metrics frame (equi-join of two one-row aggregates)."""
    cnt = df.agg(F.count(F.lit(1)).alias(name)).withColumn("_one", F.lit(1))
    return metrics.withColumn("_one", F.lit(1)).join(F.broadcast(cnt), "_one").drop("_one")


# ---------- M7-M11 evaluation reports ----------
def score_report(df: DataFrame, model: str = "model",
                 parts: Sequence[str] = ("accuracy", "structure", "cot")) -> DataFrame:
    """M7: mean total / accuracy / structure / cot per model (total = sum of the parts)."""
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.groupBy(model).agg(F.avg(total).alias("total"), *[F.avg(p).alias(p) for p in parts],
                                 F.count(F.lit(1)).alias("n"))


def stage_gain(report: DataFrame, order_col: str, value: str = "total") -> DataFrame:
    """M8: gain over the previous stage and over the first (base) stage.

    Runs on the per-model report (one row per stage), never on raw rows.
    """
    w = Window.orderBy(order_col)
    return report.select(
        "*", (F.col(value) - F.lag(value).over(w)).alias("gain_prev"),
        (F.col(value) - F.first(value).over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("gain_base"))


def best_per_metric(report: DataFrame, model: str, metrics: Sequence[str]) -> DataFrame:
    """M9: which model is best (rank 1, ties shared) in each metric column."""
    long = report.select(model, F.stack(F.lit(len(metrics)), *[x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))])
                         .alias("metric", "value"))
    w = Window.partitionBy("metric").orderBy(F.col("value").desc())
    return long.withColumn("rank", F.rank().over(w))


def breakdown(df: DataFrame, dims: Sequence[str], value: str) -> DataFrame:
    """Mean and count by dims with subtotals (rollup)."""
    return df.rollup(*dims).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))


def length_stats(df: DataFrame, model: str = "model", text: str = "text") -> DataFrame:
    """Completion length statistics per model (exact median; memory is bounded by distinct lengths)."""
    n = F.length(text)
    return df.groupBy(model).agg(F.avg(n).alias("mean_len"), F.min(n).alias("min_len"), F.max(n).alias("max_len"),
                                 F.percentile(n, 0.5).alias("median_len"))


# ---------- M12 / M13 ----------
def group_spread(df: DataFrame, group: str = "prompt_id", reward: str = "reward", eps: float = 1e-6) -> DataFrame:
    """Per-group sample std; share of groups whose spread is below eps (no learning signal)."""
    sd = df.groupBy(group).agg(F.coalesce(F.stddev_samp(reward), F.lit(0.0)).alias("sd"))
    return sd.agg(F.count(F.lit(1)).alias("n_groups"),
                  F.avg(F.when(F.col("sd") < eps, 1.0).otherwise(0.0)).alias("share_flat"),
                  F.avg("sd").alias("mean_sd"))


def component_balance(df: DataFrame, components: Sequence[str], const_eps: float = 1e-4,
                      dominant_share: float = 0.5) -> DataFrame:
    """Mean, std and share of each reward component in one aggregation pass (no unpivot of raw rows)."""
    aggs = []
    for c in components:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias(f"{c}__sd"),
                 F.sum(c).alias(f"{c}__sum")]
    one = df.agg(*aggs)
    total = sum((F.col(f"{c}__sum") for c in components[1:]), F.col(f"{components[0]}__sum"))
    rows = F.stack(F.lit(len(components)), *[x for c in components for x in (
        F.lit(c), F.col(f"{c}__mean"), F.col(f"{c}__sd"), F.try_divide(F.col(f"{c}__sum"), total))])
    out = one.select(rows.alias("component", "mean", "sd", "share"))
    return out.withColumn("is_constant", F.col("sd") < const_eps).withColumn("is_dominant", F.col("share") > dominant_share)


# ---------- M14 training health ----------
BUCKET_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def training_health(metrics: DataFrame, kl_metric: str, loss_metric: str, reward_metric: str,
                    bucket: str = "hour", window: int = 3, kl_explode: float = 1.0, kl_high: float = 0.5,
                    kl_low: float = 0.1, jump: float = 2.0, spike_sd: float = 3.0, flat_sd: float = 1e-3) -> DataFrame:
    """Flags per (run, metric, time bucket) from bucket means.

    Raw points are pre-aggregated per time bucket (partial aggregation, hot-run safe);
    lag and the trailing frame run over the bucket series only.
    KL: explosion > kl_explode, high in [kl_high, kl_explode], conservative < kl_low.
    Loss: NaN in the bucket, or mean jumps above ``jump`` x the previous bucket.
    Reward: spike above trailing mean + spike_sd * trailing std; flat when trailing std < flat_sd.
    """
    from alignfold.functions.text import epoch_seconds

    size = BUCKET_SECONDS[bucket]  # UTC buckets by epoch arithmetic: independent of the session zone
    b = metrics.groupBy("run", "metric", (F.floor(epoch_seconds(metrics, "ts") / size) * size).cast("long").alias("bucket")) \
        .agg(*bucket_facts())
    return health_flags(b, kl_metric, loss_metric, reward_metric, window, kl_explode, kl_high, kl_low, jump, spike_sd, flat_sd)


def bucket_facts() -> list[Column]:
    """Of a bucket's points: the mean of those that are numbers, how many are not, and how many there are."""
    return [F.avg(F.when(~F.isnan("value"), F.col("value"))).alias("mean"),
            F.sum(F.when(F.isnan("value"), 1).otherwise(0)).alias("n_nan"), F.count(F.lit(1)).alias("n")]


def health_flags(b: DataFrame, kl_metric: str, loss_metric: str, reward_metric: str, window: int = 3, kl_explode: float = 1.0,
                 kl_high: float = 0.5, kl_low: float = 0.1, jump: float = 2.0, spike_sd: float = 3.0,
                 flat_sd: float = 1e-3) -> DataFrame:
    """M14's rules on buckets (run, metric, bucket, mean, n_nan, n): each looks at most ``window`` buckets back."""
    w = Window.partitionBy("run", "metric").orderBy("bucket")
    trail = w.rowsBetween(-window, -1)
    b = b.withColumns({"prev": F.lag("mean").over(w), "t_mean": F.avg("mean").over(trail),
                       "t_sd": F.stddev_samp("mean").over(trail)})
    m = F.col("metric")
    kl = (F.when(m != kl_metric, None).when(F.col("mean") > kl_explode, "explosion")
          .when(F.col("mean") >= kl_high, "high").when(F.col("mean") < kl_low, "conservative").otherwise("ok"))
    loss = (F.when(m != loss_metric, None).when(F.col("n_nan") > 0, "nan")
            .when(F.col("prev").isNotNull() & (F.col("mean") > F.col("prev") * jump), "jump").otherwise("ok"))
    rew = (F.when(m != reward_metric, None)
           .when(F.col("t_sd").isNotNull() & (F.col("mean") > F.col("t_mean") + F.col("t_sd") * spike_sd), "spike")
           .when(F.col("t_sd").isNotNull() & (F.col("t_sd") < flat_sd), "flat").otherwise("ok"))
    return b.select("run", "metric", F.col("bucket").alias("bucket_ts"), "mean", "n",
                    kl.alias("kl_flag"), loss.alias("loss_flag"), rew.alias("reward_flag"))


def metric_windows(metrics: DataFrame, size: str = "2 hours", slide: str = "1 hour") -> DataFrame:
    """X4 batch twin: mean / std / count per run and metric in sliding event-time windows."""
    from alignfold.functions.text import as_instant

    return (metrics.groupBy("run", "metric", F.window(as_instant(metrics, "ts"), size, slide).alias("w"))
            .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.count(F.lit(1)).alias("n"))
            .select("run", "metric", F.unix_timestamp("w.start").alias("window_start"), "mean", "sd", "n"))


def list_metrics(metrics_long: DataFrame, run: str = "run", names: Sequence[str] | None = None) -> DataFrame:
    """One row per run, one column per metric name. With ``names`` the columns are known and no
    job has to look for them first."""
    pivot = metrics_long.groupBy(run).pivot("metric", list(names) if names is not None else None)
    return pivot.agg(F.max("value"))


# ---------- J2 / J3 ----------
def parse_results(results: DataFrame, input_col: str = "Input") -> DataFrame:
    """S10 core: parse the question record inside ``Input``; plain-text inputs keep ``question`` = Input."""
    parsed = F.from_json(F.col(input_col), EVAL_QUESTION)
    return results.withColumn("_q", parsed).withColumn(
        "q_id", F.col("_q.id")).withColumn(
        "q_text", F.coalesce(F.col("_q.question"), F.col(input_col))).drop("_q")


def join_results(results: DataFrame, questions: DataFrame, id_col: str = "id") -> DataFrame:
    """Results <-> question set by the id inside ``Input`` (equi-join; Spark picks broadcast by size)."""
    r = parse_results(results)
    return r.join(questions, r["q_id"] == questions[id_col], "inner").drop("q_id")


def model_means(df: DataFrame, key: str, model: str, value: str) -> DataFrame:
    """The mean of ``value`` for every key and model found, with the number of rows; null models are one."""
    return df.groupBy(key, model).agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))


def compare_models(results_by_model: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """Several models on one question set, one column per model."""
    u = None
    for name, d in results_by_model.items():
        part = d.select(F.col(key), F.lit(name).alias("model"), F.col(value))
        u = part if u is None else u.unionByName(part)
    return u.groupBy(key).pivot("model", list(results_by_model)).agg(F.first(value))
