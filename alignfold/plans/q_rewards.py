"""Registered plans: rewards (R1-R11), group operators (R8-R10, J7), pair metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignfold.operators import metrics as M
from alignfold.operators import rewards as R
from alignfold.plans import fixtures as FX
from alignfold.plans.registry import query

LEX = FX.lexicon()


def _bp_sql(expr="content"):
    return (R.entity_bp_sql(expr, LEX), R.structure_bp_sql(expr, LEX), R.safety_bp_sql(expr, LEX),
            R.length_bp_sql(expr))


E, ST, SA, LN = _bp_sql()
SCORED_SQL = f"""scored AS (
  SELECT prompt_id, gen_id, content, {E} AS e_bp, {ST} AS st_bp, {SA} AS sa_bp, {LN} AS ln_bp FROM completions)"""
REWARD_SQL = f"""rewarded AS (
  SELECT prompt_id, gen_id, content,
         {R.to_score_sql('e_bp')} + {R.to_score_sql('st_bp')} + {R.to_score_sql('sa_bp')} + {R.to_score_sql('ln_bp')} AS reward
  FROM scored)"""


@FX.shared
def scored(spark, sf):
    return R.score(FX.completions(spark, sf), LEX)


@FX.shared
def rewarded(spark, sf):
    return R.score_total(FX.completions(spark, sf), LEX).select("prompt_id", "gen_id", "content", "reward")


def _single(name, col_sql):
    return FX.with_ctes(f"SELECT prompt_id, gen_id, {col_sql} AS {name} FROM completions", FX.COMPLETIONS_SQL)


@query("reward_entity", _single("entity", R.to_score_sql(E)))
def reward_entity(spark, sf):
    return FX.completions(spark, sf).select("prompt_id", "gen_id", R.REWARDS["entity"]("content", LEX).alias("entity"))


@query("reward_structure", _single("structure", R.to_score_sql(ST)))
def reward_structure(spark, sf):
    return FX.completions(spark, sf).select(
        "prompt_id", "gen_id", R.REWARDS["structure"]("content", LEX).alias("structure"))


@query("reward_safety", _single("safety", R.to_score_sql(SA)))
def reward_safety(spark, sf):
    return FX.completions(spark, sf).select("prompt_id", "gen_id", R.REWARDS["safety"]("content", LEX).alias("safety"))


@query("reward_length", _single("length", R.to_score_sql(LN)))
def reward_length(spark, sf):
    return FX.completions(spark, sf).select("prompt_id", "gen_id", R.REWARDS["length"]("content", LEX).alias("length"))


@query("reward_combined", FX.with_ctes(
    f"""SELECT prompt_id, gen_id, {R.to_score_sql('e_bp')} AS entity, {R.to_score_sql('st_bp')} AS structure,
               {R.to_score_sql('sa_bp')} AS safety, {R.to_score_sql('ln_bp')} AS length,
               {R.combined_from_bp_sql('e_bp', 'st_bp', 'sa_bp', 'ln_bp')} AS combined FROM scored""",
    FX.COMPLETIONS_SQL, SCORED_SQL))
def reward_combined(spark, sf):
    """R5 (+ J1): the four components and their weighted combination on one wide row."""
    return scored(spark, sf).select("prompt_id", "gen_id", "entity", "structure", "safety", "length", "combined")


@query("reward_repetition", _single("repetition", R.repetition_sql("content", ".")))
def reward_repetition(spark, sf):
    """R6 with '.' as the sentence mark (the synthetic prose has no '。')."""
    return FX.completions(spark, sf).select("prompt_id", "gen_id", R.repetition("content", ".").alias("repetition"))


@query("reward_total", FX.with_ctes("SELECT prompt_id, gen_id, reward FROM rewarded",
                                    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def reward_total(spark, sf):
    """Total reward = sum of the registered reward functions."""
    return rewarded(spark, sf).select("prompt_id", "gen_id", "reward")


@query("section_check", FX.with_ctes(
    """SELECT prompt_id, gen_id, instr(content, 'the') > 0 AS has_think, instr(content, 'and') > 0 AS has_advice,
              instr(content, 'the') > 0 AND instr(content, 'and') > instr(content, 'the') AS sections_in_order
       FROM completions""", FX.COMPLETIONS_SQL))
def section_check(spark, sf):
    """R11 with synthetic section markers ('the' before 'and')."""
    return FX.completions(spark, sf).select("prompt_id", "gen_id", *R.section_flags("content", ("the", "and")))


@query("group_advantage", FX.with_ctes(
    """SELECT r.prompt_id, r.gen_id, round(CASE WHEN g.k <= 1 THEN 0.0
                 ELSE (r.reward - g.mean) / (coalesce(g.sd, 0.0) + 0.0001) END, 6) AS advantage
       FROM rewarded r JOIN (SELECT prompt_id, count(*) AS k, avg(reward) AS mean, stddev_samp(reward) AS sd
                             FROM rewarded GROUP BY prompt_id) g USING (prompt_id)""",
    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def group_advantage(spark, sf):
    """GRPO in-group advantage."""
    a = R.group_advantage(rewarded(spark, sf))
    return a.select("prompt_id", "gen_id", F.round("advantage", 6).alias("advantage"))


@query("rloo_advantage", FX.with_ctes(
    """SELECT r.prompt_id, r.gen_id, round(CASE WHEN g.k <= 1 THEN 0.0
                 ELSE r.reward - (g.s - r.reward) / (g.k - 1) END, 6) AS advantage
       FROM rewarded r JOIN (SELECT prompt_id, count(*) AS k, sum(reward) AS s FROM rewarded GROUP BY prompt_id) g
       USING (prompt_id)""", FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def rloo_advantage(spark, sf):
    """Leave-one-out baseline."""
    a = R.rloo_advantage(rewarded(spark, sf))
    return a.select("prompt_id", "gen_id", F.round("advantage", 6).alias("advantage"))


@query("group_rank", FX.with_ctes(
    """SELECT prompt_id, gen_id, CAST(rank() OVER (PARTITION BY prompt_id ORDER BY reward DESC) AS INTEGER) AS rank,
              CAST(row_number() OVER (PARTITION BY prompt_id ORDER BY reward DESC, gen_id) AS INTEGER) AS row_number
       FROM rewarded""",
    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def group_rank(spark, sf):
    """Rank (equal rewards share) and row number (ties by gen_id) inside each prompt's group."""
    g = R.group_rank(rewarded(spark, sf))
    return g.select("prompt_id", "gen_id", F.col("rank").cast("int").alias("rank"),
                    F.col("row_number").cast("int").alias("row_number"))


@query("best_of_n", FX.with_ctes(
    """SELECT prompt_id, max(reward) AS reward, arg_max(gen_id, (reward, -gen_id)) AS gen_id,
              CAST(count(*) AS BIGINT) AS n FROM rewarded GROUP BY prompt_id""",
    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def best_of_n(spark, sf):
    """Best sample per group (ties to the lowest gen_id), as an aggregate."""
    return R.best_of_n(rewarded(spark, sf), payload=()).select("prompt_id", "reward", "gen_id", "n")


@query("pairs_from_scores", FX.with_ctes(
    """SELECT * FROM (SELECT prompt_id, arg_max(gen_id, (reward, -gen_id)) AS chosen_id, max(reward) AS chosen_reward,
                             arg_min(gen_id, (reward, gen_id)) AS rejected_id, min(reward) AS rejected_reward
                      FROM rewarded GROUP BY prompt_id) WHERE chosen_reward > rejected_reward""",
    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def pairs_from_scores(spark, sf):
    """Best and worst of each scored group as a preference pair; flat groups give none."""
    p = R.pairs_from_scores(rewarded(spark, sf))
    return p.select("prompt_id", "chosen_id", "chosen_reward", "rejected_id", "rejected_reward")


# ---------- pair scores and metrics ----------
PAIR_SCORES_SQL = f"""pair_scores AS (
  SELECT conv_id, turn, {R.combined_from_bp_sql(*_bp_sql('response_chosen'))} AS chosen_score,
         {R.combined_from_bp_sql(*_bp_sql('response_rejected'))} AS rejected_score FROM pref)"""


@FX.shared
def pair_scores(spark, sf):
    p = FX.pref(spark, sf)
    return M.pair_scores(p, LEX)


@query("pairwise_logloss", FX.with_ctes(
    """SELECT round(avg(ln(1 + exp(-abs(chosen_score - rejected_score))) + greatest(-(chosen_score - rejected_score), 0)), 6)
              AS logloss, CAST(count(*) AS BIGINT) AS n FROM pair_scores""", FX.PREF_SQL, PAIR_SCORES_SQL))
def pairwise_logloss(spark, sf):
    """M2: mean -log sigmoid(chosen - rejected), overflow-safe form."""
    return M.pairwise_logloss(pair_scores(spark, sf)).select(F.round("logloss", 6).alias("logloss"), "n")


@query("pair_distance", FX.with_ctes(
    """SELECT round(avg(pow(chosen_score - rejected_score, 2)), 6) AS mse,
              round(avg(abs(chosen_score - rejected_score)), 6) AS mae FROM pair_scores""",
    FX.PREF_SQL, PAIR_SCORES_SQL))
def pair_distance(spark, sf):
    """M3: MSE / MAE between chosen (predictions) and rejected (labels) scores."""
    d = M.pair_distance(pair_scores(spark, sf))
    return d.select(F.round("mse", 6).alias("mse"), F.round("mae", 6).alias("mae"))


@query("preference_metrics", FX.with_ctes(
    """SELECT round(avg(chosen_score - rejected_score), 6) AS margin, round(avg(chosen_score), 6) AS chosen_reward,
              round(avg(CASE WHEN chosen_score > rejected_score THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pair_scores""",
    FX.PREF_SQL, PAIR_SCORES_SQL))
def preference_metrics(spark, sf):
    """M5: margin, mean chosen reward, pairwise accuracy."""
    m = M.preference_metrics(pair_scores(spark, sf))
    return m.select(*[F.round(c, 6).alias(c) for c in ("margin", "chosen_reward", "accuracy")])


@query("perplexity", FX.with_ctes(
    """SELECT round(exp(avg(ln(1 + exp(-abs(chosen_score - rejected_score))) + greatest(-(chosen_score - rejected_score), 0))), 6)
              AS perplexity FROM pair_scores""", FX.PREF_SQL, PAIR_SCORES_SQL))
def perplexity(spark, sf):
    """M4: exp(loss) of the pairwise loss (infinity on overflow)."""
    loss = M.pairwise_logloss(pair_scores(spark, sf))
    return loss.select(F.round(M.perplexity("logloss"), 6).alias("perplexity"))


@query("group_spread", FX.with_ctes(
    """SELECT CAST(count(*) AS BIGINT) AS n_groups,
              round(avg(CASE WHEN coalesce(sd, 0.0) < 0.01 THEN 1.0 ELSE 0.0 END), 6) AS share_flat,
              round(avg(coalesce(sd, 0.0)), 6) AS mean_sd
       FROM (SELECT prompt_id, stddev_samp(reward) AS sd FROM rewarded GROUP BY prompt_id)""",
    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def group_spread(spark, sf):
    """Reward spread per group; share of groups with no spread (no learning signal)."""
    g = M.group_spread(rewarded(spark, sf), eps=0.01)
    return g.select("n_groups", F.round("share_flat", 6).alias("share_flat"), F.round("mean_sd", 6).alias("mean_sd"))


@query("component_balance", FX.with_ctes(
    """SELECT component, round(mean, 6) AS mean, round(sd, 6) AS sd, round(share, 6) AS share,
              sd < 0.0001 AS is_constant, share > 0.5 AS is_dominant FROM (
         SELECT component, avg(v) AS mean, coalesce(stddev_samp(v), 0.0) AS sd,
                sum(v) / sum(sum(v)) OVER () AS share
         FROM (UNPIVOT (SELECT prompt_id, gen_id, CAST(e_bp AS DOUBLE) / 10000.0 AS entity,
                               CAST(st_bp AS DOUBLE) / 10000.0 AS structure, CAST(sa_bp AS DOUBLE) / 10000.0 AS safety,
                               CAST(ln_bp AS DOUBLE) / 10000.0 AS length FROM scored)
               ON entity, structure, safety, length INTO NAME component VALUE v)
         GROUP BY component)""", FX.COMPLETIONS_SQL, SCORED_SQL))
def component_balance(spark, sf):
    """Mean, std and share of each reward component; constant / dominant flags."""
    b = M.component_balance(scored(spark, sf), ["entity", "structure", "safety", "length"])
    return b.select("component", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"),
                    F.round("share", 6).alias("share"), "is_constant", "is_dominant")
