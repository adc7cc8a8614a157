"""Rule-based completion rewards (R1-R11), group advantages and the reward registry.

Scores are computed as integer basis points and divided once, so Spark, DuckDB
and exact decimal arithmetic agree bit for bit. Every rule is a pure Column
expression: the same code scores a batch table or a stream (X2).
"""

from __future__ import annotations

from typing import Callable, Iterator, Sequence, Tuple

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.functions.lexicon import ENTITY_CATEGORIES, Lexicon
from alignfold.functions.rows import join_hot
from alignfold.functions.text import col_of, count_hits, count_hits_sql, strip, strip_sql

# FIXED VALUES of the scoring rules (basis points, 10000 = 1.0).
NUMBERED_MARK = r"[1-9][.、]|[一二三四五六七八九十][、.]"
ENTITY_STEP_BP = 250          # per category: 250 * min(10, 6 + hits)
STRUCT_BP = {"think": (1500, 3000), "advice": (1500, 3000), "numbered": (1000, 2000), "lines": (1000, 2000)}
SAFETY_BASE_BP, SAFETY_BONUS_BP, DANGER_BP = 5000, (2000, 3500, 5000), 3000
COMBINED_WEIGHTS = {"safety": 30, "entity": 30, "structure": 25, "length": 15}  # percent
SECTION_MARKS = ("【思考过程】", "【临床建议】")


def _c(content) -> Column:
    return F.coalesce(col_of(content), F.lit(""))


def _steps(n: Column, values: Sequence[int]) -> Column:
    """The value for 0, 1, 2, ... of a count; the last one for all larger counts. ``n`` stands once,
    so a costly count is not computed again in every branch."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.least(n, F.lit(len(values) - 1)) + 1)


# ---------- R1 entity coverage ----------
def entity_bp(content, lex: Lexicon) -> Column:
    c = _c(content)
    total = F.lit(0)
    for cat in ENTITY_CATEGORIES:
        total = total + _steps(count_hits(c, lex.get(cat)), [0, *(ENTITY_STEP_BP * n for n in (7, 8, 9, 10))])
    return total


def entity_bp_sql(expr: str, lex: Lexicon) -> str:
    parts = []
    for cat in ENTITY_CATEGORIES:
        h = count_hits_sql(expr, lex.get(cat))
        parts.append(f"(CASE WHEN {h} > 0 THEN least(10, {h} + 6) * {ENTITY_STEP_BP} ELSE 0 END)")
    return "(" + " + ".join(parts) + ")"


# ---------- R2 structure ----------
def _tier(n: Column, lo_hi, one_at: int) -> Column:
    return _steps(n, [0] * one_at + list(lo_hi))


def _tier_sql(n: str, lo_hi, one_at: int) -> str:
    lo, hi = lo_hi
    return f"(CASE WHEN {n} >= {one_at + 1} THEN {hi} WHEN {n} >= {one_at} THEN {lo} ELSE 0 END)"


def numbered_marks(content) -> Column:
    return F.regexp_count(_c(content), F.lit(NUMBERED_MARK))


def numbered_marks_sql(expr: str) -> str:
    return f"len(regexp_extract_all(coalesce({expr}, ''), '{NUMBERED_MARK}'))"


def nonblank_lines(content) -> Column:
    return F.size(F.filter(F.split(_c(content), "\n"), lambda p: strip(p) != ""))


def nonblank_lines_sql(expr: str) -> str:
    return f"len(list_filter(string_split(coalesce({expr}, ''), chr(10)), lambda p: {strip_sql('p')} <> ''))"


def structure_bp(content, lex: Lexicon) -> Column:
    c = _c(content)
    return (_tier(count_hits(c, lex.get("think")), STRUCT_BP["think"], 1)
            + _tier(count_hits(c, lex.get("advice")), STRUCT_BP["advice"], 1)
            + _tier(numbered_marks(c), STRUCT_BP["numbered"], 2)
            + _tier(nonblank_lines(c), STRUCT_BP["lines"], 2))


def structure_bp_sql(expr: str, lex: Lexicon) -> str:
    return ("(" + _tier_sql(count_hits_sql(expr, lex.get("think")), STRUCT_BP["think"], 1) + " + "
            + _tier_sql(count_hits_sql(expr, lex.get("advice")), STRUCT_BP["advice"], 1) + " + "
            + _tier_sql(numbered_marks_sql(expr), STRUCT_BP["numbered"], 2) + " + "
            + _tier_sql(nonblank_lines_sql(expr), STRUCT_BP["lines"], 2) + ")")


# ---------- R3 safety ----------
def safety_bp(content, lex: Lexicon) -> Column:
    c = _c(content)
    bonus = _steps(count_hits(c, lex.get("safety")), [0, *SAFETY_BONUS_BP])
    raw = F.lit(SAFETY_BASE_BP) + bonus - count_hits(c, lex.get("danger")) * DANGER_BP
    return F.when(c == "", 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(10000), raw)))


def safety_bp_sql(expr: str, lex: Lexicon) -> str:
    s = count_hits_sql(expr, lex.get("safety"))
    d = count_hits_sql(expr, lex.get("danger"))
    b1, b2, b3 = SAFETY_BONUS_BP
    raw = (f"({SAFETY_BASE_BP} + (CASE WHEN {s} >= 3 THEN {b3} WHEN {s} >= 2 THEN {b2} "
           f"WHEN {s} >= 1 THEN {b1} ELSE 0 END) - {d} * {DANGER_BP})")
    return f"(CASE WHEN coalesce({expr}, '') = '' THEN 0 ELSE greatest(0, least(10000, {raw})) END)"


# ---------- R4 length ----------
def length_bp(content) -> Column:
    n = F.length(_c(content))
    return (F.when(n < 50, 0).when(n < 100, 2000).when(n < 200, 5000 + 30 * (n - 100))
            .when(n <= 1500, 10000).when(n <= 2500, 10000 - 3 * (n - 1500))
            .otherwise(F.greatest(F.lit(1000), 7000 - 3 * (n - 2500))))


def length_bp_sql(expr: str) -> str:
    n = f"length(coalesce({expr}, ''))"
    return (f"(CASE WHEN {n} < 50 THEN 0 WHEN {n} < 100 THEN 2000 WHEN {n} < 200 THEN 5000 + 30 * ({n} - 100) "
            f"WHEN {n} <= 1500 THEN 10000 WHEN {n} <= 2500 THEN 10000 - 3 * ({n} - 1500) "
            f"ELSE greatest(1000, 7000 - 3 * ({n} - 2500)) END)")


# ---------- R5 combined ----------
def to_score(bp: Column) -> Column:
    return bp.cast("double") / F.lit(10000.0)


def to_score_sql(bp: str) -> str:
    return f"(CAST({bp} AS DOUBLE) / 10000.0)"


def combined_from_bp(entity: Column, structure: Column, safety: Column, length: Column) -> Column:
    w = COMBINED_WEIGHTS
    total = safety * w["safety"] + entity * w["entity"] + structure * w["structure"] + length * w["length"]
    return total.cast("double") / F.lit(1e6)


def combined_from_bp_sql(entity: str, structure: str, safety: str, length: str) -> str:
    w = COMBINED_WEIGHTS
    return (f"(CAST({safety} * {w['safety']} + {entity} * {w['entity']} + {structure} * {w['structure']} "
            f"+ {length} * {w['length']} AS DOUBLE) / 1000000.0)")


# ---------- R6 repetition ----------
def repetition(content, mark: str = "。") -> Column:
    parts = F.split(_c(content), "\\Q" + mark + "\\E", -1)  # the mark is literal, not a regex
    return F.size(F.array_distinct(parts)).cast("double") / F.size(parts).cast("double")


def repetition_sql(expr: str, mark: str = "。") -> str:
    parts = f"string_split(coalesce({expr}, ''), '{mark}')"
    return f"(CAST(len(list_distinct({parts})) AS DOUBLE) / CAST(len({parts}) AS DOUBLE))"


# ---------- R11 section presence ----------
def section_flags(content, marks: Sequence[str] = SECTION_MARKS) -> list:
    c = _c(content)
    think, advice = marks
    pos_t, pos_a = F.instr(c, think), F.instr(c, advice)
    return [(pos_t > 0).alias("has_think"), (pos_a > 0).alias("has_advice"),
            ((pos_t > 0) & (pos_a > pos_t)).alias("sections_in_order")]


# ---------- U1 registry + scoring ----------
RewardFn = Callable[[Column, Lexicon], Column]

REWARDS: dict = {
    "entity": lambda c, lex: to_score(entity_bp(c, lex)),
    "structure": lambda c, lex: to_score(structure_bp(c, lex)),
    "safety": lambda c, lex: to_score(safety_bp(c, lex)),
    "length": lambda c, lex: to_score(length_bp(c)),
    "repetition": lambda c, lex: repetition(c),
}


def register_reward(name: str, fn: RewardFn) -> None:
    """Add a reward: any function (content Column, Lexicon) -> double Column (a pandas_udf works too)."""
    REWARDS[name] = fn


def score(df: DataFrame, lex: Lexicon, content: str = "content", with_combined: bool = True) -> DataFrame:
    """R1-R5 as columns next to the input columns (J1: one wide row, no positional zip)."""
    e, st, sa, ln = entity_bp(content, lex), structure_bp(content, lex), safety_bp(content, lex), length_bp(content)
    out = df.withColumns({
        "entity": to_score(e), "structure": to_score(st), "safety": to_score(sa), "length": to_score(ln),
    })
    if with_combined:
        out = out.withColumn("combined", combined_from_bp(e, st, sa, ln))
    return out


def score_total(df: DataFrame, lex: Lexicon, rewards: Sequence[str] = ("entity", "structure", "safety", "length"),
                weights: Sequence[float] | None = None, content: str = "content", out: str = "reward") -> DataFrame:
    """The trainer's total is the (optionally weighted) sum of the independent rewards."""
    weights = list(weights) if weights is not None else [1.0] * len(rewards)
    cols = {name: REWARDS[name](content, lex) for name in rewards}
    total = None
    for (name, col), w in zip(cols.items(), weights):
        term = col if w == 1.0 else col * F.lit(float(w))
        total = term if total is None else total + term
    return df.withColumns(cols).withColumn(out, total)


def score_with(df: DataFrame, fn, prompt: str = "prompt", content: str = "content", out: str = "model_reward"):
    """A model (or any batch scorer) as reward. ``fn(prompts: pd.Series, contents: pd.Series) -> pd.Series``.

    Runs as an iterator pandas UDF, so a heavy scorer is loaded once per task, not per row.
    """
    from alignfold.session import ship_package

    ship_package(df.sparkSession)
    @F.pandas_udf("double")
    def _score(batches: Iterator[Tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for p, c in batches:
            yield pd.Series(fn(p, c), dtype="float64")

    return df.withColumn(out, _score(F.col(prompt), F.col(content)))


# ---------- R8 / R9 / R10 / J7 group operators ----------
def _with_group_stats(df: DataFrame, group: str, reward: str, tie: str | None) -> DataFrame:
    """Every row with its group's count, sum, mean and std: a partial + final aggregate joined back
    with the hot groups spread (see ``join_hot``). A null group is a group of its own."""
    st = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_k"), F.sum(reward).alias("_sum"), F.avg(reward).alias("_mean"),
        F.stddev_samp(reward).alias("_sd"))
    spread = [c for c in (tie, reward) if c and c in df.columns]
    return join_hot(df, st.withColumn("_n", F.col("_k")), [group], "_n", spread=spread)


def group_advantage(df: DataFrame, group: str = "prompt_id", reward: str = "reward", eps: float = 1e-4,
                    out: str = "advantage", tie: str = "gen_id") -> DataFrame:
    """R8 (GRPO): (r - group mean) / (group sample std + eps); a group of one gives 0.

    ``_k`` counts rows; a null reward has a null advantage and does not enter the mean."""
    j = _with_group_stats(df, group, reward, tie)
    adv = F.when(F.col("_k") <= 1, F.lit(0.0)).otherwise(
        (F.col(reward) - F.col("_mean")) / (F.coalesce(F.col("_sd"), F.lit(0.0)) + F.lit(eps)))
    return j.withColumn(out, adv).drop("_k", "_sum", "_mean", "_sd")


def rloo_advantage(df: DataFrame, group: str = "prompt_id", reward: str = "reward", out: str = "advantage",
                   tie: str = "gen_id"):
    """R9 (RLOO): r - mean of the other k-1 rewards; k = 1 gives 0."""
    j = _with_group_stats(df, group, reward, tie)
    adv = F.when(F.col("_k") <= 1, F.lit(0.0)).otherwise(
        F.col(reward) - (F.col("_sum") - F.col(reward)) / (F.col("_k") - 1))
    return j.withColumn(out, adv).drop("_k", "_sum", "_mean", "_sd")


def group_rank(df: DataFrame, group: str = "prompt_id", reward: str = "reward", tie: str = "gen_id",
               method: str = "index") -> DataFrame:
    """Rank (ties share) and row number (ties by ``tie``) of each sample inside its group.

    ``method='index'`` (default) is skew-proof: one order on (group, reward desc, tie) over range
    partitions (a hot group spans many), and one pass over each that counts on from the partitions
    before it (see ``segments.ranked``). Null groups are one group and null rewards rank last, as in a
    window. NaN ranks first, as Spark orders it. ``method='window'`` is the plain per-group window (one
    task per group).
    """
    if method == "window":
        from pyspark.sql import Window

        w = Window.partitionBy(group).orderBy(F.col(reward).desc())
        return (df.withColumn("rank", F.rank().over(w))
                .withColumn("row_number", F.row_number().over(Window.partitionBy(group).orderBy(F.col(reward).desc(), F.col(tie)))))
    from alignfold.operators.segments import ranked

    return ranked(df, group, reward, [F.col(group), F.col(reward).desc(), F.col(tie)])


def best_of_n(df: DataFrame, group: str = "prompt_id", reward: str = "reward", tie: str = "gen_id",
              payload: Sequence[str] = ("content",)) -> DataFrame:
    """R10 best-of-n as an aggregate (max_by on (reward, -tie)): no window, partial aggregation.

    A reward that is null or NaN is no reward: such samples are never the best, and a group of
    nothing else has a null reward and choice."""
    r = _real(reward)
    key = F.when(r.isNotNull(), F.struct(r.alias("_r"), (-F.col(tie)).alias("_t")))
    sel = [F.max_by(F.col(c), key).alias(c) for c in (tie, *payload)]
    return df.groupBy(group).agg(F.max(r).alias(reward), *sel, F.count(F.lit(1)).alias("n"))


def _real(reward: str) -> Column:
    """The reward, null where it is NaN."""
    r = F.col(reward).cast("double")
    return F.when(~F.isnan(r), r)


def pairs_from_scores(df: DataFrame, group: str = "prompt_id", reward: str = "reward", tie: str = "gen_id",
                      content: str = "content") -> DataFrame:
    """Best and worst sample of a group become (chosen, rejected); no pair when best == worst score.
    Samples whose reward is null or NaN take no part."""
    r = _real(reward)
    hi = F.when(r.isNotNull(), F.struct(r.alias("_r"), (-F.col(tie)).alias("_t")))
    lo = F.when(r.isNotNull(), F.struct(r.alias("_r"), F.col(tie).alias("_t")))
    g = df.groupBy(group).agg(
        F.max_by(F.col(content), hi).alias("chosen"), F.max_by(F.col(tie), hi).alias("chosen_id"),
        F.max(r).alias("chosen_reward"),
        F.min_by(F.col(content), lo).alias("rejected"), F.min_by(F.col(tie), lo).alias("rejected_id"),
        F.min(r).alias("rejected_reward"))
    return g.filter(F.col("chosen_reward") > F.col("rejected_reward"))
