"""Registered plans that compare whole values, on inputs where each rule bites: histories, aliases,
short and blank lines, padded arrays, chosen and rejected texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignfold.functions.text import hash_unit, hash_unit_sql, strip_sql
from alignfold.operators import filters as FL
from alignfold.operators import prompts as P
from alignfold.operators import rewards as R
from alignfold.operators import templates as TPL
from alignfold.operators import tokens as K
from alignfold.operators import turns as TU
from alignfold.plans import fixtures as FX
from alignfold.plans.q_rewards import REWARD_SQL, SCORED_SQL, rewarded
from alignfold.plans.q_tokens import MAX_LEN, PAIR_TOK_SQL, QWEN, VICUNA, examples, pair_tokens, token_steps_sql
from alignfold.plans.registry import query


# ---------- P1: role / content aliases ----------
@query("turn_alias", f"""SELECT conv_id, CAST(turn AS INTEGER) AS turn,
    CASE WHEN u < 0.3 THEN role WHEN role = 'user' THEN 'human' WHEN role = 'assistant' THEN 'gpt' ELSE role END AS role,
    CASE WHEN u >= 0.9 THEN '' ELSE text END AS text
    FROM (SELECT *, {hash_unit_sql(3, "CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR)")} AS u FROM conversations)""")
def turn_alias(spark, sf):
    """A third of the turns name their fields role / content, a tenth have no text at all."""
    c = FX.table(spark, sf, "conversations")
    u = hash_unit(3, F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")))
    c = c.withColumn("u", u)
    none = F.lit(None).cast("string")
    alias = F.col("u") < 0.3
    name = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    value = F.when(F.col("u") < 0.9, F.col("text"))
    turn = F.struct(F.when(~alias, name).alias("from"), F.when(~alias, value).alias("value"),
                    F.when(alias, F.col("role")).otherwise(none).alias("role"), F.when(alias, value).alias("content"))
    one = c.select("conv_id", "turn", F.array(turn).alias("conversations"))
    t = TU.normalize_turns("conversations")[0]
    return one.select("conv_id", F.col("turn").cast("int").alias("turn"), t["role"].alias("role"), t["text"].alias("text"))


# ---------- F1 / F6 ----------
@query("line_filters", f"""SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS chars
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE {strip_sql('line')} <> '' AND length(line) >= 60 GROUP BY doc_id""")
def line_filters(spark, sf):
    """F6 + F1: the lines of all documents without the blank ones and those of fewer than 60 characters."""
    d = FX.table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    kept = FL.min_length(FL.non_empty(d, "line"), "line", 60)
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("chars"))


# ---------- P8 / P9 with a history ----------
@FX.shared
def pref_history(spark, sf):
    c = FX.table(spark, sf, "conversations")
    u = c.filter("role = 'user'").select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("hu"))
    a = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("ha"))
    before = F.when(F.col("hu").isNotNull(), F.array(F.array("hu", "ha"))).otherwise(F.array().cast("array<array<string>>"))
    old = u.join(a, ["conv_id", "turn"])
    return FX.pref(spark, sf).join(old, ["conv_id", "turn"], "left").withColumn("history", before).drop("hu", "ha")


HISTORY_SQL = """pref_history AS (
  SELECT p.*, CASE WHEN u.text IS NULL OR a.text IS NULL THEN [] ELSE [{'query': u.text, 'answer': a.text}] END AS history
  FROM pref p
  LEFT JOIN (conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant')
    ON u.conv_id = p.conv_id AND u.turn = p.turn - 2 AND u.role = 'user')"""


def _with_history(answer: str) -> str:
    return f"list_concat(history, [{{'query': question, 'answer': {answer}}}])"


@query("pref_prompt_history", FX.with_ctes(
    f"""SELECT conv_id, turn, {TPL.render_prompt_sql(_with_history("''"), None, QWEN)} AS prompt,
               response_chosen AS chosen, response_rejected AS rejected FROM pref_history""", FX.PREF_SQL, HISTORY_SQL))
def pref_prompt_history(spark, sf):
    """P8 with the pair of turns before the question as its history."""
    return P.to_preference_prompts(pref_history(spark, sf), QWEN, keep=("conv_id", "turn"))


@query("pair_text_history", FX.with_ctes(
    f"""SELECT conv_id, turn, {TPL.render_prompt_sql(_with_history('response_chosen'), None, VICUNA)} AS text_chosen,
               {TPL.render_prompt_sql(_with_history('response_rejected'), None, VICUNA)} AS text_rejected FROM pref_history""",
    FX.PREF_SQL, HISTORY_SQL))
def pair_text_history(spark, sf):
    """P9 with a history."""
    return P.to_pair_texts(pref_history(spark, sf), VICUNA, keep=("conv_id", "turn"))


# ---------- K6-K8: values ----------
@query("label_mask_long", FX.with_ctes("SELECT conv_id, array_to_string(labels, ' ') AS labels FROM t6", *token_steps_sql(MAX_LEN)))
def label_mask_long(spark, sf):
    """K6 from the long form, value by value."""
    convs, pairs = TU.normalize_dialog_long(FX.turns_long(spark, sf))
    e = K.build_sft_examples_long(convs, pairs, QWEN, max_len=MAX_LEN)
    return e.select("conv_id", K.ids_str("labels").alias("labels"))


@query("pad_batch_values", FX.with_ctes(
    f"""SELECT conv_id, array_to_string(list_concat(input_ids, list_transform(range(target - len(input_ids)), lambda x: 0)), ' ') AS ids,
               array_to_string(list_concat(labels, list_transform(range(target - len(input_ids)), lambda x: -100)), ' ') AS labels
        FROM (SELECT conv_id, input_ids, labels, CAST(ceil(max(len(input_ids)) OVER (PARTITION BY batch) / 4.0) * 4 AS INTEGER) AS target
              FROM (SELECT conv_id, input_ids, labels, CAST(floor({hash_unit_sql(0, 'conv_id')} * 4) AS INTEGER) AS batch FROM t6))""",
    *token_steps_sql(MAX_LEN)))
def pad_batch_values(spark, sf):
    """K8: the padded ids and labels themselves."""
    p = K.pad_batch(examples(spark, sf).withColumn("batch", K.batch_of("conv_id", 4)), "batch", 4)
    return p.select("conv_id", K.ids_str("input_ids").alias("ids"), K.ids_str("labels").alias("labels"))


@query("pad_to_values", FX.with_ctes(
    """SELECT conv_id, turn, array_to_string(list_concat(ids_c, list_transform(range(160 - len(ids_c)), lambda x: 0)), ' ') AS chosen,
              array_to_string(list_concat(ids_r, list_transform(range(160 - len(ids_r)), lambda x: 0)), ' ') AS rejected
       FROM ptok""", *PAIR_TOK_SQL))
def pad_to_values(spark, sf):
    """K7 + K8: the padded ids of both sides."""
    p = K.pad_to(pair_tokens(spark, sf), 160)
    return p.select("conv_id", "turn", K.ids_str("input_ids_chosen").alias("chosen"), K.ids_str("input_ids_rejected").alias("rejected"))


# ---------- J7: texts ----------
@query("pairs_from_scores_text", FX.with_ctes(
    """SELECT * FROM (SELECT prompt_id, arg_max(content, (reward, -gen_id)) AS chosen, arg_min(content, (reward, gen_id)) AS rejected,
                             max(reward) AS hi, min(reward) AS lo FROM rewarded GROUP BY prompt_id) WHERE hi > lo""",
    FX.COMPLETIONS_SQL, SCORED_SQL, REWARD_SQL))
def pairs_from_scores_text(spark, sf):
    """The two texts of each pair."""
    p = R.pairs_from_scores(rewarded(spark, sf))
    return p.select("prompt_id", "chosen", "rejected", F.col("chosen_reward").alias("hi"), F.col("rejected_reward").alias("lo"))
