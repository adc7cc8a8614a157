"""Record-shape operators: reward pairs, prompt records, message / conversation prompts,
preference prompts, rollout prompts, response clean-up, results, pair assembly (P4-P9, P14, P16, P17, J6)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.text import col_of, strip
from alignfold.operators.templates import Template, render_prompt


def _keep(keep: Sequence[str]):
    return [F.col(k) for k in keep]


def to_reward_pairs(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P4 + F2: strip question / chosen / rejected, drop if any is empty, add system '' and history []."""
    q, c, r = (strip(F.coalesce(F.col(n), F.lit(""))) for n in ("question", "response_chosen", "response_rejected"))
    out = df.select(*_keep(keep), F.lit("").alias("system"),
                    F.array().cast(T.ArrayType(T.ArrayType(T.StringType()))).alias("history"),
                    q.alias("question"), c.alias("response_chosen"), r.alias("response_rejected"))
    return drop_empty(out, ["question", "response_chosen", "response_rejected"])


def drop_empty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """reject a row when any of ``cols`` is null or blank."""
    cond = None
    for c in cols:
        e = F.coalesce(strip(c), F.lit("")) != ""
        cond = e if cond is None else cond & e
    return df.filter(cond)


def to_prompt_records(df: DataFrame, col: str = "question") -> DataFrame:
    """P5: {question, answer}, carrying ``answer`` through when present."""
    ans = F.coalesce(F.col("answer"), F.lit("")) if "answer" in df.columns else F.lit("")
    return df.select(F.col(col).alias("question"), ans.alias("answer"))


def to_conversation_prompts(df: DataFrame, col: str = "question") -> DataFrame:
    """[{from: human, value: question}]."""
    return df.withColumn("conversations", F.array(F.struct(F.lit("human").alias("from"), F.col(col).alias("value"))))


def to_message_prompts(df: DataFrame, system_prompt: str = "", col: str = "question") -> DataFrame:
    """prompt = [{system}, {user}] (system omitted when empty); answer carried through or ''."""
    user = F.struct(F.lit("user").alias("role"), F.col(col).alias("content"))
    msgs = (F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")), user)
            if system_prompt else F.array(user))
    ans = F.coalesce(F.col("answer"), F.lit("")) if "answer" in df.columns else F.lit("")
    return df.withColumn("prompt", msgs).withColumn("answer", ans)


def _history_pairs(history_col: str | None, df: DataFrame):
    """D5 wire form array<array<string>> -> array<struct<query, answer>>."""
    if history_col and history_col in df.columns:
        return F.transform(F.coalesce(F.col(history_col), F.array().cast("array<array<string>>")),
                           lambda h: F.struct(h[0].alias("query"), h[1].alias("answer")))
    return F.array().cast("array<struct<query:string,answer:string>>")


def to_preference_prompts(df: DataFrame, template: Template, history: str | None = "history",
                          system: str | None = "system", keep: Sequence[str] = ()) -> DataFrame:
    """prompt = render(history + [question, '']); chosen / rejected passed through."""
    pairs = F.concat(_history_pairs(history, df),
                     F.array(F.struct(F.col("question").alias("query"), F.lit("").alias("answer"))))
    sys_col = F.col(system) if system and system in df.columns else None
    return df.select(*_keep(keep), render_prompt(pairs, sys_col, template).alias("prompt"),
                     F.col("response_chosen").alias("chosen"), F.col("response_rejected").alias("rejected"))


def to_pair_texts(df: DataFrame, template: Template, history: str | None = "history",
                  system: str | None = "system", keep: Sequence[str] = ()) -> DataFrame:
    """Full rendered text of each side: history + [question, response]."""
    h = _history_pairs(history, df)
    sys_col = F.col(system) if system and system in df.columns else None

    def side(resp):
        return render_prompt(F.concat(h, F.array(F.struct(F.col("question").alias("query"),
                                                          F.col(resp).alias("answer")))), sys_col, template)
    return df.select(*_keep(keep), side("response_chosen").alias("text_chosen"),
                     side("response_rejected").alias("text_rejected"))


def to_rollout_prompts(df: DataFrame, system_prompt: str, template: Template, conversations: str = "conversations",
                       keep: Sequence[str] = ()) -> DataFrame:
    """P14 + F6: query = turn 0 if it is human, else the first human turn (reads ``from`` only);
    blank queries dropped; prompt = system + user rendered with the generation suffix."""
    c = F.col(conversations)
    first_human = F.try_element_at(F.filter(c, lambda t: t["from"] == "human"), F.lit(1))["value"]
    t0 = F.try_element_at(c, F.lit(1))
    q = F.when(F.coalesce(t0["from"] == "human", F.lit(False)), t0["value"]).otherwise(first_human)
    out = df.select(*_keep(keep), q.alias("query")).filter(F.length(strip(F.coalesce("query", F.lit("")))) > 0)
    pairs = F.array(F.struct(F.col("query").alias("query"), F.lit("").alias("answer")))
    return out.withColumn("prompt", render_prompt(pairs, F.lit(system_prompt), template))


def clean_response(c, stop: str, strip_output: bool = True) -> "F.Column":
    """Cut at the first stop string, then strip (``strip_output=False``: the streaming
    variant, which cuts but keeps surrounding whitespace)."""
    cut = F.substring_index(col_of(c), stop, 1)
    return strip(cut) if strip_output else cut


def to_results(df: DataFrame, input_col: str, output_col: str, key: str | None = None) -> DataFrame:
    """{Input, Output} records, matched by key rather than by position."""
    cols = ([F.col(key)] if key else []) + [F.col(input_col).alias("Input"), F.col(output_col).alias("Output")]
    return df.select(*cols)


def assemble_pairs(chosen: DataFrame, rejected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Chosen and rejected answers of the same question become one preference row (equi-join on the key)."""
    return chosen.join(rejected, list(key), "inner")
