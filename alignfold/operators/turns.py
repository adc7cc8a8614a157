"""Turn-level operators: aliasing, first user turn, dialog normalisation, pairing, history messages.

Array forms work on one conversation per row (the JSONL record format); long
forms work on one turn per row and use only partially-aggregated aggregates, so
a huge conversation never has to fit in one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.rows import keep_rows
from alignfold.functions.text import col_of, strip

USER_ROLES = ("human", "user")
DIALOG_ROLES = ("human", "gpt")
PAIR_T = T.ArrayType(T.StructType([T.StructField("query", T.StringType()), T.StructField("answer", T.StringType())]))


# ---------- P1 ----------
def normalize_turns(c) -> Column:
    """``from`` falls back to ``role``, ``value`` to ``content``; result array<struct<role, text>>."""
    return F.transform(col_of(c), lambda t: F.struct(
        F.coalesce(t["from"], t["role"], F.lit("")).alias("role"),
        F.coalesce(t["value"], t["content"], F.lit("")).alias("text")))


# ---------- P2 ----------
def first_user_turn(df: DataFrame, conversations: str = "conversations", out: str = "question") -> DataFrame:
    """First turn whose role is human/user and whose stripped text is non-empty; rows without one vanish."""
    turns = F.transform(normalize_turns(conversations), lambda t: F.struct(t["role"].alias("role"),
                                                                            strip(t["text"]).alias("text")))
    hit = F.filter(turns, lambda t: t["role"].isin(*USER_ROLES) & (t["text"] != ""))
    q = F.try_element_at(hit, F.lit(1))["text"]
    return keep_rows(df.withColumn(out, q), F.col(out).isNotNull())


def first_user_turn_long(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                         text: str = "text", out: str = "question") -> DataFrame:
    """Long form of P2: one row per turn in, one row per conversation out, via ``min_by`` (partial agg)."""
    t = turns.select(key, order, F.col(role).alias("_r"), strip(text).alias("_t"))
    t = t.filter(F.col("_r").isin(*USER_ROLES) & (F.col("_t") != ""))
    return t.groupBy(key).agg(F.min_by("_t", order).alias(out))


# ---------- P3 / F2 ----------
def extract_questions(df: DataFrame, col: str = "question", out: str = "question") -> DataFrame:
    return df.select(strip(F.coalesce(F.col(col), F.lit(""))).alias(out)).filter(F.col(out) != "")


# ---------- P10 + P11 + P15 ----------
def normalize_dialog(df: DataFrame, conversations: str = "conversations", system_col: str | None = "system_prompt",
                     strict: bool = False) -> DataFrame:
    """Dialog normalisation: leading system turn, leading non-human turn, role parity walk, odd drop.

    Adds ``system`` (conversation's own system text, else the row column, else '')
    and ``pairs`` array<struct<query, answer>>; conversations dropped by the rules vanish.
    Only ``from``/``value`` are read, as in the source format.
    """
    c = F.col(conversations)
    n = F.size(c)
    first = F.try_element_at(c, F.lit(1))
    has_sys = F.coalesce(first["from"] == "system", F.lit(False))
    # slice() clamps at the array end (a start past the end gives []), so no extra guards are needed
    rest = F.when(has_sys, F.slice(c, 2, n)).otherwise(c)
    own_sys = F.when(has_sys, F.coalesce(first["value"], F.lit(""))).otherwise(F.lit(""))
    first_ok = F.coalesce(F.try_element_at(rest, F.lit(1))["from"] == "human", F.lit(False))
    rest2 = F.when(first_ok, rest).otherwise(F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))))

    out = df.filter(n >= 2).withColumn("_rest", rest2).withColumn("_own_sys", own_sys)
    out = out.filter(F.size("_rest") >= 2)
    ok = F.transform("_rest", lambda t: F.coalesce(t["from"].isin(*DIALOG_ROLES), F.lit(False)))
    cut = F.array_position(ok, F.lit(False))  # 1-based first unknown role, 0 if none
    walk = F.when(cut == 0, F.col("_rest")).otherwise(F.slice("_rest", 1, F.greatest(cut - 1, F.lit(0))))
    kept = F.filter(walk, lambda t, j: t["from"] == F.when(j % 2 == 0, "human").otherwise("gpt"))
    out = out.withColumn("_walk", walk).withColumn("_msgs", F.transform(kept, lambda t: t["value"]))
    ok = F.size("_msgs") % 2 == 0
    if strict:
        ok = ok & (F.size("_msgs") == F.size("_walk"))
    out = keep_rows(out, ok)
    row_sys = F.coalesce(F.col(system_col), F.lit("")) if system_col and system_col in df.columns else F.lit("")
    system = F.when(F.col("_own_sys") != "", F.col("_own_sys")).otherwise(row_sys)
    return (out.withColumn("pairs", pair_turns("_msgs")).withColumn("system", system)
            .drop("_rest", "_own_sys", "_walk", "_msgs"))


def pair_turns(msgs) -> Column:
    """[m0, m1, m2, m3] -> [(m0, m1), (m2, m3)] (even-length input)."""
    m = col_of(msgs)
    tagged = F.transform(m, lambda x, i: F.struct(i.alias("i"), x.alias("query"),
                                                  F.try_element_at(m, i + 2).alias("answer")))
    return F.transform(F.filter(tagged, lambda s: s["i"] % 2 == 0),
                       lambda s: F.struct(s["query"].alias("query"), s["answer"].alias("answer")))


# ---------- P19 ----------
def append_pair(pairs, query, answer) -> Column:
    new = F.array(F.struct(col_of(query).alias("query"), col_of(answer).alias("answer")))
    return F.concat(F.coalesce(col_of(pairs), F.array().cast(PAIR_T)), new)


# ---------- P20 ----------
def history_to_messages(history, query, system=None) -> Column:
    """System (if non-empty), then user / assistant per pair (empty answers omitted), then the new query."""
    h = F.coalesce(col_of(history), F.array().cast(PAIR_T))
    msg = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    body = F.flatten(F.transform(h, lambda p: F.filter(
        F.array(msg("user", F.coalesce(p["query"], F.lit(""))), msg("assistant", F.coalesce(p["answer"], F.lit("")))),
        lambda m: (m["role"] == "user") | (m["content"] != ""))))
    tail = F.array(msg("user", col_of(query)))
    if system is None:
        return F.concat(body, tail)
    sys_arr = F.filter(F.array(msg("system", F.coalesce(col_of(system), F.lit("")))), lambda m: m["content"] != "")
    return F.concat(sys_arr, body, tail)


# ---------- P10 + P11, long form ----------
def normalize_dialog_long(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "from",
                          text: str = "value", strict: bool = False):
    """P10 + P11 on a one-row-per-turn table, with no per-conversation arrays.

    Same rules as ``normalize_dialog``; ``order`` must be unique in a conversation. The turns are ordered
    once over range partitions and written once (see ``segments``); a pass over the roles and a pass over
    the texts follow, in place. A conversation that holds a third of all turns lies in many partitions.
    Pairs cut by a border between partitions, at most two a border, are put together by their key.
    Returns (convs, pairs): convs(key, system, n_pairs) for surviving conversations, pairs(key, k, query,
    answer, system), where system is null but for k = 0.
    """
    from alignfold.operators import segments as SG

    held = turns.select(F.col(key), SG.role_code(role).alias("_r"), F.col(order), F.col(text).alias("_v"))
    held = SG.sorted_partitions(held, [key, order]).select(key, "_r", SG.PID, "_v")
    rows = SG.dialog_rows(held, strict)
    convs = rows.filter(F.col("kind") == SG.CONV).select(F.col("key").alias(key), "system", "n_pairs")
    whole = rows.filter(F.col("kind") == SG.PAIR).select(F.col("key").alias(key), "k", "query", "answer", "system")
    loose = rows.filter(F.col("kind") == SG.LOOSE).groupBy(F.col("key").alias("_key"), "k").agg(
        F.max("query").alias("query"), F.max("answer").alias("answer"))
    of = F.col("_key").eqNullSafe(F.col(key)) & (F.col("k") == 0)
    loose = loose.join(convs.select(key, "system"), of, "left").select(F.col("_key").alias(key), "k", "query", "answer", "system")
    return convs, whole.unionByName(loose)
