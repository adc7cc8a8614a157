"""Registered plans: prompt extraction, prompt set, turns, templates, pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from alignfold.functions.text import hash_unit, hash_unit_sql, strip_sql
from alignfold.operators import prompts as P
from alignfold.operators import splits as S
from alignfold.operators import templates as TPL
from alignfold.operators import turns as TU
from alignfold.plans import fixtures as FX
from alignfold.plans.registry import query

W = strip_sql  # short alias inside SQL templates

SFTQ_SQL = f"""sftq AS (
  SELECT conv_id, min_by({W('text')}, turn) AS question FROM conversations
  WHERE role IN ('human', 'user') AND {W('text')} <> '' GROUP BY conv_id)"""
PREFQ_SQL = f"""prefq AS (
  SELECT {W("coalesce(text, '')")} AS question FROM conversations
  WHERE role = 'user' AND {W("coalesce(text, '')")} <> '')"""


@FX.shared
def sft_questions(spark, sf):
    return TU.first_user_turn_long(FX.table(spark, sf, "conversations")).select("question")


@FX.shared
def pref_questions(spark, sf):
    """P3 over the questions of all user turns (a pair's answers are not needed for it)."""
    user = FX.table(spark, sf, "conversations").filter(F.col("role") == "user")
    return TU.extract_questions(user.select(F.col("text").alias("question")))


@query("prompt_set", FX.with_ctes(
    """SELECT DISTINCT question, '' AS answer FROM (SELECT question FROM sftq UNION ALL SELECT question FROM prefq)
       WHERE length(question) >= 8 ORDER BY question""", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def prompt_set(spark, sf):
    """T2 flagship: first user turns + preference questions -> dedup -> min length 8 -> sorted records."""
    return S.build_prompt_set(sft_questions(spark, sf), pref_questions(spark, sf), min_len=8)


@query("source_overlap", FX.with_ctes(
    """SELECT CAST(sum(CASE WHEN a AND NOT b THEN 1 ELSE 0 END) AS BIGINT) AS only_a,
              CAST(sum(CASE WHEN b AND NOT a THEN 1 ELSE 0 END) AS BIGINT) AS only_b,
              CAST(sum(CASE WHEN a AND b THEN 1 ELSE 0 END) AS BIGINT) AS both
       FROM (SELECT question, bool_or(s = 'a') AS a, bool_or(s = 'b') AS b FROM
             (SELECT question, 'a' AS s FROM sftq UNION ALL SELECT question, 'b' FROM prefq) GROUP BY question)""",
    FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def source_overlap(spark, sf):
    return S.source_overlap(sft_questions(spark, sf), pref_questions(spark, sf))


@query("prompt_intersect", FX.with_ctes(
    "SELECT question FROM sftq INTERSECT SELECT question FROM prefq", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def prompt_intersect(spark, sf):
    return S.intersect_prompts(sft_questions(spark, sf), pref_questions(spark, sf))


@query("prompt_except", FX.with_ctes(
    "SELECT question FROM prefq EXCEPT SELECT question FROM sftq", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def prompt_except(spark, sf):
    return S.except_prompts(pref_questions(spark, sf), sft_questions(spark, sf))


@query("union_sources", FX.with_ctes(
    """SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT question) AS BIGINT) AS n_distinct FROM (
         SELECT question, 'sft' AS source FROM sftq UNION ALL SELECT question, 'preference' FROM prefq
         UNION ALL SELECT {q} AS question, 'corpus' FROM documents WHERE {q} <> '') GROUP BY source""".replace(
        "{q}", W("text")), FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def union_sources(spark, sf):
    """Three named prompt sources with provenance and per-source counts."""
    corpus = TU.extract_questions(FX.table(spark, sf, "documents"), "text")
    u = S.union_sources({"sft": sft_questions(spark, sf), "preference": pref_questions(spark, sf), "corpus": corpus})
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("question").alias("n_distinct"))


# ---------- turn level ----------
@query("turn_normalize", FX.with_ctes(
    """SELECT conv_id, CAST(t.i - 1 AS INTEGER) AS pos, coalesce(t.x."from", t.x.role, '') AS role,
              coalesce(t.x.value, t.x.content, '') AS text
       FROM (SELECT conv_id, unnest(list_transform(conversations, lambda x, i: {'x': x, 'i': i})) AS t FROM sft)""",
    FX.SFT_SQL))
def turn_normalize(spark, sf):
    """P1 exploded for comparison: (conv_id, position, role, text)."""
    s = FX.sft(spark, sf)
    return s.select("conv_id", F.posexplode(TU.normalize_turns("conversations")).alias("pos", "t")).select(
        "conv_id", F.col("pos").cast("int").alias("pos"), F.col("t.role").alias("role"), F.col("t.text").alias("text"))


@query("first_user_turn", FX.with_ctes(
    f"""SELECT conv_id, question FROM (
          SELECT conv_id, list_filter(list_transform(conversations, lambda t: {{'role': coalesce(t."from", t.role, ''),
                 'text': {W("coalesce(t.value, t.content, '')")}}}), lambda t: t.role IN ('human', 'user') AND t.text <> '')[1].text
                 AS question FROM sft) WHERE question IS NOT NULL""", FX.SFT_SQL))
def first_user_turn(spark, sf):
    """P2 array form over SFT records."""
    return TU.first_user_turn(FX.sft(spark, sf)).select("conv_id", "question")


@query("question_extract", FX.with_ctes("SELECT question FROM prefq", FX.PREF_SQL, PREFQ_SQL))
def question_extract(spark, sf):
    return pref_questions(spark, sf)


DIALOG_SQL = f"""dialog AS (
  SELECT conv_id, pairs, system FROM (
    SELECT conv_id, own_sys, system_prompt, msgs,
           list_transform(list_filter(list_transform(msgs, lambda m, i: {{'i': i, 'q': m, 'a': msgs[i + 1]}}),
                                      lambda s: s.i % 2 = 1), lambda s: {{'query': s.q, 'answer': s.a}}) AS pairs,
           CASE WHEN own_sys <> '' THEN own_sys ELSE coalesce(system_prompt, '') END AS system
    FROM (
      SELECT conv_id, own_sys, system_prompt, walk,
             list_transform(list_filter(walk, lambda t, j: t."from" = CASE WHEN (j - 1) % 2 = 0 THEN 'human' ELSE 'gpt' END),
                            lambda t: t.value) AS msgs
      FROM (
        SELECT conv_id, own_sys, system_prompt,
               CASE WHEN cut = 0 THEN rest2 ELSE rest2[1:cut - 1] END AS walk
        FROM (
          SELECT conv_id, own_sys, system_prompt, rest2,
                 coalesce(list_position(list_transform(rest2, lambda t: coalesce(t."from" IN ('human', 'gpt'), false)), false), 0) AS cut
          FROM (
            SELECT conv_id, own_sys, system_prompt,
                   CASE WHEN coalesce(rest[1]."from" = 'human', false) THEN rest ELSE rest[2:] END AS rest2
            FROM (
              SELECT conv_id, system_prompt,
                     CASE WHEN coalesce(conversations[1]."from" = 'system', false) THEN coalesce(conversations[1].value, '') ELSE '' END AS own_sys,
                     CASE WHEN coalesce(conversations[1]."from" = 'system', false) THEN conversations[2:] ELSE conversations END AS rest
              FROM sft WHERE len(conversations) >= 2)))
        WHERE len(rest2) >= 2))
    WHERE len(msgs) % 2 = 0))"""


@query("dialog_normalize", FX.with_ctes(
    "SELECT conv_id, CAST(len(pairs) AS INTEGER) AS n_pairs, system FROM dialog", FX.SFT_SQL, DIALOG_SQL))
def dialog_normalize(spark, sf):
    """P10 + P15: conversations surviving normalisation, with their pair count and system text."""
    d = TU.normalize_dialog(FX.sft(spark, sf))
    return d.select("conv_id", F.size("pairs").cast("int").alias("n_pairs"), "system")


@query("turn_pairs", FX.with_ctes(
    """SELECT conv_id, CAST(p.i AS INTEGER) AS k, p.x.query AS query, p.x.answer AS answer
       FROM (SELECT conv_id, unnest(list_transform(pairs, lambda x, i: {'x': x, 'i': i - 1})) AS p FROM dialog)""",
    FX.SFT_SQL, DIALOG_SQL))
def turn_pairs(spark, sf):
    """P11 exploded: (conv_id, k, query, answer)."""
    d = TU.normalize_dialog(FX.sft(spark, sf))
    return d.select("conv_id", F.posexplode_outer("pairs").alias("k", "p")).filter(F.col("k").isNotNull()).select(
        "conv_id", F.col("k").cast("int").alias("k"), F.col("p.query").alias("query"), F.col("p.answer").alias("answer"))


@query("dialog_normalize_long", FX.with_ctes(
    "SELECT conv_id, CAST(len(pairs) AS INTEGER) AS n_pairs, system FROM dialog", FX.SFT_SQL, DIALOG_SQL))
def dialog_normalize_long(spark, sf):
    """P10 long form (no per-conversation arrays, skew-proof); same result as ``dialog_normalize``."""
    convs, _ = TU.normalize_dialog_long(FX.turns_long(spark, sf))
    return convs.select("conv_id", "n_pairs", "system")


@query("turn_pairs_long", FX.with_ctes(
    """SELECT conv_id, CAST(p.i AS INTEGER) AS k, p.x.query AS query, p.x.answer AS answer
       FROM (SELECT conv_id, unnest(list_transform(pairs, lambda x, i: {'x': x, 'i': i - 1})) AS p FROM dialog)""",
    FX.SFT_SQL, DIALOG_SQL))
def turn_pairs_long(spark, sf):
    """P11 long form: (conv_id, k, query, answer) straight from the one-row-per-turn table."""
    _, pairs = TU.normalize_dialog_long(FX.turns_long(spark, sf))
    return pairs.select("conv_id", "k", "query", "answer")


_QWEN = TPL.get_template("qwen")
_VICUNA = TPL.get_template("vicuna")


@query("template_render", FX.with_ctes(
    f"""SELECT conv_id, {TPL.render_prompt_sql('pairs', 'system', _QWEN)} AS prompt_text,
               CAST(len({TPL.render_dialog_sql('pairs', 'system', _QWEN)}) AS INTEGER) AS n_parts
        FROM dialog""", FX.SFT_SQL, DIALOG_SQL))
def template_render(spark, sf):
    """P12 with the qwen template: get_prompt text and the dialog length."""
    d = TU.normalize_dialog(FX.sft(spark, sf))
    return d.select("conv_id", TPL.render_prompt("pairs", "system", _QWEN).alias("prompt_text"),
                    F.size(TPL.render_dialog("pairs", "system", _QWEN)).cast("int").alias("n_parts"))


def _template_by_row_sql():
    names = sorted(TPL.TEMPLATES)
    cases = " ".join(f"WHEN {i} THEN {TPL.render_prompt_sql('pairs', 'system', TPL.TEMPLATES[n])}"
                     for i, n in enumerate(names))
    pick = f"CAST(floor({hash_unit_sql(7, 'conv_id')} * {len(names)}) AS INTEGER)"
    return FX.with_ctes(
        f"""SELECT conv_id, names[1 + idx] AS template, CASE idx {cases} END AS prompt_text FROM (
              SELECT conv_id, pairs, system, {pick} AS idx FROM dialog), (SELECT {names!r} AS names)""",
        FX.SFT_SQL, DIALOG_SQL)


@query("template_by_row", _template_by_row_sql())
def template_by_row(spark, sf):
    """A template name per row (seeded-hash choice over the registry), resolved by a broadcast join."""
    names = sorted(TPL.TEMPLATES)
    d = TU.normalize_dialog(FX.sft(spark, sf))
    pick = F.floor(hash_unit(7, "conv_id") * len(names)).cast("int") + 1
    d = d.withColumn("template", F.element_at(F.array(*[F.lit(n) for n in names]), pick))
    d = TPL.with_template(d, "template")
    return d.select("conv_id", "template", TPL.render_prompt("pairs", "system", "row").alias("prompt_text"))


@query("append_pair", FX.with_ctes(
    """SELECT conv_id, CAST(len(list_append(pairs, {'query': 'next question', 'answer': ''})) AS INTEGER) AS n_pairs,
              list_append(pairs, {'query': 'next question', 'answer': ''})[-1].query AS last_query
       FROM dialog""", FX.SFT_SQL, DIALOG_SQL))
def append_pair(spark, sf):
    d = TU.normalize_dialog(FX.sft(spark, sf))
    a = TU.append_pair("pairs", F.lit("next question"), F.lit(""))
    return d.select("conv_id", F.size(a).cast("int").alias("n_pairs"), F.try_element_at(a, F.lit(-1))["query"].alias("last_query"))


@query("history_messages", FX.with_ctes(
    f"""SELECT conv_id, CAST(m.i - 1 AS INTEGER) AS pos, m.x.role AS role, m.x.content AS content FROM (
          SELECT conv_id, unnest(list_transform(msgs, lambda x, i: {{'x': x, 'i': i}})) AS m FROM (
            SELECT conv_id, list_concat(
                CASE WHEN system <> '' THEN [{{'role': 'system', 'content': system}}] ELSE [] END,
                flatten(list_transform(pairs[1:len(pairs) - 1], lambda p: list_filter(
                    [{{'role': 'user', 'content': coalesce(p.query, '')}}, {{'role': 'assistant', 'content': coalesce(p.answer, '')}}],
                    lambda m: m.role = 'user' OR m.content <> ''))),
                [{{'role': 'user', 'content': pairs[len(pairs)].query}}]) AS msgs
            FROM dialog WHERE len(pairs) >= 1))""", FX.SFT_SQL, DIALOG_SQL))
def history_messages(spark, sf):
    """P20: all complete pairs but the last are history; the last pair's query is the new query."""
    d = TU.normalize_dialog(FX.sft(spark, sf)).filter(F.size("pairs") >= 1)
    hist = F.slice("pairs", 1, F.size("pairs") - 1)
    msgs = TU.history_to_messages(hist, F.try_element_at("pairs", F.lit(-1))["query"], F.col("system"))
    return d.select("conv_id", F.posexplode(msgs).alias("pos", "m")).select(
        "conv_id", F.col("pos").cast("int").alias("pos"), F.col("m.role").alias("role"),
        F.col("m.content").alias("content"))


# ---------- pairs and prompts ----------
RP_SQL = f"""rp AS (
  SELECT conv_id, turn, '' AS system, {W("coalesce(question, '')")} AS question,
         {W("coalesce(response_chosen, '')")} AS response_chosen, {W("coalesce(response_rejected, '')")} AS response_rejected
  FROM pref)"""


@query("reward_pairs", FX.with_ctes(
    """SELECT conv_id, turn, system, CAST(0 AS INTEGER) AS n_history, question, response_chosen, response_rejected
       FROM rp WHERE question <> '' AND response_chosen <> '' AND response_rejected <> ''""", FX.PREF_SQL, RP_SQL))
def reward_pairs(spark, sf):
    """P4 + F2: strip three fields, drop any-empty, add empty system and history."""
    r = P.to_reward_pairs(FX.pref(spark, sf), keep=("conv_id", "turn"))
    return r.select("conv_id", "turn", "system", F.size("history").cast("int").alias("n_history"),
                    "question", "response_chosen", "response_rejected")


@query("conv_prompt", FX.with_ctes(
    """SELECT question, 'human' AS role, question AS value FROM (
         SELECT DISTINCT question FROM (SELECT question FROM sftq UNION ALL SELECT question FROM prefq)
         WHERE length(question) >= 8)""", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def conv_prompt(spark, sf):
    """Prompt set in conversation shape [{from: human, value}]."""
    ps = S.build_prompt_set(sft_questions(spark, sf), pref_questions(spark, sf), sort=False)
    c = P.to_conversation_prompts(ps)
    return c.select("question", F.col("conversations")[0]["from"].alias("role"),
                    F.col("conversations")[0]["value"].alias("value"))


GRPO_SYSTEM = "Think step by step, then answer."


@query("message_prompt", FX.with_ctes(
    f"""SELECT question, CAST(2 AS INTEGER) AS n_messages, '{GRPO_SYSTEM}' AS system_content, question AS user_content FROM (
         SELECT DISTINCT question FROM (SELECT question FROM sftq UNION ALL SELECT question FROM prefq)
         WHERE length(question) >= 8)""", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def message_prompt(spark, sf):
    """[{system}, {user}] message arrays; the system element is omitted when empty."""
    ps = S.build_prompt_set(sft_questions(spark, sf), pref_questions(spark, sf), sort=False)
    m = P.to_message_prompts(ps, GRPO_SYSTEM)
    return m.select("question", F.size("prompt").cast("int").alias("n_messages"),
                    F.col("prompt")[0]["content"].alias("system_content"),
                    F.col("prompt")[1]["content"].alias("user_content"))


@query("pref_prompt", FX.with_ctes(
    f"""SELECT conv_id, turn, {TPL.render_prompt_sql("[{'query': question, 'answer': ''}]", None, _QWEN)} AS prompt,
               response_chosen AS chosen, response_rejected AS rejected
        FROM pref""", FX.PREF_SQL))
def pref_prompt(spark, sf):
    """prompt = rendered history + [question, ''], responses passed through (qwen template)."""
    return P.to_preference_prompts(FX.pref(spark, sf), _QWEN, keep=("conv_id", "turn"))


@query("pair_text", FX.with_ctes(
    f"""SELECT conv_id, turn,
               {TPL.render_prompt_sql("[{'query': question, 'answer': response_chosen}]", None, _VICUNA)} AS text_chosen,
               {TPL.render_prompt_sql("[{'query': question, 'answer': response_rejected}]", None, _VICUNA)} AS text_rejected
        FROM pref""", FX.PREF_SQL))
def pair_text(spark, sf):
    """Full chosen / rejected texts (default vicuna template, as the reward-model launches use)."""
    return P.to_pair_texts(FX.pref(spark, sf), _VICUNA, keep=("conv_id", "turn"))


@query("rollout_prompt", FX.with_ctes(
    f"""SELECT conv_id, q AS query,
               {TPL.render_prompt_sql("[{'query': q, 'answer': ''}]", "'" + GRPO_SYSTEM + "'", _QWEN)} AS prompt
        FROM (SELECT conv_id, CASE WHEN conversations[1]."from" = 'human' THEN conversations[1].value
                                  ELSE list_filter(conversations, lambda t: t."from" = 'human')[1].value END AS q FROM sft)
        WHERE length({W("coalesce(q, '')")}) > 0""", FX.SFT_SQL))
def rollout_prompt(spark, sf):
    """P14 + F6: first human turn (turn 0 if human), rendered with system + generation suffix."""
    return P.to_rollout_prompts(FX.sft(spark, sf), GRPO_SYSTEM, _QWEN, keep=("conv_id",))


@query("response_clean", FX.with_ctes(
    f"""SELECT prompt_id, gen_id, {W("split_part(content, '.', 1)")} AS response FROM completions""",
    FX.COMPLETIONS_SQL))
def response_clean(spark, sf):
    """Cut each completion at the first stop string ('.' here), then strip."""
    c = FX.completions(spark, sf)
    return c.select("prompt_id", "gen_id", P.clean_response("content", ".").alias("response"))


@query("fan_out", FX.with_ctes(
    """SELECT question, CAST(g AS INTEGER) AS gen_id FROM (
         SELECT DISTINCT question FROM (SELECT question FROM sftq UNION ALL SELECT question FROM prefq)
         WHERE length(question) >= 8), range(1, 5) t(g)""", FX.PREF_SQL, SFTQ_SQL, PREFQ_SQL))
def fan_out(spark, sf):
    """4 generation slots per prompt."""
    ps = S.build_prompt_set(sft_questions(spark, sf), pref_questions(spark, sf), sort=False)
    return S.fan_out(ps.select("question"), 4).withColumn("gen_id", F.col("gen_id").cast("int"))


@query("assemble_pairs", FX.with_ctes(
    f"""SELECT c.conv_id, c.turn, c.question, c.chosen, r.rejected FROM
          (SELECT conv_id, turn, question, response_chosen AS chosen FROM pref) c
          JOIN (SELECT conv_id, turn, response_rejected AS rejected FROM pref) r USING (conv_id, turn)""",
    FX.PREF_SQL))
def assemble_pairs(spark, sf):
    """Chosen and rejected answer tables joined on the question key (conv_id, turn)."""
    p = FX.pref(spark, sf)
    chosen = p.select("conv_id", "turn", "question", F.col("response_chosen").alias("chosen"))
    rejected = p.select("conv_id", "turn", F.col("response_rejected").alias("rejected"))
    return P.assemble_pairs(chosen, rejected, ["conv_id", "turn"])
