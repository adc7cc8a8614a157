"""Registered plans: token arrays (K1-K8, P18, F3-F5) over rendered SFT dialogs and preference pairs."""

from __future__ import annotations

import importlib.util

from pyspark.sql import functions as F

from alignfold.operators import prompts as P
from alignfold.operators import templates as TPL
from alignfold.operators import tokens as K
from alignfold.operators import turns as TU
from alignfold.functions.text import hash_unit_sql
from alignfold.plans import fixtures as FX
from alignfold.plans.q_prompts import DIALOG_SQL
from alignfold.plans.registry import query

QWEN = TPL.get_template("qwen")
VICUNA = TPL.get_template("vicuna")
MAX_LEN = 64          # small budget so truncation and the turn budget both bite on the test tables
TOK = K.whitespace_tokenize_sql


# ---------- SQL twins of the array pipeline ----------
def _trunc_sql(max_len: int) -> str:
    ns, nt = "len(t.src)", "len(t.tgt)"
    tot = f"CAST({ns} + {nt} AS DOUBLE)"
    ms = f"CAST(floor({float(max_len)} * (CAST({ns} AS DOUBLE) / {tot})) AS INTEGER)"
    mt = f"CAST(floor({float(max_len)} * (CAST({nt} AS DOUBLE) / {tot})) AS INTEGER)"
    keep_t = f"(CASE WHEN {mt} = 0 THEN greatest({nt} - 1, 0) ELSE least({nt}, {mt} - 1) END)"
    return (f"{{'src': CASE WHEN {ns} > {ms} THEN t.src[1:{ms}] ELSE t.src END, "
            f"'tgt': CASE WHEN {nt} > {mt} - 1 THEN t.tgt[1:{keep_t}] ELSE t.tgt END}}")


STRIP_SQL = ("{'src': CASE WHEN len(t.src) > 0 AND t.src[1] = 2 THEN t.src[2:] ELSE t.src END, "
             "'tgt': CASE WHEN len(t.tgt) > 0 AND t.tgt[-1] = 2 THEN t.tgt[1:len(t.tgt) - 1] ELSE t.tgt END}")


def token_steps_sql(max_len: int) -> list:
    return [
        FX.SFT_SQL, DIALOG_SQL,
        f"""rendered AS (SELECT conv_id, {TPL.render_dialog_sql('pairs', 'system', QWEN)} AS d FROM dialog)""",
        f"""t1 AS (SELECT conv_id, list_transform(generate_series(0, len(d) // 2 - 1), lambda i: {{
                'src': list_concat(CASE WHEN i = 0 THEN [1] ELSE [] END, {TOK('d[2 * i + 1]')}),
                'tgt': {TOK('d[2 * i + 2]')}}}) AS turns FROM rendered)""",
        """t2 AS (SELECT conv_id, turns FROM t1 WHERE len(list_filter(turns, lambda t: len(t.src) + len(t.tgt) = 0)) = 0)""",
        f"""t3 AS (SELECT conv_id, list_transform(turns, lambda t: {_trunc_sql(max_len)}) AS turns FROM t2)""",
        f"""t4 AS (SELECT conv_id, list_transform(turns, lambda t: {STRIP_SQL}) AS turns FROM t3)""",
        f"""t5 AS (SELECT conv_id, list_transform(list_filter(list_transform(turns, lambda t, i: {{'t': t,
                'cum': coalesce(list_sum(list_transform(turns[1:i], lambda u: len(u.src) + len(u.tgt) + 1)), 0)}}),
                lambda z: z.cum <= {max_len}), lambda z: z.t) AS turns FROM t4)""",
        """t6 AS (SELECT conv_id, flatten(list_transform(turns, lambda t: list_concat(t.src, t.tgt, [2]))) AS input_ids,
                flatten(list_transform(turns, lambda t: list_concat(repeat([-100], len(t.src)), t.tgt, [2]))) AS labels,
                CAST(len(turns) AS INTEGER) AS n_turns FROM t5)""",
    ]


@FX.shared
def dialogs(spark, sf):
    d = TU.normalize_dialog(FX.sft(spark, sf))
    return d.select("conv_id", TPL.render_dialog("pairs", "system", QWEN).alias("dialog"))


@FX.shared
def examples(spark, sf, max_len=MAX_LEN):
    return K.build_sft_examples(dialogs(spark, sf), "dialog", max_len, keep=("conv_id",))


@query("token_counts", FX.with_ctes(
    """SELECT conv_id, CAST(u.i AS INTEGER) AS k, CAST(len(u.t.src) AS INTEGER) AS n_src, CAST(len(u.t.tgt) AS INTEGER) AS n_tgt
       FROM (SELECT conv_id, unnest(list_transform(turns, lambda t, i: {'t': t, 'i': i - 1})) AS u FROM t1)""",
    *token_steps_sql(MAX_LEN)))
def token_counts(spark, sf):
    """K1: tokens per turn side (bos on the first query only)."""
    t = dialogs(spark, sf).select("conv_id", F.posexplode(K.tokenize_dialog("dialog")).alias("k", "t"))
    return t.select("conv_id", F.col("k").cast("int").alias("k"), F.size("t.src").cast("int").alias("n_src"),
                    F.size("t.tgt").cast("int").alias("n_tgt"))


def _turn_sizes(df_turns, name):
    # outer generator + null filter: a plain explode of an attribute makes Catalyst infer size(turns) > 0
    # and push it below the token pipeline, which would then run twice
    t = df_turns.select("conv_id", F.posexplode_outer(name).alias("k", "t")).filter(F.col("k").isNotNull())
    return t.select("conv_id", F.col("k").cast("int").alias("k"), F.size("t.src").cast("int").alias("n_src"),
                    F.size("t.tgt").cast("int").alias("n_tgt"))


def _stage(spark, sf, upto: str):
    d = dialogs(spark, sf).select("conv_id", K.tokenize_dialog("dialog").alias("turns"))
    d = K.quarantine_empty_turns(d, "turns")
    d = d.withColumn("turns", F.transform("turns", lambda t: K.truncate_turn(t["src"], t["tgt"], MAX_LEN)))
    if upto == "truncate":
        return d
    d = d.withColumn("turns", F.transform("turns", lambda t: K.strip_eos(t["src"], t["tgt"])))
    if upto == "strip":
        return d
    return d.withColumn("turns", K.turn_budget("turns", MAX_LEN))


_SIZES_SQL = """SELECT conv_id, CAST(u.i AS INTEGER) AS k, CAST(len(u.t.src) AS INTEGER) AS n_src, CAST(len(u.t.tgt) AS INTEGER) AS n_tgt
       FROM (SELECT conv_id, unnest(list_transform(turns, lambda t, i: {'t': t, 'i': i - 1})) AS u FROM {T})"""


@query("turn_truncate", FX.with_ctes(_SIZES_SQL.replace("{T}", "t3"), *token_steps_sql(MAX_LEN)))
def turn_truncate(spark, sf):
    """K2: per-turn sizes after proportional truncation to 64 tokens."""
    return _turn_sizes(_stage(spark, sf, "truncate"), "turns")


@query("eos_strip", FX.with_ctes(_SIZES_SQL.replace("{T}", "t4"), *token_steps_sql(MAX_LEN)))
def eos_strip(spark, sf):
    """K3: per-turn sizes after dropping a leading source eos / trailing target eos."""
    return _turn_sizes(_stage(spark, sf, "strip"), "turns")


@query("turn_budget", FX.with_ctes(
    """SELECT conv_id, CAST(len(turns) AS INTEGER) AS n_turns,
              CAST(coalesce(list_sum(list_transform(turns, lambda t: len(t.src) + len(t.tgt) + 1)), 0) AS INTEGER) AS n_tokens
       FROM t5""", *token_steps_sql(MAX_LEN)))
def turn_budget(spark, sf):
    """K4: turns kept under the 64-token budget and their token total."""
    d = _stage(spark, sf, "budget")
    tot = F.aggregate(F.transform("turns", lambda t: F.size(t["src"]) + F.size(t["tgt"]) + 1), F.lit(0), lambda a, x: a + x)
    return d.select("conv_id", F.size("turns").cast("int").alias("n_turns"), tot.cast("int").alias("n_tokens"))


@query("pack_turns", FX.with_ctes(
    """SELECT conv_id, array_to_string(input_ids, ' ') AS input_ids, CAST(len(input_ids) AS INTEGER) AS n_attention
       FROM t6""", *token_steps_sql(MAX_LEN)))
def pack_turns(spark, sf):
    """K5: packed input ids (space-joined for comparison) and attention-mask length."""
    e = examples(spark, sf)
    return e.select("conv_id", K.ids_str("input_ids").alias("input_ids"), F.size("attention_mask").cast("int").alias("n_attention"))


@query("pack_turns_long", FX.with_ctes(
    """SELECT conv_id, array_to_string(input_ids, ' ') AS input_ids, CAST(len(input_ids) AS INTEGER) AS n_attention
       FROM t6""", *token_steps_sql(MAX_LEN)))
def pack_turns_long(spark, sf):
    """K1-K6 from the one-row-per-turn long form (no per-conversation turn arrays); same result as pack_turns."""
    convs, pairs = TU.normalize_dialog_long(FX.turns_long(spark, sf))
    e = K.build_sft_examples_long(convs, pairs, QWEN, max_len=MAX_LEN)
    return e.select("conv_id", K.ids_str("input_ids").alias("input_ids"), F.size("attention_mask").cast("int").alias("n_attention"))


@query("label_mask", FX.with_ctes(
    "SELECT conv_id, array_to_string(labels, ' ') AS labels FROM t6", *token_steps_sql(MAX_LEN)))
def label_mask(spark, sf):
    """K6: labels with the ignore index over source tokens."""
    return examples(spark, sf).select("conv_id", K.ids_str("labels").alias("labels"))


@query("drop_unlabelled", FX.with_ctes(
    "SELECT conv_id, CAST(len(labels) AS INTEGER) AS n_labels FROM t6 WHERE len(list_filter(labels, lambda x: x <> -100)) > 0",
    *token_steps_sql(MAX_LEN)))
def drop_unlabelled(spark, sf):
    """examples with at least one trainable label."""
    return K.drop_unlabelled(examples(spark, sf)).select("conv_id", F.size("labels").cast("int").alias("n_labels"))


@query("label_preview", FX.with_ctes(
    "SELECT conv_id, array_to_string(list_transform(labels, lambda x: CASE WHEN x = -100 THEN 0 ELSE x END), ' ') AS preview FROM t6",
    *token_steps_sql(MAX_LEN)))
def label_preview(spark, sf):
    """Labels with the ignore index shown as the pad id."""
    return examples(spark, sf).select("conv_id", K.ids_str(K.unmask_labels("labels")).alias("preview"))


@query("pad_batch", FX.with_ctes(
    f"""SELECT conv_id, batch, CAST(target AS INTEGER) AS padded_len, CAST(target - len(input_ids) AS INTEGER) AS n_pad
        FROM (SELECT conv_id, input_ids, batch, CAST(ceil(max(len(input_ids)) OVER (PARTITION BY batch) / 4.0) * 4 AS INTEGER) AS target
              FROM (SELECT conv_id, input_ids, CAST(floor({hash_unit_sql(0, 'conv_id')} * 4) AS INTEGER) AS batch FROM t6))""",
    *token_steps_sql(MAX_LEN)))
def pad_batch(spark, sf):
    """K8: pad each of 4 hash batches to its longest row rounded up to a multiple of 4."""
    e = examples(spark, sf).withColumn("batch", K.batch_of("conv_id", 4))
    p = K.pad_batch(e, "batch", 4)
    n_real = F.size(F.filter("attention_mask", lambda x: x == 1))
    return p.select("conv_id", "batch", F.size("input_ids").cast("int").alias("padded_len"),
                    (F.size("input_ids") - n_real).cast("int").alias("n_pad"))


PAIR_TOK_SQL = [FX.PREF_SQL, f"""ptok AS (
  SELECT conv_id, turn,
         list_concat([1], {TOK(TPL.render_prompt_sql("[{'query': question, 'answer': response_chosen}]", None, VICUNA))}) AS ids_c,
         list_concat([1], {TOK(TPL.render_prompt_sql("[{'query': question, 'answer': response_rejected}]", None, VICUNA))}) AS ids_r
  FROM pref)"""]


@FX.shared
def pair_tokens(spark, sf):
    return K.tokenize_pairs(P.to_pair_texts(FX.pref(spark, sf), VICUNA, keep=("conv_id", "turn")), keep=("conv_id", "turn"))


@query("pair_token_window", FX.with_ctes(
    """SELECT conv_id, turn, CAST(len(ids_c) AS INTEGER) AS n_chosen, CAST(len(ids_r) AS INTEGER) AS n_rejected FROM ptok
       WHERE len(ids_c) BETWEEN 1 AND 120 AND len(ids_r) BETWEEN 1 AND 120""", *PAIR_TOK_SQL))
def pair_token_window(spark, sf):
    """K7 + F4: tokenised pairs whose both sides have 1..120 tokens."""
    t = K.pair_token_window(pair_tokens(spark, sf), 120)
    return t.select("conv_id", "turn", F.size("input_ids_chosen").cast("int").alias("n_chosen"),
                    F.size("input_ids_rejected").cast("int").alias("n_rejected"))


@query("pad_to", FX.with_ctes(
    """SELECT conv_id, turn, CAST(greatest(len(ids_c), 160) AS INTEGER) AS len_chosen,
              CAST(greatest(len(ids_r), 160) AS INTEGER) AS len_rejected,
              CAST(greatest(160 - len(ids_c), 0) AS INTEGER) AS pad_chosen FROM ptok""", *PAIR_TOK_SQL))
def pad_to(spark, sf):
    """K8 fixed form: pad both sides to 160 tokens."""
    p = K.pad_to(pair_tokens(spark, sf), 160)
    zeros = F.size(F.filter("attention_mask_chosen", lambda x: x == 0))
    return p.select("conv_id", "turn", F.size("input_ids_chosen").cast("int").alias("len_chosen"),
                    F.size("input_ids_rejected").cast("int").alias("len_rejected"), zeros.cast("int").alias("pad_chosen"))


@query("pair_char_window", FX.with_ctes(
    f"""SELECT conv_id, turn FROM (
          SELECT conv_id, turn, {TPL.render_prompt_sql("[{'query': question, 'answer': ''}]", None, QWEN)} AS prompt,
                 response_chosen AS chosen, response_rejected AS rejected FROM pref)
        WHERE length(prompt || chosen) BETWEEN 1 AND 1000 AND length(prompt || rejected) BETWEEN 1 AND 1000""",
    FX.PREF_SQL))
def pair_char_window(spark, sf):
    """preference prompts whose prompt + response stays within 1000 characters on both sides."""
    p = P.to_preference_prompts(FX.pref(spark, sf), QWEN, keep=("conv_id", "turn"))
    return K.pair_char_window(p, 1000).select("conv_id", "turn")


# ---------- K1-K6 with a published vocabulary ----------
def _subword():
    """A sentencepiece vocabulary whose ids 1 and 2 are bos and eos; it ends every text with eos."""
    import public_tokenizers

    return K.subword_tokenizer(public_tokenizers.path("piece_bpe_32k.model"), add_eos=True)


def _subword_turns(spark, sf):
    ids = dialogs(spark, sf).select("conv_id", _subword().many("dialog").alias("_ids"))
    return ids.select("conv_id", K.turns_of_ids("_ids").alias("turns"))


def _there(module: str) -> bool:
    try:
        return importlib.util.find_spec(module) is not None
    except ImportError:
        return False


if _there("public_tokenizers") and _there("sentencepiece"):
    @query("token_counts_subword")
    def token_counts_subword(spark, sf):
        """K1 / U4: tokens of each dialog by a subword vocabulary."""
        return _turn_sizes(_subword_turns(spark, sf), "turns")

    @query("eos_strip_subword")
    def eos_strip_subword(spark, sf):
        """K3 where it bites: every target ends with the vocabulary's eos, which goes."""
        turns = _subword_turns(spark, sf)
        return _turn_sizes(turns.select("conv_id", F.transform("turns", lambda t: K.strip_eos(t["src"], t["tgt"])).alias("turns")), "turns")

    @query("label_mask_subword")
    def label_mask_subword(spark, sf):
        """K1-K6 by a subword vocabulary: ids and labels."""
        e = K.build_sft_examples(dialogs(spark, sf), "dialog", MAX_LEN, tok=_subword(), keep=("conv_id",))
        return e.select("conv_id", K.ids_str("input_ids").alias("input_ids"), K.ids_str("labels").alias("labels"))

    @query("label_mask_long_subword")
    def label_mask_long_subword(spark, sf):
        """The same from one row per turn."""
        convs, pairs = TU.normalize_dialog_long(FX.turns_long(spark, sf))
        e = K.build_sft_examples_long(convs, pairs, QWEN, max_len=MAX_LEN, tok=_subword())
        return e.select("conv_id", K.ids_str("input_ids").alias("input_ids"), K.ids_str("labels").alias("labels"))
