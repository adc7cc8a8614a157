"""Token-array operators.

Everything is an array expression on one row (one conversation or one pair):
truncation, eos handling, the turn budget, packing and label masks need no
shuffle. The tokenizer is pluggable (``tok: Column -> array<int>``); the built-in
default is a deterministic whitespace + md5 tokenizer so plans are testable
offline and reproducible in any engine. A subword tokenizer plugs in as an
Arrow UDF (``pandas_tokenizer``), loaded once per task.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.rows import join_hot, keep_rows  # noqa: F401  (re-exported)
from alignfold.functions.text import PY_WHITESPACE, col_of, hash_unit

PAD_ID, BOS_ID, EOS_ID, IGNORE_INDEX = 0, 1, 2, -100
VOCAB = 32000
WS_CLASS = "[" + PY_WHITESPACE + "]+"
ARR_I = T.ArrayType(T.IntegerType())
TEXT_AT_ONCE = 1 << 20  # bytes of the texts whose ids are Python's at one time
ROWS_OUT = 16 << 20  # bytes of the texts of the rows that are given back together
Tokenizer = Callable[[Column], Column]


# ---------- K1 / U4 ----------
def whitespace_tokenize(c) -> Column:
    """Default tokenizer: Python ``str.split()`` pieces, id = 3 + md5(piece)[:7] mod VOCAB."""
    pieces = F.filter(F.split(F.coalesce(col_of(c), F.lit("")), WS_CLASS), lambda x: x != "")
    return F.transform(pieces, lambda t: (F.conv(F.substring(F.md5(t), 1, 7), 16, 10).cast("long") % VOCAB + 3).cast("int"))


def whitespace_tokenize_sql(expr: str) -> str:
    return (f"list_transform(list_filter(regexp_split_to_array(coalesce({expr}, ''), '{WS_CLASS}'), lambda x: x <> ''), "
            f"lambda t: CAST(CAST(('0x' || substr(md5(t), 1, 7)) AS BIGINT) % {VOCAB} + 3 AS INTEGER))")


def runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of consecutive items that are together of at most ``most``, or one item."""
    upto = np.concatenate([[0], np.cumsum(sizes)])
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + most, side="right")) - 1)
        yield a, b
        a = b


def text_sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text, and some for itself."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64


def ids_of(texts: pa.Array, encode: Callable) -> pa.Array:
    """The ids of each text (null: empty) as numbers of 4 bytes; those of TEXT_AT_ONCE are Python's at one time."""
    kind = pa.list_(pa.int32())
    parts = [pa.array(encode(pc.fill_null(texts.slice(a, b - a), "").to_pylist()), kind) for a, b in runs(text_sizes(texts), TEXT_AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def pandas_tokenizer(encode: Callable) -> Tokenizer:
    """U4: wrap ``encode(list[str]) -> list[list[int]]`` (e.g. a subword tokenizer) as an Arrow-batched UDF."""
    from pyspark.sql import SparkSession

    from alignfold.session import ship_package

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    @F.arrow_udf(ARR_I)
    def _tok(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for a, b in runs(text_sizes(texts), ROWS_OUT):
                yield ids_of(texts.slice(a, b - a), encode)

    return lambda c: _tok(col_of(c))


_LOADED: dict = {}


def vocabulary(path: str) -> Callable[[list[str], bool], list[list[int]]]:
    """(texts, whether each gets the end of sequence) -> ids, by a published subword vocabulary: a sentencepiece
    model or a tokenizers JSON file. Loaded once a worker; special tokens in a text are ordinary text."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts, end: model.encode(texts, add_eos=end, num_threads=1)
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            library.no_truncation()
            library.no_padding()
            _LOADED[path] = lambda texts, end: [e.ids + [EOS_ID] * end for e in library.encode_batch(texts, add_special_tokens=False)]
    return _LOADED[path]


def subword_tokenizer(path: str, add_eos: bool = False) -> Tokenizer:
    """U4 with the vocabulary at ``path`` (a path that every worker can read). ``.many`` takes a column of text
    arrays to arrays of ids in one call, as Python cannot run inside a higher-order function."""
    one = pandas_tokenizer(lambda texts: vocabulary(path)(texts, add_eos))

    @F.arrow_udf(T.ArrayType(ARR_I))
    def many(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            n = pc.fill_null(rows.value_lengths(), 0).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(n)])
            texts = rows.flatten()
            size = np.concatenate([[0], np.cumsum(text_sizes(texts))])[upto]
            for a, b in runs(np.diff(size) + 64, ROWS_OUT):
                ids = ids_of(texts.slice(upto[a], upto[b] - upto[a]), lambda t: vocabulary(path)(t, add_eos))
                yield pa.ListArray.from_arrays(pa.array(upto[a:b + 1] - upto[a], pa.int32()), ids)

    one.many = lambda c: many(col_of(c))
    return one


def turns_of_ids(ids, bos: int | None = BOS_ID) -> Column:
    """K1 from the ids of [q0, a0, q1, a1, ...]: array<struct<src, tgt>>; bos on the first query only."""
    c = col_of(ids)
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.floor(F.size(c) / 2).cast("int") - 1, F.lit(0))), lambda i: i < F.floor(F.size(c) / 2))
    head = F.array(F.lit(bos)) if bos is not None else F.array().cast(ARR_I)
    return F.transform(places, lambda i: F.struct(
        F.concat(F.when(i == 0, head).otherwise(F.array().cast(ARR_I)), F.try_element_at(c, i * 2 + 1)).alias("src"),
        F.try_element_at(c, i * 2 + 2).alias("tgt")))


def tokenize_dialog(dialog, tok: Tokenizer = whitespace_tokenize, bos: int | None = BOS_ID) -> Column:
    """K1: [q0, a0, q1, a1, ...] -> array<struct<src, tgt>>; special tokens (bos) on the first query only."""
    d = col_of(dialog)
    n = F.floor(F.size(d) / 2).cast("int")
    idx = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i < n)

    def turn(i):
        src = tok(F.try_element_at(d, i * 2 + 1))  # referenced once: lambdas share no subexpressions
        if bos is not None:
            src = F.concat(F.when(i == 0, F.array(F.lit(bos))).otherwise(F.array().cast(ARR_I)), src)
        return F.struct(src.alias("src"), tok(F.try_element_at(d, i * 2 + 2)).alias("tgt"))
    return F.transform(idx, turn)


# ---------- K2 / K3 ----------
def truncate_turn(src, tgt, max_len: int) -> Column:
    """K2: source / target budgets by their share of the turn, floor in double.

    max_target = 0 drops one target token (slice to -1), a fitting turn still loses
    one target token to make room for eos; a turn with no tokens at all is handled
    by the caller (quarantine).
    """
    s, t = col_of(src), col_of(tgt)
    ns, nt = F.size(s), F.size(t)
    total = (ns + nt).cast("double")
    ms = F.floor(F.lit(float(max_len)) * F.try_divide(ns.cast("double"), total)).cast("int")
    mt = F.floor(F.lit(float(max_len)) * F.try_divide(nt.cast("double"), total)).cast("int")
    new_s = F.when(ns > ms, F.slice(s, 1, ms)).otherwise(s)
    keep_t = F.when(mt == 0, F.greatest(nt - 1, F.lit(0))).otherwise(F.least(nt, mt - 1))
    new_t = F.when(nt > mt - 1, F.slice(t, 1, keep_t)).otherwise(t)
    return F.struct(new_s.alias("src"), new_t.alias("tgt"))


def strip_eos(src, tgt, eos: int = EOS_ID) -> Column:
    """K3: drop one leading eos of the source and one trailing eos of the target."""
    s, t = col_of(src), col_of(tgt)
    new_s = F.when((F.size(s) > 0) & (F.try_element_at(s, F.lit(1)) == eos), F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(s)
    new_t = F.when((F.size(t) > 0) & (F.try_element_at(t, F.lit(-1)) == eos), F.slice(t, 1, F.size(t) - 1)).otherwise(t)
    return F.struct(new_s.alias("src"), new_t.alias("tgt"))


# ---------- K4 ----------
def turn_budget(turns, max_len: int) -> Column:
    """K4: keep turns while the running total of (src + tgt + 1 eos) stays <= max_len; a dropped turn
    also drops every later turn. One left fold over the turns (each turn is read once)."""
    ts = col_of(turns)
    init = F.struct(F.lit(0).alias("total"), F.lit(True).alias("open"), F.slice(ts, 1, 0).alias("kept"))

    def step(acc, t):
        cost = F.size(t["src"]) + F.size(t["tgt"]) + 1
        ok = acc["open"] & (acc["total"] + cost <= max_len)
        return F.struct(F.when(ok, acc["total"] + cost).otherwise(acc["total"]).alias("total"), ok.alias("open"),
                        F.when(ok, F.concat(acc["kept"], F.array(t))).otherwise(acc["kept"]).alias("kept"))
    return F.aggregate(ts, init, step, lambda acc: acc["kept"])


# ---------- K5 / K6 ----------
def packed_ids(turns, eos: int = EOS_ID) -> Column:
    """K5: concat of src + tgt + eos per turn."""
    return F.flatten(F.transform(col_of(turns), lambda t: F.concat(t["src"], t["tgt"], F.array(F.lit(eos))))).cast(ARR_I)


def packed_labels(turns, eos: int = EOS_ID, train_on_inputs: bool = False) -> Column:
    """K6: the ignore index over source tokens (unless train_on_inputs), then target + eos."""
    if train_on_inputs:
        return packed_ids(turns, eos)
    return F.flatten(F.transform(col_of(turns), lambda t: F.concat(
        F.array_repeat(F.lit(IGNORE_INDEX), F.size(t["src"])), t["tgt"], F.array(F.lit(eos))))).cast(ARR_I)


def pack_turns(turns, eos: int = EOS_ID, train_on_inputs: bool = False) -> Column:
    """K5 + K6 as one struct (input_ids, attention_mask of ones, labels)."""
    ids = packed_ids(turns, eos)
    return F.struct(ids.alias("input_ids"), F.array_repeat(F.lit(1), F.size(ids)).cast(ARR_I).alias("attention_mask"),
                    packed_labels(turns, eos, train_on_inputs).alias("labels"))


def build_sft_examples(df: DataFrame, dialog: str = "dialog", max_len: int = 512, tok: Tokenizer = whitespace_tokenize,
                       eos: int = EOS_ID, train_on_inputs: bool = False, keep=()) -> DataFrame:
    """K1-K6 over rendered dialogs; rows whose turn has no tokens on either side are quarantined (dropped).

    Each stage is its own projection over a materialised column: expressions inside
    higher-order functions are not shared, so chaining them unmaterialised would
    re-run the tokenizer once per reference.
    """
    k = list(keep)
    if hasattr(tok, "many"):
        turns = df.select(*k, tok.many(dialog).alias("_ids")).select(*k, turns_of_ids("_ids").alias("_t"))
    else:
        turns = df.select(*k, tokenize_dialog(dialog, tok).alias("_t"))
    out = quarantine_empty_turns(turns, "_t")
    out = out.select(*k, F.transform("_t", lambda t: truncate_turn(t["src"], t["tgt"], max_len)).alias("_t"))
    out = out.select(*k, F.transform("_t", lambda t: strip_eos(t["src"], t["tgt"], eos)).alias("_t"))
    out = out.select(*k, turn_budget("_t", max_len).alias("_t"))
    out = out.select(*k, packed_ids("_t", eos).alias("input_ids"), packed_labels("_t", eos, train_on_inputs).alias("labels"))
    return out.select(*k, "input_ids", F.array_repeat(F.lit(1), F.size("input_ids")).cast(ARR_I).alias("attention_mask"),
                      "labels")


def quarantine_empty_turns(df: DataFrame, turns: str) -> DataFrame:
    """Drop rows with a turn that has no tokens on either side (the truncation share would divide by zero)."""
    return keep_rows(df, F.forall(turns, lambda t: (F.size(t["src"]) + F.size(t["tgt"])) > 0))


def build_sft_examples_long(convs: DataFrame, pairs: DataFrame, template, key: str = "conv_id", max_len: int = 512,
                            tok: Tokenizer = whitespace_tokenize, eos: int = EOS_ID, bos: int | None = BOS_ID,
                            train_on_inputs: bool = False) -> DataFrame:
    """K1-K6 from the long form of ``normalize_dialog_long``: one row per turn pair.

    Rendering, tokenising, truncation and eos handling are per row. A kept turn takes at least one of the
    ``max_len`` tokens, so only the first ``max_len`` turns of a conversation can be kept, and these, at most
    ``max_len`` tokens each, are all that one aggregate brings together; of later turns it takes only
    whether they are empty. No text is shuffled. Conversations with a turn that has no tokens are
    quarantined, as in the record form.
    """
    from alignfold.operators.templates import _parts

    t_sys, pre, suf, sep = _parts(template)
    sys = F.coalesce(F.nullif(F.col("system"), F.lit("")), t_sys)
    sys_sep = F.when(F.coalesce(sys, F.lit("")) != "", F.concat(sys, sep)).otherwise(F.lit(""))
    k0 = F.col("k") == 0
    src = tok(F.concat(F.when(k0, sys_sep).otherwise(sep), pre, F.coalesce(F.col("query"), F.lit("")), suf))
    if bos is not None:
        src = F.concat(F.when(k0, F.array(F.lit(bos))).otherwise(F.array().cast(ARR_I)), src)
    rows = pairs.select(key, "k", src.alias("_src"), tok(F.coalesce(F.col("answer"), F.lit(""))).alias("_tgt"))
    rows = rows.select(key, "k", (F.size("_src") + F.size("_tgt") == 0).alias("_empty"), truncate_turn("_src", "_tgt", max_len).alias("_t"))
    rows = rows.select(key, "k", "_empty", strip_eos(F.col("_t")["src"], F.col("_t")["tgt"], eos).alias("_t"))
    turn = F.when(F.col("k") < max_len, F.struct("k", "_t"))
    found = rows.groupBy(key).agg(F.max("_empty").alias("_empty"), F.collect_list(turn).alias("_ts"))
    found = found.select(key, "_empty", turn_budget(F.transform(F.array_sort("_ts"), lambda x: x["_t"]), max_len).alias("_ts"))
    packed = found.select(key, "_empty", packed_ids("_ts", eos).alias("input_ids"), packed_labels("_ts", eos, train_on_inputs).alias("labels"))
    # conversations without pairs have no tokens
    bare = convs.filter(F.col("n_pairs") == 0).select(key, F.array().cast(ARR_I).alias("input_ids"), F.array().cast(ARR_I).alias("labels"))
    out = packed.filter(~F.col("_empty")).drop("_empty").unionByName(bare)
    return out.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")).cast(ARR_I))


# ---------- F5 / P18 ----------
def drop_unlabelled(df: DataFrame, labels: str = "labels") -> DataFrame:
    """drop examples whose labels are all the ignore index (empty ones included)."""
    return keep_rows(df, F.exists(labels, lambda x: x != IGNORE_INDEX))


def unmask_labels(labels, pad_id: int = PAD_ID) -> Column:
    """Show labels with the ignore index replaced by the pad id."""
    return F.transform(col_of(labels), lambda x: F.when(x == IGNORE_INDEX, F.lit(pad_id)).otherwise(x))


# ---------- K7 / F3 / F4 ----------
def tokenize_pairs(df: DataFrame, tok: Tokenizer = whitespace_tokenize, bos: int | None = BOS_ID,
                   chosen: str = "text_chosen", rejected: str = "text_rejected", keep=()) -> DataFrame:
    """K7: whole-text tokenisation of both rendered sides with masks."""
    def t(c):
        ids = tok(c)
        return F.concat(F.array(F.lit(bos)), ids) if bos is not None else ids
    out = df.select(*keep, t(chosen).alias("input_ids_chosen"), t(rejected).alias("input_ids_rejected"))
    return out.withColumns({
        "attention_mask_chosen": F.array_repeat(F.lit(1), F.size("input_ids_chosen")),
        "attention_mask_rejected": F.array_repeat(F.lit(1), F.size("input_ids_rejected"))})


def pair_char_window(df: DataFrame, max_len: int, prompt="prompt", chosen="chosen", rejected="rejected") -> DataFrame:
    """0 < len(prompt + chosen) <= max_len and the same for rejected (code points)."""
    lc = F.length(F.concat(F.col(prompt), F.col(chosen)))
    lr = F.length(F.concat(F.col(prompt), F.col(rejected)))
    return keep_rows(df, (lc > 0) & (lc <= max_len) & (lr > 0) & (lr <= max_len))


def pair_token_window(df: DataFrame, max_len: int) -> DataFrame:
    """both token arrays non-empty and at most max_len long."""
    a, b = F.size("input_ids_chosen"), F.size("input_ids_rejected")
    return keep_rows(df, (a > 0) & (a <= max_len) & (b > 0) & (b <= max_len))


# ---------- K8 ----------
def pad_arrays(c, target, value: int) -> Column:
    c = col_of(c)
    return F.concat(c, F.array_repeat(F.lit(value), F.greatest(target - F.size(c), F.lit(0))))


def pad_batch(df: DataFrame, batch_key: str, multiple: int = 4, pad_id: int = PAD_ID) -> DataFrame:
    """Pad each batch to its longest row rounded up to a multiple: ids with pad, mask with 0, labels with -100.

    Rows are written once to the shared checkpoint folder, so that their tokens are not made again for the
    lengths. The longest row of a batch comes from an aggregate over lengths, joined back with the rows of
    a hot batch spread.
    """
    from alignfold.session import cut_lineage

    rows = cut_lineage(df)
    mx = rows.groupBy(batch_key).agg(F.max(F.size("input_ids")).alias("_mx"), F.count(F.lit(1)).alias("_n"))
    j = join_hot(rows, mx, [batch_key], "_n").withColumn("_target", (F.ceil(F.col("_mx") / multiple) * multiple).cast("int"))
    return j.withColumns({
        "input_ids": pad_arrays("input_ids", F.col("_target"), pad_id),
        "attention_mask": pad_arrays("attention_mask", F.col("_target"), 0),
        "labels": pad_arrays("labels", F.col("_target"), IGNORE_INDEX),
    }).drop("_mx", "_target")


def pad_to(df: DataFrame, n: int, cols=("input_ids_chosen", "input_ids_rejected"), pad_id: int = PAD_ID,
           masks=("attention_mask_chosen", "attention_mask_rejected")) -> DataFrame:
    """Pad to a fixed length n (rows longer than n are left as they are; F4 removes them)."""
    out = df
    for c in cols:
        out = out.withColumn(c, pad_arrays(c, F.lit(n), pad_id))
    for m in masks:
        if m in df.columns:
            out = out.withColumn(m, pad_arrays(m, F.lit(n), 0))
    return out


def batch_of(key, n_batches: int, seed: int = 0) -> Column:
    """Deterministic batch assignment from the seeded md5 of a key."""
    return F.floor(hash_unit(seed, key) * n_batches).cast("int")


def ids_str(c) -> Column:
    """Space-joined ids (for display and cross-engine comparison)."""
    return F.array_join(F.transform(col_of(c), lambda x: x.cast("string")), " ")
