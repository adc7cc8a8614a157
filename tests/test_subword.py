"""The token chain with a published vocabulary against plain Python over the rendered dialogs."""

import math

import pytest

from alignfold.plans import q_tokens as Q
from alignfold.plans.registry import QUERIES, load_all

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
load_all()
BOS, EOS, IGNORE = 1, 2, -100


def turns_of(dialog, model):
    ids = model.encode(list(dialog), add_eos=True)
    return [([BOS] * (i == 0) + ids[i], ids[i + 1]) for i in range(0, len(ids) - 1, 2)]


def examples(turns, max_len):
    """(ids, labels) of one conversation, step by step; None where a turn has no tokens."""
    total, out, labels = 0, [], []
    if any(len(s) + len(t) == 0 for s, t in turns):
        return None
    for src, tgt in turns:
        n = len(src) + len(tgt)
        ms, mt = math.floor(float(max_len) * (len(src) / n)), math.floor(float(max_len) * (len(tgt) / n))
        src = src[:ms] if len(src) > ms else src
        if len(tgt) > mt - 1:
            tgt = tgt[:-1] if mt == 0 else tgt[:mt - 1]
        src = src[1:] if src and src[0] == EOS else src
        tgt = tgt[:-1] if tgt and tgt[-1] == EOS else tgt
        if total + len(src) + len(tgt) + 1 > max_len:
            break
        total += len(src) + len(tgt) + 1
        out += src + tgt + [EOS]
        labels += [IGNORE] * len(src) + tgt + [EOS]
    return out, labels


@pytest.fixture(scope="module")
def dialogs(spark, sf_dir):
    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    assert (model.bos_id(), model.eos_id()) == (BOS, EOS)
    return {r.conv_id: turns_of(r.dialog, model) for r in Q.dialogs(spark, sf_dir).collect()}


def test_ids_and_labels(spark, sf_dir, dialogs):
    want = {c: examples(t, Q.MAX_LEN) for c, t in dialogs.items()}
    want = {(c, *(" ".join(map(str, x)) for x in e)) for c, e in want.items() if e is not None}
    for name in ("label_mask_subword", "label_mask_long_subword"):
        got = QUERIES[name](spark, sf_dir).select("conv_id", "input_ids", "labels").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) > 20, name


def test_counts_and_stripped_eos(spark, sf_dir, dialogs):
    def sizes(name):
        rows = QUERIES[name](spark, sf_dir).collect()
        cols = [c for c in rows[0].asDict() if c != "conv_id"]
        return cols, sorted(tuple(r) for r in rows)

    cols, whole = sizes("token_counts_subword")
    _, stripped = sizes("eos_strip_subword")
    assert len(whole) == len(stripped) == sum(map(len, dialogs.values()))
    at = [i for i, c in enumerate(whole[0]) if isinstance(c, int)]
    flat = sorted((c, k, len(s), len(t)) for c, turns in dialogs.items() for k, (s, t) in enumerate(turns))
    assert sorted(sum(r[i] for i in at[-2:]) for r in whole) == sorted(s + t for _, _, s, t in flat)
    # each target ended with eos, and so loses one token
    assert sorted(sum(r[i] for i in at[-2:]) for r in stripped) == sorted(s + t - 1 for _, _, s, t in flat)
    assert cols
