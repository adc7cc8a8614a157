import math
import os
import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, sentence, text_of  # noqa: E402

from alignfold.llm import gru_lm, queries  # noqa: E402


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [""]


def base(docs, learn):
    count = Counter(t for d, text in docs if learn(d) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    return n, {(str(d), text): (len(tokens(text)), sum(t in count for t in tokens(text)),
                                sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(text))) for d, text in docs}


@pytest.mark.parametrize("held", [gru_lm.HELD, 50])
def test_base_score_with_and_without_the_join(spark, monkeypatch, held):
    monkeypatch.setattr(gru_lm, "HELD", held)
    monkeypatch.setattr(gru_lm, "FREQUENT", 30)
    rows = awkward()
    docs = [(r[0], text_of(r)) for r in rows]
    n, want = base(docs, lambda d: d is not None and d % 3 != 0)
    got = gru_lm.score(frame(spark, rows, clashes=True), F.col("doc_id") % 3 != 0).collect()
    assert len(got) == len(rows)
    left = Counter((str(d), *want[str(d), t][:2], round(want[str(d), t][2], 6)) for d, t in docs)
    assert Counter((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == left
    assert {r.train_tokens for r in got} == {n} and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert all(r.held_out == (r.doc_id is None or r.doc_id % 3 == 0) for r in got)


def table(texts, frequent=20):
    count = Counter(t for x in texts for t in gru_lm.tokens(x))
    order = sorted(count, key=lambda w: (-count[w], w))
    frequent = min(frequent, len(order))
    ends = {w[-gru_lm.ENDING:]: 0 for w in order[frequent:]}
    ends = {e: i for i, e in enumerate(sorted(ends)[:3])}
    words = gru_lm.Words({w: i for i, w in enumerate(order)}, np.array([count[w] for w in order]), sum(count.values()),
                         len(count), np.unique(np.minimum([0, 1, 3, 8, frequent], frequent)), ends, np.ones(len(ends) + 1))
    mass = np.ones(len(ends) + 1)
    for w in order[frequent:]:
        mass[words.ending(w)] += count[w] + 1
    return gru_lm.Words(words.rank, words.count, words.total, words.types, words.bounds, ends, mass)


def test_probabilities_sum_to_one():
    rng = random.Random(3)
    words = table([sentence(rng, 40) for _ in range(30)])
    net = gru_lm.Network(words, hidden=6)
    net.flat += np.random.default_rng(1).standard_normal(len(net.flat)).astype(np.float32) * 0.3
    h = np.random.default_rng(2).standard_normal((1, 6)).astype(np.float32)
    order = list(words.rank)
    total = 0.0
    for i, w in enumerate(order):
        lp = net.log_probability(h, words.number[[i]])[0]
        total += math.exp(lp) * 10 ** words.inside[i]
    # each ending class also keeps one share for an unseen word
    for c in range(len(words.mass)):
        lp = net.log_probability(h, np.array([words.frequent + c]))[0]
        total += math.exp(lp) / words.mass[c]
    assert abs(total - 1) < 1e-4


def test_gradient_matches_differences():
    rng = random.Random(5)
    words = table([sentence(rng, 30) for _ in range(10)])
    net = gru_lm.Network(words, hidden=4)
    gen = np.random.default_rng(4)
    net.flat = net.flat + gen.standard_normal(len(net.flat)) * 0.3  # doubles
    net.p = net.views(net.flat)
    n = words.frequent + len(words.mass)
    before, want = gen.integers(0, n, (5, 3)), gen.integers(0, n, (5, 3))
    before[2, 1] = net.end
    h = gen.standard_normal((3, 4))
    grad = {k: v.copy() for k, v in net.views(net.gradient(before, want, h)[1]).items()}
    for k, v in net.p.items():
        for _ in range(4):
            at = tuple(gen.integers(0, s) for s in v.shape)
            keep = v[at]
            v[at] = keep + 1e-5
            up = net.gradient(before, want, h)[0]
            v[at] = keep - 1e-5
            down = net.gradient(before, want, h)[0]
            v[at] = keep
            assert abs((up - down) / 2e-5 - grad[k][at]) < 1e-4 * (1 + abs(grad[k][at])), k


def test_state_is_carried_over_windows_and_lanes_do_not_mix():
    rng = random.Random(6)
    texts = [sentence(rng, n) for n in (1, 31, 32, 33, 64, 200, 5)] + ["", "x"]
    words = table(texts)
    net = gru_lm.Network(words, hidden=5)
    documents = [words.numbers(gru_lm.tokens(t))[1] for t in texts]
    got = net.score(documents)
    gx = net.p["emb"] @ net.p["wx"] + net.p["b"]
    for number, score in zip(documents, got):
        h, last, total = np.zeros((1, 5), np.float32), net.end, 0.0
        for x in number:
            h, _ = net.step(gx[[last]], h)
            total += net.log_probability(h, np.array([x]))[0]
            last = x
        assert abs(total - score) < 1e-2


def test_training_learns_order():
    rng = random.Random(7)
    stream = []
    for _ in range(400):
        stream += ["red", "apple", "blue", "sky", "green", "leaf"] if rng.random() < 0.5 else ["blue", "sky", "red", "apple"]
    words = table([" ".join(stream)])
    net = gru_lm.Network(words, hidden=8)
    before = net.score([words.numbers(gru_lm.tokens(" ".join(stream)))[1]])[0]
    losses = net.train(np.tile(words.numbers(gru_lm.tokens(" ".join(stream)))[1], 4), epochs=60)
    after = net.score([words.numbers(gru_lm.tokens(" ".join(stream)))[1]])[0]
    assert losses[-1] < losses[0] and after > 0.6 * before


def test_every_training_row_moves_the_weights(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "TRAIN_TOKENS", 300)
    rng = random.Random(8)
    rows = [(i, sentence(rng, 100), "en", "a", 0) for i in range(400)]

    def weights(rows):
        df = frame(spark, rows)
        words = gru_lm.word_table(gru_lm.count_words(df))
        docs = df.select(F.col("doc_id").alias("id"), F.col("text").alias("whole"), F.lit(True).alias("learn"))
        return gru_lm.train(gru_lm.code(docs, words), words).flat

    first = weights(rows)
    assert np.allclose(first, weights(rows[::-1]), atol=1e-4)  # however the rows lie
    for i in (0, 111, 399):  # the same words in another order: the same counts
        other = " ".join(sorted(rows[i][1].split()))
        assert not np.allclose(first, weights([*rows[:i], (i, other, *rows[i][2:]), *rows[i + 1:]]), atol=1e-4), i


def test_every_token_is_learnt():
    rng = random.Random(9)
    words = table([sentence(rng, 90) for _ in range(9)])
    for n in (1, 2, 63, 64, 130, 131, 4095, 4097):
        net, seen = gru_lm.Network(words, hidden=3), []
        learn = net.gradient
        net.gradient = lambda before, want, h: (seen.append((before, want)), learn(before, want, h))[1]
        stream = np.arange(n) % words.frequent
        net.train(stream, epochs=1)
        pairs = Counter(p for b, w in seen for p in zip(b.ravel().tolist(), w.ravel().tolist()))
        assert set(pairs) == set(zip([net.end, *stream.tolist()], stream.tolist()))
        assert n <= sum(pairs.values()) < n + gru_lm.STREAMS


def test_a_long_text_is_scored_in_little_memory():
    """Beside the documents themselves a window of states is all that is held."""
    import tracemalloc
    rng = random.Random(2)
    words = table([sentence(rng, 90) for _ in range(9)], frequent=40)
    net = gru_lm.Network(words, hidden=8)
    gen = np.random.default_rng(1)
    documents = [gen.integers(0, words.frequent, n).astype(np.uint16) for n in [300_000, *[50] * 400]]
    tracemalloc.start()
    got = net.score(documents[1:])
    few = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    short = gru_lm.ROWS
    try:
        gru_lm.ROWS = 1 << 15
        tracemalloc.start()
        again = net.score([documents[0], *documents[1:]])
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    finally:
        gru_lm.ROWS = short
    assert np.allclose(again[1:], got, rtol=1e-4) and np.isfinite(again).all() and most < few + (120 << 20)


def test_copies_of_one_row_are_dealt_to_all_parts(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "TRAIN_TOKENS", 10)
    rng = random.Random(1)
    text = sentence(rng, 60)
    rows = [(1, text, "en", "a", 0)] * 150 + [(i, sentence(rng, 60), "en", "a", 0) for i in range(2, 302)]
    df = frame(spark, rows)
    words = gru_lm.word_table(gru_lm.count_words(df))
    docs = df.select(F.col("doc_id").alias("id"), F.col("text").alias("whole"), F.lit(True).alias("learn"))
    learnt = []
    real = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, n, *c: (learnt.append(
        [r["count"] for r in self.groupBy(*c).count().collect()]), real(self, n, *c))[1])
    gru_lm.train(gru_lm.code(docs, words), words)
    assert len(learnt) == gru_lm.ROUNDS and sum(map(sum, learnt)) == 450
    assert max(map(sum, learnt)) < 450 / 2  # the copies would all be in one of three rounds


def test_the_end_has_a_class_of_its_own_where_no_word_is_held(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "HELD", 5)
    rows = [(i, f"w{i} x{i} y{i}", "en", "a", 0) for i in range(3)]  # all counts but the end's are one
    words = gru_lm.word_table(gru_lm.count_words(frame(spark, rows)))
    assert words.end() not in {words.frequent + words.ending(f"{c}{i}".encode()) for c in "wxy" for i in range(3)}
    monkeypatch.setattr(gru_lm, "HELD", 0)
    words = gru_lm.word_table(gru_lm.count_words(frame(spark, rows)))
    assert words.frequent == 0 and words.end() not in {words.ending(f"{c}{i}".encode()) for c in "wxy" for i in range(3)}
    assert all(math.isfinite(r.score) for r in gru_lm.score(frame(spark, rows), F.lit(True)).collect())


def test_frequent_words_grow_with_the_vocabulary():
    assert gru_lm.frequent_words(1000) == gru_lm.FREQUENT
    assert gru_lm.frequent_words(100_000_000) == 40_000


def test_tokens_are_cut_as_bytes_are():
    rng = random.Random(4)
    some = [*map(chr, range(40)), *"AzÉ\x85\xa0  ßİK\x7f", "\U0001F600", *"  \n"]
    texts = ["", " ", "a", " a  B ", *("".join(rng.choices(some, k=rng.randint(0, 30))) for _ in range(3000))]
    got = gru_lm.split(pa.array(texts)).cast(pa.list_(pa.binary())).to_pylist()
    assert got == [[*t.encode().lower().split(), b""] for t in texts]


def large():
    """Words in classes of equal mass, as ``word_table`` makes them, and their shares."""
    count = (1e6 / np.arange(1, 4097)).astype(np.int64)
    share = np.cumsum(count) / count.sum()
    bounds = np.unique(np.concatenate([[0], np.searchsorted(share, np.arange(1, 64) / 64) + 1, [4096]]))
    endings = {b"%03d" % i: i for i in range(63)}
    words = gru_lm.Words({b"w%d" % i: i for i in range(4096)}, count, int(count.sum()), 4096, bounds, endings, np.full(64, 1e5))
    return words, count / count.sum()


def test_a_token_passes_few_logits(monkeypatch):
    """128 classes and some 64 words of a class were each token's logits."""
    words, share = large()
    net, real, sizes = gru_lm.Network(words), np.exp, []
    number = np.random.default_rng(3).choice(4096, (16, 64), p=share)
    monkeypatch.setattr(np, "exp", lambda x, **more: (sizes.append(x.size), real(x, **more))[1])
    net.gradient(np.roll(number, 1, 0), number, np.zeros((64, net.hidden), np.float32))
    assert 0 < sum(sizes) < 100 * number.size
    sizes.clear()
    net.log_probability(np.zeros((number.size, net.hidden), np.float32), number.ravel())
    assert 0 < sum(sizes) < 100 * number.size


def test_large_logits_change_no_probability():
    words, share = large()
    net, gen = gru_lm.Network(words), np.random.default_rng(5)
    net.p["out"][:, :-1] = gen.standard_normal(net.p["out"][:, :-1].shape)
    number, h = gen.choice(4096, 300, p=share), gen.uniform(-1, 1, (300, net.hidden)).astype(np.float32)
    assert net.safe(h)
    want = net.log_probability(h, number)
    net.p["out"][:, -1] += 200  # of every output, so of none
    assert not net.safe(h) and np.allclose(net.log_probability(h, number), want, atol=1e-3)


def test_empty_and_nothing_to_learn(spark):
    assert gru_lm.score(empty(spark), F.lit(True)).count() == 0
    got = gru_lm.score(frame(spark, awkward()[:6]), F.lit(False)).collect()
    assert len(got) == 6 and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_query(spark, sf_dir):
    import zlib

    import duckdb
    docs = [(d, t or "") for d, t in duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()]
    n, want = base(docs, lambda d: zlib.crc32(str(d).encode()) % 7 != 2)
    texts = dict(docs)
    got = queries.op8_gru_lm(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        size, known, score = want[str(r.doc_id), texts[r.doc_id]]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (size, known, n) and abs(r.base_score - score) < 1e-6 * abs(score)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
