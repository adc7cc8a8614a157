import os
import random
import sys

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, text_of  # noqa: E402

from alignfold.llm import periods, queries  # noqa: E402


def brute(words, least=24, times=3):
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(least, times * q) and not any(
                    all(words[t] == words[t - p] for t in range(start + p, start + length)) for p in range(1, q)):
                out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts, **kw):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in periods.find_runs(np.array([w for t in texts for w in t], np.int64), first, **kw))):
        got[text].append(tuple(run))
    return got


def planted(rng):
    n = rng.randint(0, 200)
    words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 30:
            start, period = rng.randrange(n - 20), rng.randint(1, 40)
            for i in range(start + period, rng.randint(start, n)):
                words[i] = words[i - period]
    return words


def test_equal_to_all_lags():
    rng = random.Random(9)
    texts = [planted(rng) for _ in range(2500)]
    got = found(texts)
    assert got == [brute(t) for t in texts] and sum(map(len, got)) > 500
    assert found(texts, min_words=5, min_periods=4) == [brute(t, 5, 4) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90), st.integers(1, 12), st.integers(2, 9))
def test_repeated_blocks(noise, period, times):
    words = noise + (noise[:period] or [1]) * times + noise[::-1]
    assert found([words], min_words=6) == [brute(words, 6)]


def test_linear_on_one_repeated_word():
    (runs,) = found([[7] * 300_000 + [8] + [7, 9] * 100_000])
    assert runs == [(0, 300_000, 1), (300_001, 200_000, 2)]


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_awkward_rows(spark):
    rows = awkward() + [(20, " \x0b".join(["tick", "tock"] * 4000) + " end\x1c\xa0here", "en", "a", 0), (21, "la " * 23, "en", "a", 0),
                        (22, "la " * 24, "en", "a", 0), (23, "é ü " * 30 + "x", "fr", "a", 0)]
    got = periods.periodic_runs(frame(spark, rows, clashes=True)).collect()
    want = []
    for r in rows:
        words = words_of(text_of(r))
        runs = brute(words) if len(words) < 2000 else [(0, 8000, 2)] if r[0] == 20 else []
        want.append((str(r[0]), len(words), runs, collapsed(words, runs)))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)


def test_empty(spark):
    assert periods.periodic_runs(empty(spark)).count() == 0


def test_words_of_batches():
    texts = ["", " \t\n", "a  b\x0bc\x0cd\re ", "\xa0x  y\x1cz\x85q", "é"]
    words, first = periods.split_words(pa.array(texts))
    assert [words.to_pylist()[a:b] for a, b in zip(first, first[1:])] == [words_of(t) for t in texts]


def test_planted_copies_follow_the_id():
    import zlib
    ids = [None, *range(60)]
    sizes = [len(str(i)) * 20 for i in ids]
    first = np.concatenate([[0], np.cumsum(sizes)])
    source = queries.planted_copies(pa.array(ids, pa.int64()), first)
    for doc, begin, n in zip(ids, first.tolist(), sizes):
        h = zlib.crc32(b"" if doc is None else str(doc).encode())
        g = h // 10
        for i in range(n):
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            assert source[begin + i] == begin + (a + (i - a) % p if h % 10 == 0 and i >= a else i)
