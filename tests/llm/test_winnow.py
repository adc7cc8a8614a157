import hashlib
import os
import random
import sys

import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, sentence, text_of  # noqa: E402

from alignfold.llm import queries, winnow  # noqa: E402

K, W = winnow.GRAM, winnow.WINDOW


def brute(text):
    """[(hash, place)]: the rightmost least hash of each window of W grams, each place once."""
    if not text:
        return []
    grams = [text[i:i + K] for i in range(max(len(text) - K + 1, 1))]
    h = [(xxhash.xxh64_intdigest(g.encode("utf-32-be"), 42) & winnow.HASH_BITS) >> 8 for g in grams]
    out = []
    for i in range(max(len(h) - W + 1, 1)):
        window = h[i:i + W]
        low = min(window)
        at = i + max(j for j, x in enumerate(window) if x == low)
        if not out or out[-1][1] != at:
            out.append((low, at))
    return out


def kept(text):
    return list(dict.fromkeys(h & 0x7FFFFFFF for h, _ in brute(text)))


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(docs):
    """[(id, results)] by the definition: docs are (id, text); every row is a document."""
    order = sorted(((d, t or "") for d, t in docs), key=lambda x: (x[0] is not None, x[0] or 0, signed_hash(x[1])))
    out = []
    for i, (doc, text) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + nxt[:q]
        out.append((doc, (len(text), kept(text), edited, kept(edited), kept(nxt))))
    return out


def results(df):
    return sorted(((r.doc_id, (r.n_chars, r.hashes, r.edited, r.edited_hashes, r.next_hashes)) for r in df.collect()), key=repr)


def signed_hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >> 63 else h


def test_prints_and_places(spark):
    rng = random.Random(6)
    rows = awkward() + [(900 + n, sentence(rng, 60)[:n], "en", "a", n) for n in (1, 15, 16, 17, 46, 47, 48, 223, 224, 225, 270, 271, 272, 300)]
    got = winnow.fingerprint(frame(spark, rows, clashes=True)).collect()
    for r in got:
        assert [(p.hash, p.pos) for p in r.prints] == brute(r.text or "")


def test_repeated_text_takes_the_rightmost(spark):
    rows = [(1, "ab" * 400, "en", "a", 0), (2, "a" * 500, "en", "a", 0)]
    for r in winnow.fingerprint(frame(spark, rows)).collect():
        assert [(p.hash, p.pos) for p in r.prints] == brute(r.text)


def test_match_guarantee(spark):
    rng = random.Random(7)
    shared = sentence(rng, 40)[:K + W - 1]
    rows = [(i, sentence(rng, 50) + shared + sentence(rng, 50), "en", "a", 0) for i in range(8)]
    sets = [{p.hash for p in r.prints} for r in winnow.fingerprint(frame(spark, rows)).collect()]
    assert all(sets[0] & s for s in sets)


def test_neighbours(spark):
    rows = awkward()
    assert results(winnow.neighbours(frame(spark, rows, clashes=True))) == sorted(expected([r[:2] for r in rows]), key=repr)


@pytest.mark.parametrize("rows", [[(1, "alone in the world, nothing else", "en", "a", 0)], [(1, None, "en", "a", 0)],
                                  [(1, "", "en", "a", 0), (2, "x" * 300, "en", "a", 0)]])
def test_few_documents(spark, rows):
    assert results(winnow.neighbours(frame(spark, rows))) == sorted(expected([r[:2] for r in rows]), key=repr)


def test_empty(spark):
    assert winnow.neighbours(empty(spark)).count() == 0 and winnow.fingerprint(empty(spark)).count() == 0


def test_query(spark, sf_dir):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    want = dict(expected(docs))
    texts = dict(docs)
    prints = {}
    got = queries.op7_fingerprints(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        n, own, edited, changed, nxt = want[r.doc_id]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{x:08x}" for x in own)
        assert r.edited_fingerprint == "".join(f"{x:08x}" for x in changed)
        assert abs(r.near_edited - jaccard(own, changed)) < 1e-12 and abs(r.near_next - jaccard(own, nxt)) < 1e-12
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_plan_holds_no_python(spark, sf_dir):
    plan = queries.op7_fingerprints(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
