import os
import random
import sys
from itertools import combinations

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, text_of  # noqa: E402

from alignfold.llm import queries, simhash  # noqa: E402


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, distance=3):
    """{fingerprint: smallest fingerprint reachable}"""
    left, out = sorted(set(prints)), {}
    while left:
        seed = left.pop(0)
        group, todo = {seed}, [seed]
        while todo:
            x = todo.pop()
            near = [y for y in left if bin(x ^ y).count("1") <= distance]
            left = [y for y in left if y not in near]
            group.update(near)
            todo += near
        out.update(dict.fromkeys(group, min(group)))
    return out


def brute(rows):
    prints = [brute_fingerprint(text_of(r)) for r in rows]
    comp = brute_components(prints)
    first = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            first[comp[p]] = min(first.get(comp[p], r[0]), r[0])
    return sorted(((str(r[0]), f"{p:016x}", first.get(comp[p])) for r, p in zip(rows, prints)), key=repr)


def test_whole_operator(spark):
    rows = awkward()
    rng = random.Random(2)
    base = rows[8][1].split()
    for i in range(120):  # a large group of near copies with different fingerprints
        words = list(base[:600])
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        rows.append((300 + i, " ".join(words), "en", "a", 0))
    df = simhash.near_duplicates(frame(spark, rows, clashes=True))
    got = sorted(((str(r.doc_id), f"{r.fp & (2**64 - 1):016x}", r.component_id) for r in df.collect()), key=repr)
    assert got == brute(rows)


def test_links_of_random_and_near_values(spark):
    rng = random.Random(9)
    values = {rng.getrandbits(64) for _ in range(300)}
    for v in list(values)[:60]:
        for _ in range(4):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    centre = rng.getrandbits(64)
    values |= {centre ^ sum(1 << b for b in rng.sample(range(9), rng.randint(0, 6))) for _ in range(200)}
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    for distance in (0, 1, 2, 3, 4):
        want = {tuple(sorted((simhash.signed(a), simhash.signed(b)))) for a, b in combinations(values, 2)
                if bin(a ^ b).count("1") <= distance}
        got = [tuple(r) for r in simhash.links(df, distance, block=7).collect()] if distance else []
        assert len(got) == len(set(got)) and set(got) == (want if distance else set())


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 130)), [200, 201]]


def test_allocation_is_the_cheapest():
    cost = [{-1: 0.0, 0: 5.0, 1: 9.0}, {-1: 0.0, 0: 2.0, 1: 30.0}, {-1: 0.0, 0: 4.0, 1: 6.0}]
    for budget in (-3, -1, 0, 1, 3):
        best = min((sum(c[t] for c, t in zip(cost, ts)), ts) for ts in
                   [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)] if sum(ts) == budget)
        got, plan = simhash.allocate(cost, budget)
        assert got == best[0] and sum(plan) == budget


def test_correlated_bits_stand_together():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (4000, 64))
    x[:, 40] = x[:, 3]
    x[:, 50] = x[:, 3]
    groups = simhash.group_bits(len(x), x.T @ x.astype(float), 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any({3, 40, 50} <= set(g) for g in groups)


def test_empty(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_query(spark, sf_dir):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    got = sorted(((str(r.doc_id), r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, sf_dir).collect()), key=repr)
    assert got == brute(docs)


@pytest.mark.parametrize("text", ["", "a", "A b", "a  B\tc", "Éa b c d É"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)
