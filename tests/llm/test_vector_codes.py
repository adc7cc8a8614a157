import hashlib
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from corpus import CLASHES  # noqa: E402

from alignfold.llm import vector_codes as V  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Lloyd's rounds by all distances: (id, code, error) of each kept row, and the digest of the codebooks."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([np.array(r[1], np.float32) for r in kept]).astype(float) * 1024).astype(np.int64)
    cut = np.split(x, 4, axis=1)
    books = [c[:256].copy() for c in cut]

    def near(p, b):
        d = ((p[:, None, :] - b[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(4):
        for i, p in enumerate(cut):
            a, _ = near(p, books[i])
            for e in range(len(books[i])):
                if (a == e).any():
                    books[i][e] = p[a == e].sum(0) // (a == e).sum()
    found = [near(p, books[i]) for i, p in enumerate(cut)]
    codes = np.stack([a for a, _ in found], 1).astype(np.uint8)
    error = sum(d for _, d in found)
    text = ",".join(str(v) for b in books for v in b.ravel().tolist())
    return [(r[0], bytes(c).hex(), int(e)) for r, c, e in zip(kept, codes, error)], hashlib.sha256(text.encode()).hexdigest()


def vectors(n, dim, seed, grid=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.2, (n, dim)).astype(np.float32)
    if grid:  # many equal distances
        x = np.round(x * grid) / grid
    return [(i, [float(v) for v in row], int(rng.integers(0, 4)) if i % 9 else None) for i, row in enumerate(x)]


def check(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for part in extra:
        name, kind = part.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    found, books = V.encode(df, carry=("label",))
    out = V.with_label_errors(found)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error"]
    got = out.collect()
    want, digest = brute(rows)
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=str) == sorted(want, key=str) and V.digest(books) == digest
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in got)


@pytest.mark.parametrize("n,dim,grid", [(1500, 16, None), (900, 8, 10), (600, 4, 5), (30, 64, None)])
def test_equal_to_all_distances(spark, n, dim, grid):
    rows = vectors(n, dim, n, grid)
    rows += [(n + i, rows[0][1], 1) for i in range(n // 3)]  # a third are copies
    random.Random(1).shuffle(rows)
    check(spark, rows, CLASHES.split(", ")[1:4] + ["x array<int>", "carried string", "trees int"])


def test_bad_vectors_go_and_odd_ids_stay(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(40, 8, 5) + [(50, None, 1), (51, [0.0] * 7 + [None], 1), (52, [nan] * 8, None), (53, [inf] + [0.0] * 7, 1),
                                (54, [-inf] + [0.0] * 7, 1), (None, [0.5] * 8, None), (3, [0.25] * 8, 2), (3, [0.25] * 8, 2)]
    check(spark, rows)


def test_empty_and_wrong_lengths(spark):
    check(spark, [])
    check(spark, [(1, None, 1)])
    for bad in ([(1, [0.0] * 6, 1)], [(1, [0.0] * 4, 1), (2, [0.0] * 8, 1)], [(1, [3e38] * 4, 1)]):
        with pytest.raises(Exception, match="vectors|components"):
            V.encode(spark.createDataFrame(bad, SCHEMA).coalesce(1))[0].collect()


@pytest.mark.parametrize("spread", [1, 40, 3000])
def test_whole_nodes_are_assigned_by_their_sums(spread):
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (40, 4))
    points = (centres[rng.integers(0, 40, 4000)] + rng.integers(-spread, spread + 1, (4000, 4))).astype(np.int64)
    tree = V.Tree.build(points, V.LEAF)
    nearest, sums, counts, wholesale = V.assign(tree, centres)
    d = ((points[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
    assert (nearest == d[tree.order]).all() and (counts == np.bincount(d, minlength=40)).all()
    assert all((sums[e] == points[d == e].sum(0)).all() for e in range(40))
    assert wholesale > 2000 or spread > 1


def test_ties_go_to_the_lower_entry_and_large_numbers_stay_exact():
    entries = np.array([[10], [-10], [10], [0]])
    tree = V.Tree.build(np.array([[5], [-5], [10], [0], [-10]] * 40), 4)
    assert [int(tree.points[i, 0]) // 5 for i in range(len(tree.points)) if V.assign(tree, entries)[0][i] == 2] == []
    assert {(int(p[0]), int(e)) for p, e in zip(tree.points, V.assign(tree, entries)[0])} == {(5, 0), (-5, 1), (10, 0), (0, 3), (-10, 1)}
    big = np.array([[2**29, 0], [2**29 - 1, 1], [-2**29, 5]])
    near = V.assign(V.Tree.build(big, 8), np.array([[2**29 - 1, 0], [2**29, 1], [-2**29, -2**29]]))[0]
    d = ((big[:, None, :].astype(object) - np.array([[2**29 - 1, 0], [2**29, 1], [-2**29, -2**29]], object)[None]) ** 2).sum(2)
    assert near.tolist() == [min(range(3), key=lambda e: row[e]) for row in d]
