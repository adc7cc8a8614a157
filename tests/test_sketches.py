"""Sketches leave nothing out; what they let through too much does not reach the result."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from alignfold.operators import filters as FL
from alignfold.operators import sketches as SK
from alignfold.operators import splits as S


def texts(seed):
    rng = random.Random(seed)
    out = [None] * 7 + [""] * 5 + ["everywhere"] * 500
    for i in range(300):
        out += [f"text {i}"] * rng.choice([1, 1, 1, 2, 3, 9])
    return out


@pytest.mark.parametrize("cells", [1, 16, 400, SK.CELLS])
def test_frequent_values(spark, cells):
    rows = texts(1)
    df = spark.createDataFrame([(t,) for t in rows], "t string").repartition(5)
    want = sorted(n for n in Counter(rows).values() if n >= 5)
    assert sorted(r.n for r in FL.repeated_values(df, "t", 5, cells).collect()) == want
    kept = Counter(r.t for r in SK.maybe_frequent(df, "t", 5, cells).collect())
    assert all(kept[t] == n for t, n in Counter(rows).items() if n >= 5)
    rare = sum(n for t, n in kept.items() if n < 5)
    if cells == 1:
        assert rare == sum(n for n in Counter(rows).values() if n < 5)  # over-reports, and the count is exact all the same
    if cells == SK.CELLS:
        assert rare < 20


def test_one_column_frames_and_rows_that_go(spark):
    rows = texts(2)
    df = spark.createDataFrame([(t,) for t in rows], "t string").repartition(5)
    got = Counter(r.t for r in FL.drop_repeated(df, "t", 5).collect())
    assert got == Counter({t: n for t, n in Counter(rows).items() if n < 5})


@pytest.mark.parametrize("words", [1, 8, SK.CELLS])
def test_overlap(spark, words):
    rng = random.Random(3)
    train = [(i, rng.choice([None, "", "everywhere", f"text {rng.randint(0, 3000)}"])) for i in range(3000)]
    for val in ([None, "everywhere"], [f"text {i}" for i in range(100)], []):
        a = spark.createDataFrame(train, "i long, t string").repartition(4)
        b = spark.createDataFrame([(t,) for t in val], "t string")
        want = sorted(i for i, t in train if t in val)
        assert sorted(r.i for r in S.overlap_rows(a, b, "t", words).collect()) == want
        kept = {r.i for r in SK.maybe_in(a, "t", b, "t", words).collect()}
        assert kept >= set(want) and (words < SK.CELLS or len(kept) <= len(want) + 5)
        if words == 1 and len(val) == 100:
            assert len(kept) > 2000  # all bits are set


def test_what_is_shuffled_is_near_what_is_found(spark):
    """Rows counted exactly are bounded by the rows that are frequent, whatever the number of values."""
    df = spark.range(200_000).select(F.when(F.col("id") < 2000, F.lit("many")).otherwise(F.col("id").cast("string")).alias("t"))
    assert SK.maybe_frequent(df, "t", 1000).count() == 2000
