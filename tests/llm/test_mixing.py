import os
import random
import sys
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, text_of  # noqa: E402

from alignfold.llm import mixing, queries  # noqa: E402


def brute_targets(sizes, weights, total, most):
    """Raise a common level in small exact steps: the level at which the capped shares meet the total."""
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(most * sizes[s], weights[s] * mid) for s in sizes) < total:
            lo = mid
        else:
            hi = mid
    return {s: min(most * sizes[s], weights[s] * hi) for s in sizes}


def test_targets():
    rng = random.Random(3)
    for _ in range(50):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 300, 5000]) for i in range(6)}
        weights = {s: rng.choice([1.0, 2.0, 3.0]) for s in sizes}
        got = mixing.source_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
        want = brute_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
        assert all(abs(got[s] - want[s]) < 1e-3 for s in sizes)


def test_flow_is_maximal_and_cheapest():
    rng = random.Random(8)
    for _ in range(25):
        sizes = [rng.randint(0, 3) for _ in range(3)]
        members = [rng.sample(range(2), rng.randint(1, 2)) for _ in sizes]
        quotas = [rng.randint(0, 5) for _ in range(2)]
        flow = mixing.route(sizes, members, quotas, 2)
        assert (flow.sum(0) <= quotas).all() and (flow.sum(1) <= [2 * s for s in sizes]).all()
        price = sum(max(0, int(f) - s) for f, s in zip(flow.sum(1), sizes))
        best = None
        for given in product(*[range(2 * s + 1) for s, m in zip(sizes, members) for _ in m]):
            it = iter(given)
            rows = [{s: next(it) for s in m} for m in members]
            if any(sum(r.values()) > 2 * s for r, s in zip(rows, sizes)):
                continue
            if any(sum(r.get(k, 0) for r in rows) > q for k, q in enumerate(quotas)):
                continue
            key = (-sum(given), sum(max(0, sum(r.values()) - s) for r, s in zip(rows, sizes)))
            best = key if best is None else min(best, key)
        assert best == (-int(flow.sum()), price)


def mix(df, **kw):
    return mixing.mix(df, F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")), F.array("source"),
                      mixing.repeating([3, 1, 2]), **kw)


def test_takes_come_near_targets(spark):
    rows = awkward()
    got, targets = mix(frame(spark, rows, clashes=True))
    got = got.collect()
    assert len(got) == len(rows)
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        source = None if r.pattern == ["z"] else r.pattern[0][1:]
        assert len(r.given) <= 2
        taken[source] += r.size * len(r.given)
        most[source] = max(most[source], r.size)
    for source, (size, target) in targets.items():
        assert size == sum(len(text_of(x).encode().split()) for x in rows if x[3] == source)
        assert target <= 2 * size + 1e-6 and abs(taken[source] - target) <= most[source] + 1
    assert list(targets)[-1] is None  # null stands last
    total = sum(len(text_of(x).encode().split()) for x in rows)
    assert abs(sum(t for _, t in targets.values()) - 1.5 * total) < 1e-6


def test_reruns_agree(spark):
    rows = awkward()
    one, _ = mix(frame(spark, rows))
    two, _ = mix(frame(spark, rows[::-1]).repartition(5))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_overlapping_sources_share_a_pattern(spark):
    rows = [(i, 10, ["a"]) for i in range(50)] + [(100 + i, 10, ["b", "a"]) for i in range(100)] + \
        [(300 + i, 10, ["c", "b"]) for i in range(30)] + [(400, 5, []), (401, 5, None), (402, 7, ["a", "a"])]
    df = spark.createDataFrame(rows, "doc_id long, n long, sources array<string>")
    got, targets = mixing.mix(df, F.col("n"), F.col("sources"), lambda n: [1.0] * n, share=0.9, passes=2)
    to = defaultdict(int)
    for r in got.collect():
        assert set(x[1:] for x in r.given) <= set(dict((a, c or []) for a, _, c in rows)[r.doc_id])
        for s in r.given:
            to[s[1:]] += r.size
    for s, (_, target) in targets.items():
        assert abs(to[s] - target) <= 20  # half a row at each end of at most two stretches


def test_more_sources_than_the_driver_solves_a_flow_for(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 3)
    rng = random.Random(4)
    rows = [(i, rng.randint(0, 9), [f"s{i % 5000}"]) for i in range(12_000)] + [(20_000, 4, ["x", "y"]), (20_001, 4, ["x"])]
    df = spark.createDataFrame(rows, "doc_id long, n long, sources array<string>")
    got, targets = mixing.mix(df, F.col("n"), F.col("sources"), mixing.repeating([3, 1, 2]))
    sizes = defaultdict(int)
    for _, n, s in rows:
        for x in s:
            sizes[x] += n
    weights = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(sorted(sizes))}
    want = mixing.source_targets(dict(sizes), weights, 1.5 * sum(n for _, n, _ in rows), 2)
    assert all(abs(targets[s][1] - want[s]) < 1e-6 and targets[s][0] == sizes[s] for s in want) and list(targets) == sorted(sizes)
    taken = defaultdict(int)
    for r in got.collect():
        assert len(r.given) <= 2
        for s in r.given:
            taken[s[1:]] += r.size
    assert all(abs(taken[s] - want[s]) <= 9 for s in want)
    many = spark.createDataFrame([(i, 1, [f"a{i}", f"b{i}"]) for i in range(5)], "doc_id long, n long, sources array<string>")
    with pytest.raises(ValueError, match="patterns of several sources"):
        mixing.mix(many, F.col("n"), F.col("sources"), mixing.repeating([1]))


def test_a_hundred_and_fifty_thousand_sources(spark):
    df = spark.range(300_000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("n"),
                                     F.array(F.concat(F.lit("s"), (F.col("id") % 150_000).cast("string"))).alias("sources"))
    rows, sources = mixing.mix_rows(df, F.col("n"), F.col("sources"), mixing.repeating([3, 1, 2]))
    total = df.agg(F.sum("n")).first()[0]
    r = sources.agg(F.count(F.lit(1)), F.sum("target"), F.max(F.col("target") - 2 * F.col("own"))).first()
    assert r[0] == 150_000 and abs(r[1] - 1.5 * total) < 1e-3 * total and r[2] <= 1e-9
    off = rows.groupBy("pattern").agg(F.sum(F.col("size") * F.size("given")).alias("taken"), F.first(F.col("targets")[0]).alias("target"))
    assert off.filter(F.abs(F.col("taken") - F.col("target")) > 6).count() == 0


def test_empty(spark):
    got, targets = mix(empty(spark))
    assert got.count() == 0 and targets == {}


def test_query(spark, sf_dir):
    import duckdb
    docs = {r[0]: r[1:] for r in duckdb.sql(f"select doc_id, text, source from '{sf_dir}/documents.parquet'").fetchall()}
    got = queries.op5_mixing(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sizes, taken, most = defaultdict(int), defaultdict(int), 0
    for text, source in docs.values():
        sizes[source] += len(text.encode().split())
    weights = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(sorted(sizes))}
    want = brute_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for r in got:
        text, source = docs[r.doc_id]
        assert r.size == len(text.encode().split()) and r.source_size == sizes[source] and 0 <= r.taken <= 2 * r.size
        assert abs(r.target - want[source]) < 0.01
        taken[source] += r.taken
        most = max(most, r.size)
    assert all(abs(taken[s] - want[s]) <= most for s in sizes)


@pytest.mark.parametrize("targets", [[0.5, 0.5], [1.2, 2.3, 3.5], [], [0.0]])
def test_whole_quotas(targets):
    got = mixing.whole_quotas(targets)
    assert sum(got) == round(sum(targets)) and all(abs(a - b) <= 1 for a, b in zip(got, targets))
