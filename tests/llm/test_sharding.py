import os
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame  # noqa: E402

from alignfold.llm import queries, sharding  # noqa: E402


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_law_and_mixture(spark, n_shards):
    rows = awkward() + [(1000 + i, f"text {i}", "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(400)]
    got = sharding.interleave_shards(frame(spark, rows, clashes=True), n_shards).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.source) for r in got) == Counter((r[0], r[3]) for r in rows)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(n_shards)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    per = Counter((r.shard, r.source) for r in got)
    for source, n in Counter(r.source for r in got).items():
        for shard in range(n_shards):
            assert abs(per[shard, source] - n / n_shards) <= 2


def test_order_inside_follows_fraction(spark):
    rows = [(i, "t", "en", "a" if i < 30 else "b", 0) for i in range(90)]
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.interleave_shards(frame(spark, rows), 3).collect()}
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.interleave_shards(frame(spark, rows).repartition(7), 3).collect()}
    assert got == again
    order = sorted(got, key=got.get)
    places = [i for i, d in enumerate(order) if d < 30]  # the small source at even distances
    assert max(b - a for a, b in zip(places, places[1:])) <= 4


def test_empty(spark):
    assert sharding.interleave_shards(empty(spark), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.interleave_shards(empty(spark), 0)


def test_query(spark, sf_dir):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in queries.op1_sharding(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        raw = (text or "").encode()
        assert (got[doc_id].size, got[doc_id].text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert got[doc_id].law == "rows" and got[doc_id].grown_shard is None
