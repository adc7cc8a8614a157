import os
import random
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, text_of  # noqa: E402

from alignfold.llm import queries, token_files  # noqa: E402

VOCABULARY = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


def brute(docs, library):
    """(id, start, size, crc) in ascending order of (id, hash of the text), null ids first."""
    out, at = [], 0
    h = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64  # noqa: E731  signed order
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, h(d[1] or ""))):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_files_hold_every_document_in_order(spark, library, tmp_path, shard_ids):
    rows = [r for r in awkward() if r[0] != 10]
    df = frame(spark, rows, clashes=True)
    manifest = token_files.write_files(df, str(tmp_path / "out"), VOCABULARY, P.PATTERN, shard_ids=shard_ids)
    got = sorted((tuple(r) for r in token_files.read_files(manifest).collect()), key=lambda r: r[1])
    assert got == brute([r[:2] for r in rows], library)
    # keyed access, also to ids that no shard holds
    shards = [token_files.Shard(r.path) for r in manifest.collect()]
    for key in [r[0] for r in rows if r[0] is not None] + [-5, 99_999, 10**12]:
        found = sorted(x.tolist() for s in shards for x in s.get(key))
        want = sorted([*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t, *_ in rows if d == key)
        assert found == want


def test_lookup_over_many_shards(spark, library, tmp_path):
    rng = random.Random(3)
    rows = [(i * 7 - 700, f"text {i} " * rng.randint(0, 5), "en", "a", 0) for i in range(400)]
    rows += [(21, f"copy {i}", "en", "a", 0) for i in range(60)] + [(None, "no id", "en", "a", 0)]  # 21 goes over several shards
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        manifest = token_files.write_files(frame(spark, rows), str(tmp_path / "out"), VOCABULARY, P.PATTERN, shard_ids=60)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    shards = manifest.collect()
    assert len(shards) > 20 and sum(r.low is not None and r.low <= 21 <= r.high for r in shards) >= 3
    asked = [None, 21, 21, -700, 2093, 22, -701, 10**15, *[i * 7 for i in range(-50, 50)]]
    got = token_files.lookup(manifest, spark.createDataFrame([(x,) for x in asked], "doc_id long")).collect()
    want = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, *_ in rows if d is not None and d in asked]
    assert sorted((r.doc_id, list(r.ids)) for r in got) == sorted(want)
    assert token_files.lookup(manifest.limit(0), spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_keyed_access_reads_little(tmp_path):
    n = 50_000
    ids = np.arange(n * 10, dtype="<u2") % 999
    keys = np.arange(n, dtype=np.int64) * 3
    token_files.save_shard(str(tmp_path / "s"), keys, np.zeros(n, bool), np.full(n, 10), ids)
    shard = token_files.Shard(str(tmp_path / "s"))
    read = [0]

    class Counting:
        def __init__(self, f):
            self.f = f

        def seek(self, at):
            self.f.seek(at)

        def read(self, k):
            read[0] += k
            return self.f.read(k)

    shard.index, shard.payload = Counting(shard.index), Counting(shard.payload)
    rng = random.Random(1)
    for k in rng.sample(range(n), 300):
        assert [x.tolist() for x in shard.get(3 * k)] == [ids[10 * k:10 * k + 10].tolist()] and shard.get(3 * k + 1) == []
    assert read[0] < 600 * 1000 and not shard.whole  # of two files of over 2 MB
    assert shard.find(keys)[0].tolist() == list(range(n))


def test_remembered_pieces_start_afresh(monkeypatch, library):
    import pyarrow as pa
    from alignfold.llm import bpe
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 5)
    coder = bpe.PieceEncoder(VOCABULARY)
    rng = random.Random(4)
    for _ in range(20):
        rows = [[rng.choice(["one", " two", " three", "é", " naïve", "x" * rng.randint(1, 9)]) for _ in range(rng.randint(0, 6))] for _ in range(4)]
        ids, at = coder.encode(pa.array(rows, pa.list_(pa.string())).slice(1))
        want = [[i for p in row for i in coder.encode_piece(p)] for row in rows[1:]]
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_added_tokens_inside_texts_are_the_librarys(spark, tmp_path):
    library = Tokenizer.from_file(VOCABULARY)  # its defaults
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|>b  <|endoftext|>  \n c", "<|endoftext|",
             "naïve 😀 <|endoftext|> 日本語 don't\r\n\t <|ENDOFTEXT|>", "nothing of it", "\U000e0fff <|endoftext|> \u0378 x", "", None]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    manifest = token_files.write_files(frame(spark, rows), str(tmp_path / "out"), VOCABULARY, P.PATTERN)
    assert library.encode(texts[0], add_special_tokens=False).ids == [505, 220, 50256, 734]
    got = sorted((tuple(r) for r in token_files.read_files(manifest).collect()), key=lambda r: r[1])
    assert got == brute([r[:2] for r in rows], library)


def test_perfect_hash():
    rng = random.Random(5)
    for n in (0, 1, 2, 100, 20_000):
        keys = np.array(rng.sample(range(-10**15, 10**15), n), np.int64)
        table = token_files.PerfectHash.build(keys)
        assert sorted(table.number(keys)) == list(range(n))  # minimal and perfect
        again = token_files.PerfectHash(table.sizes, table.bits)
        assert (again.number(keys) == table.number(keys)).all()
        if n == 20_000:
            assert len(table.bits) * 8 < 6 * n


def test_unlisted_files_do_not_count(spark, library, tmp_path):
    rows = [(i, f"text {i}", "en", "a", 0) for i in range(20)]
    for _ in range(2):  # a second writer into one folder, as after a lost task
        manifest = token_files.write_files(frame(spark, rows), str(tmp_path / "out"), VOCABULARY, P.PATTERN)
    got = sorted((tuple(r) for r in token_files.read_files(manifest).collect()), key=lambda r: r[1])
    assert got == brute([r[:2] for r in rows], library)


def test_empty(spark, tmp_path):
    manifest = token_files.write_files(empty(spark), str(tmp_path / "out"), VOCABULARY, P.PATTERN)
    assert token_files.read_files(manifest).count() == 0


def test_query(spark, sf_dir, library):
    import duckdb
    docs = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    got = sorted((tuple(r) for r in queries.op9_token_files(spark, sf_dir).collect()), key=lambda r: r[1])
    assert got == brute(docs, library)
