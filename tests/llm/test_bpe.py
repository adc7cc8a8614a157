import hashlib
import os
import sys

import public_tokenizers as P
import pytest
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, text_of  # noqa: E402

from alignfold.llm import bpe, queries  # noqa: E402

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def whole():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


EXTRA = [(500, "<|endoftext|> is ordinary", "en", "a", 0), (501, "  　\x85 end", "en", "a", 0),
         (502, "é ½ ² Ⅷ ١٢٣ ٣", "en", "a", 0), (503, "don't I'LL we've 'sup", "en", "a", 0),
         (504, "\U000323b0͸ unassigned \U0001fae8", "en", "a", 0), (505, " " * 300 + "a" + "\n" * 50, "en", "a", 0)]


@pytest.mark.parametrize("tokenizer", [RANKS, P.path("byte_bpe_50k.json")])
def test_ids_are_those_of_the_rank_library(spark, whole, tokenizer):
    rows = [r for r in awkward() if r[0] != 10] + EXTRA
    got = bpe.encode(frame(spark, rows, clashes=True), tokenizer, P.PATTERN).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(r[0]), whole.encode_ordinary(text_of(r))) for r in rows)


def test_round_trip_and_offsets(spark):
    rows = awkward() + EXTRA
    ids = bpe.encode(frame(spark, rows), RANKS, P.PATTERN, offsets=True)
    for r in ids.collect():
        texts = [text_of(x) for x in rows if x[0] == r.doc_id]
        coder = bpe.PieceEncoder.of(RANKS)
        tokens = [coder.tokens[i].as_py() for i in r.ids]
        text = b"".join(tokens).decode()
        assert text in texts and len(r.starts) == len(r.ids)
        for token, a, b in zip(tokens, r.starts, r.ends):
            assert token in text[a:b].encode() and a < b  # a split character is named whole
        assert not r.ids or (r.starts[0], r.ends[-1]) == (0, len(text))
    back = bpe.decode(ids, RANKS).collect()
    both = bpe.encode(frame(spark, rows), RANKS, P.PATTERN, decoded=True).collect()
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in both) == sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in back)
    assert sorted(bytes(r.decoded) for r in back) == sorted(text_of(x).encode() for x in rows)


def test_split_characters(spark):
    coder = bpe.PieceEncoder.of(RANKS)
    ids = coder.encode_piece("😀")
    assert len(ids) > 1
    df = spark.createDataFrame([(1, ids), (2, ids[:1]), (3, []), (4, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: bpe.decoded_text(bytes(r.decoded)) for r in bpe.decode(df, RANKS).collect()}
    assert got == {1: "😀", 2: "�", 3: "", 4: ""}


def test_alphabet():
    table = bpe.byte_characters()
    assert len(set(table.values())) == 256 and table[ord("a")] == "a" and table[32] == "Ġ" and table[10] == "Ċ"


def test_empty(spark):
    assert bpe.decode(bpe.encode(empty(spark), RANKS, P.PATTERN), RANKS).count() == 0


def test_query(spark, sf_dir, whole):
    import duckdb
    docs = dict(duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall())
    got = queries.op3_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = whole.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
