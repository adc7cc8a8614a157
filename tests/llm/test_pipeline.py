"""Every stage of the pipeline against its definition, on the awkward rows and on the small table."""

import hashlib
import os
import random
import sys
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from corpus import awkward, empty, frame, text_of  # noqa: E402
from test_rules import brute as rules  # noqa: E402
from test_simhash import brute as groups  # noqa: E402
from test_toxicity import labelled  # noqa: E402

from alignfold.llm import bpe  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents (awkward rows, clean, toxic and copied ones) and labels."""
    rows, labels = labelled(300)
    rows = [(20_000 + i, t, g, random.Random(i).choice("abc"), n) for i, t, g, _, n in rows]
    rows += [(30_000 + i, rows[3][1], "en", "a", 0) for i in range(20)] + awkward()
    folder = tmp_path_factory.mktemp("tables")
    frame(spark, rows).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(20_000 + i, q, y) for i, q, y in labels], "doc_id long, quality int, toxic int") \
        .write.parquet(str(folder / "labels.parquet"))
    return str(folder), rows, {20_000 + i: y for i, _, y in labels}


def key(row):
    return tuple(row)[:5]


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "encoding"]


def test_stages_in_turn(spark, tables):
    folder, rows, toxic = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = STAGES["toxicity"](spark, docs, folder)
    assert kept.columns == docs.columns
    kept = [key(r) for r in kept.collect()]
    assert not Counter(kept) - Counter(rows)
    held = {r[0] for r in kept}
    gone = {d for d in toxic if d not in held}
    assert len(gone - {d for d, y in toxic.items() if y}) <= 6 and len([d for d, y in toxic.items() if y and d in held]) <= 6

    good = STAGES["quality"](spark, frame(spark, kept), folder)
    good = [key(r) for r in good.collect()]
    assert Counter(good) == Counter(r for r in kept if not rules(text_of(r))[5])

    single = STAGES["near_duplicates"](spark, frame(spark, good), folder)
    single = [key(r) for r in single.collect()]
    component = {(d, f): c for d, f, c in groups(good)}
    assert len(single) == len(set(component.values())) and {str(r[0]) for r in single} == {str(c) for c in component.values()}

    mixed = STAGES["mixing"](spark, frame(spark, single), folder)
    mixed = [key(r) for r in mixed.collect()]
    assert set(mixed) <= set(single) and max(Counter(mixed).values()) <= 2
    words = sum(len(text_of(r).encode().split()) for r in single)
    assert abs(sum(len(text_of(r).encode().split()) for r in mixed) - 1.5 * words) <= 4 * max(len(text_of(r).encode().split()) for r in single)

    out = STAGES["encoding"](spark, frame(spark, mixed), folder).collect()
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")),
                              special_tokens={})
    assert sorted((str(r.doc_id), r.ids) for r in out) == sorted((str(r[0]), whole.encode_ordinary(text_of(r))) for r in mixed)
    assert {r.decoded_sha256 for r in out} == {hashlib.sha256(text_of(r).encode()).hexdigest() for r in mixed}


def test_run_is_the_stages(spark, tables):
    folder, rows, toxic = tables
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and {r.doc_id for r in out} <= {r[0] for r in rows}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_and_empty_tables(spark, tables, name):
    folder, _, _ = tables
    for docs in (frame(spark, awkward(), clashes=True).withColumnRenamed("size", "row_key").withColumnRenamed("shard", "toxicity"),
                 empty(spark)):
        got = STAGES[name](spark, docs, folder)
        if name != "encoding":
            assert got.columns == docs.columns
        n = got.count()
        assert n <= 2 * docs.count() and (docs.isEmpty() or name == "quality" or n > 0)


def test_rows_that_differ_in_which_column_is_null_have_their_own_keys(spark):
    from alignfold.llm.common import row_key

    df = frame(spark, [(1, "same", "en", None, 4), (1, "same", None, "en", 4), (1, "same", None, None, 4), (1, "same", None, None, 4)])
    assert df.select(row_key(df).alias("k")).distinct().count() == 3
