import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from corpus import awkward, empty, frame, sentence  # noqa: E402

from alignfold.llm import queries, toxicity  # noqa: E402

INSULTS = ["gronkular", "fizzlewump", "snarblethwaite", "quixodrome"]


def labelled(n=400):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(60, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(3, 8)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 0, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learnt(spark):
    rows, labels = labelled()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, labels, toxicity.fit(frame(spark, rows, clashes=True), table, F.col("doc_id") % 4 != 2)


def test_held_out_documents(spark, learnt):
    rows, labels, model = learnt
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, rows), model).collect()}
    held = [(got[i], y) for i, _, y in labels if i % 4 == 2]
    wrong = sum((s >= 0.3) != bool(y) for s, y in held)
    assert wrong <= 0.05 * len(held)


def test_awkward_rows(spark, learnt):
    model = learnt[2]
    rows = awkward()
    got = toxicity.score(frame(spark, rows, clashes=True), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    blank = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(blank) == 1 and len({r.score for r in got if r.doc_id in (6, 7, 12)}) == 1


def test_without_labels_or_with_one_class(spark):
    rows, labels = labelled(40)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame(spark, rows), none, F.lit(True))
    assert {round(r.score, 3) for r in toxicity.score(frame(spark, rows), model).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 0, 1) for i in range(40)] + [(None, 0, 1), (3, 0, None)], none.schema)
    model = toxicity.fit(frame(spark, rows), ones, F.lit(True))
    assert all(r.score > 0.99 for r in toxicity.score(frame(spark, rows), model).collect())


def test_empty(spark, learnt):
    assert toxicity.score(empty(spark), learnt[2]).count() == 0


def test_windows_cover_the_text():
    text = "One two  three " * 30 + "z" * 500
    parts = toxicity.windows(text)
    assert b" ".join(p.strip() for p in parts).split() == text.lower().encode().split()
    assert toxicity.windows("") == [] and toxicity.windows(" \n") == []


def test_query(spark, sf_dir):
    import zlib

    import duckdb
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{sf_dir}/labels.parquet'").fetchall())
    got = queries.op4_toxicity(spark, sf_dir).collect()
    assert len(got) == duckdb.sql(f"select count(*) from '{sf_dir}/documents.parquet'").fetchall()[0][0]
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    above = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert above > 0.85  # about forty toxic documents to learn from here; far more at larger scale
