"""What a task holds does not grow with the table, and no step of a plan is left out."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from alignfold.operators import similarity as SIM
from alignfold.operators import splits as S
from alignfold.operators import tokens as K
from alignfold.plans.registry import QUERIES, load_all

load_all()


def test_model_compare_has_all_models_and_puts_them_side_by_side(spark, tmp_path):
    docs = [(1, "a", "de", "s"), (2, "a\nb", "de", "s"), (3, "a", "fr", "s"), (4, "a\nb\nc", "xx", "s"), (5, "a", None, "s"), (6, "a", "en", None)]
    spark.createDataFrame([(*d, len(d[1])) for d in docs], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d[0], 1, 0) for d in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["model_compare"](spark, str(tmp_path))
    assert got.columns == ["source", "model", "total", "n", "de", "en", "es", "fr", "other"]
    side = {"s": (2.5, None, None, 2.0, 3.0), None: (None, 2.0, None, None, None)}
    want = {("s", "de", 2.5, 2), ("s", "fr", 2.0, 1), ("s", "xx", 4.0, 1), ("s", None, 2.0, 1), (None, "en", 2.0, 1)}
    assert {tuple(r) for r in got.collect()} == {(*w, *side[w[0]]) for w in want}


def test_products_do_not_grow_with_the_block(monkeypatch):
    rng = np.random.default_rng(0)
    rows, block = rng.normal(size=(2048, 8)), rng.normal(size=(100_000, 8))
    monkeypatch.setattr(SIM, "read_block", lambda path: block)
    tracemalloc.start()
    SIM.best_of_blocks(rows, ["one"], 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


@pytest.mark.parametrize("k", [1, 3, 40])
def test_best_of_parts_of_a_block(monkeypatch, k):
    rng = np.random.default_rng(2)
    rows = rng.integers(-2, 3, size=(50, 3)).astype(float)  # many ties
    blocks = [rows[:20], rows[20:21], rows[21:]]
    monkeypatch.setattr(SIM, "read_block", lambda p: blocks[p])
    monkeypatch.setattr(SIM, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(SIM, "ANCHORS_AT_ONCE", 4)
    assert np.array_equal(SIM.best_of_blocks(rows, [0, 1, 2], k), -np.sort(-(rows @ rows.T), axis=1)[:, :k])


def test_tokenizer_gets_a_bounded_part_of_a_batch(spark):
    at_once = K.pandas_tokenizer(lambda texts: [[len(texts), len(t)] for t in texts])
    df = spark.range(1000).select(F.when(F.col("id") != 7, F.repeat(F.lit("x"), (10_000 + F.col("id")).cast("int"))).alias("t"), "id").coalesce(1)
    got = df.select("id", at_once(F.col("t")).alias("ids")).collect()
    assert [r.ids[1] for r in sorted(got)] == [0 if i == 7 else 10_000 + i for i in range(1000)]
    assert max(r.ids[0] for r in got) < 200


def test_subword_ids_of_long_short_and_missing_dialogs(spark):
    P, sentencepiece = pytest.importorskip("public_tokenizers"), pytest.importorskip("sentencepiece")
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(0, ["a b", None, ""]), (1, None), (2, []), (3, ["some words " * 150_000, "end"]), *((i, ["more words " * 2000] * 12) for i in range(4, 70))]
    df = spark.createDataFrame(rows, "id long, dialog array<string>").coalesce(1)
    got = {r.id: r.ids for r in df.select("id", K.subword_tokenizer(path, add_eos=True).many("dialog").alias("ids")).collect()}
    long = model.encode("more words " * 2000, add_eos=True)
    for i, dialog in rows:
        want = [long] * 12 if i > 3 else [model.encode(t or "", add_eos=True) for t in dialog or []]
        assert got[i] == want, i


def test_overlap_copies_no_content(spark):
    train = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 9 == 1, F.col("id").cast("string")).alias("t"))
    val = spark.range(0, 4000, 3).select(F.col("id").cast("string").alias("t")).unionByName(spark.createDataFrame([("hot",), (None,)], "t string"))
    out = S.overlap_rows(train.repartition(4), val, "t")
    want = [i for i in range(4000) if i % 2 == 0 or i % 9 != 1 or i % 3 == 0]
    assert out.columns == ["id", "t"] and sorted(r.id for r in out.collect()) == want
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_group_statistics_are_not_copied(spark):
    from alignfold.operators import filters as FL
    from alignfold.operators import rewards as R

    df = spark.range(600).select((F.col("id") % 200).alias("prompt_id"), F.col("id").alias("gen_id"), (F.col("id") % 7).cast("double").alias("reward"))
    values = spark.createDataFrame([("a", i) for i in range(9)] + [(None, 9), (None, 10), ("b", 11)], "t string, n long")
    for out in (R.group_advantage(df), FL.drop_repeated(values, "t", 2)):
        assert "_copy" not in out._jdf.queryExecution().analyzed().toString()
    assert R.group_advantage(df).count() == 600
    assert [tuple(r) for r in FL.drop_repeated(values, "t", 2).collect()] == [("b", 11)]
