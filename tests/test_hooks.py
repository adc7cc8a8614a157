"""Pluggable hooks (U2, U4, U5), alternate physical paths (F8 block product, large lexicons), S5 / S7."""

import os

import numpy as np
from pyspark.sql import functions as F

from alignfold.functions import text as TX
from alignfold.operators import filters as FL
from alignfold.operators import infer as INF
from alignfold.operators import rewards as R
from alignfold.operators import similarity as SIM
from alignfold.operators import tokens as K
from alignfold.sources import io


def test_score_with_model_hook(spark):
    df = spark.createDataFrame([("p", "abc"), ("q", "de")], "prompt string, content string")
    out = R.score_with(df, lambda p, c: c.str.len() / 10.0)
    assert sorted(r.model_reward for r in out.collect()) == [0.2, 0.3]


def test_pandas_tokenizer_hook(spark):
    tok = K.pandas_tokenizer(lambda texts: [[len(w) for w in t.split()] for t in texts])
    df = spark.createDataFrame([("aa b ccc",)], "t string")
    assert df.select(tok(F.col("t")).alias("ids")).first().ids == [2, 1, 3]


def test_map_batches_may_drop_rows(spark):
    df = spark.range(10)
    out = INF.map_batches(df, lambda pdf: pdf[pdf["id"] % 2 == 0], "id long")
    assert sorted(r.id for r in out.collect()) == [0, 2, 4, 6, 8]


def test_batch_infer_keyed_and_cleaned(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "world")], "id long, question string")
    out = INF.batch_infer(df, lambda ps, sys_p: [p.upper() + " </s>junk" for p in ps], batch=1)
    assert {(r.id, r.Output) for r in out.collect()} == {(1, "HELLO"), (2, "WORLD")}


def _similarities(cand, anchors, k):
    """(key, max, mean of the k highest) of each candidate, by all pairs."""
    def fine(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    def cosine(a, b):
        a, b = (np.array(x) / (max(map(abs, x)) or 1) for x in (a, b))
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return float(np.dot(a, b) / n) if n else 0.0

    real = [v for _, v in anchors if fine(v)]
    out = []
    for key, v in cand:
        top = sorted((cosine(v, a) for a in real), reverse=True)[:k] if fine(v) and real else []
        out.append((key, round(top[0], 9) if top else None, round(sum(top) / len(top), 9) if top else None))
    return sorted(out, key=str)


def test_semantic_scores_are_the_same_for_any_number_of_blocks(spark):
    rng = np.random.default_rng(0)
    nan, inf = float("nan"), float("inf")
    vectors = lambda n: [rng.normal(size=8).tolist() for _ in range(n)]
    odd = [None, [0.0] * 8, [nan] * 8, [inf] + [0.0] * 7, [None] + [1.0] * 7, [1e200] * 8]
    anchors = [(f"a{i}", v) for i, v in enumerate(vectors(37) + odd)]
    cand = [(f"c{i % 20}", v) for i, v in enumerate(vectors(53) + odd)] + [(None, v) for v in vectors(2)]
    schema = "qid string, vec array<double>"
    for held in (anchors, anchors[:3], anchors[-6:-1], []):
        want = _similarities(cand, held, 5)
        for blocks in (1, 2, 50):
            c, a = spark.createDataFrame(cand, schema).repartition(3), spark.createDataFrame(held, schema)
            got = SIM.semantic_scores(c, a, key="qid", vec="vec", k=5, blocks=blocks).collect()
            assert sorted(((r.qid, None if r.max_sim is None else round(r.max_sim, 9),
                            None if r.topk_mean is None else round(r.topk_mean, 9)) for r in got), key=str) == want
    for agg, col in (("max", 1), ("mean", 2)):
        want = [w[0] for w in _similarities(cand, anchors, 5) if w[col] is not None and w[col] >= 0.6]
        c = spark.createDataFrame(cand, schema).withColumn("max_sim", F.lit("kept"))
        got = SIM.semantic_filter(c, spark.createDataFrame(anchors, schema), 0.6, agg, vec="vec", blocks=3)
        assert got.columns == ["qid", "vec", "max_sim"] and sorted((str(r.qid) for r in got.collect())) == sorted(map(str, want))


def test_semantic_scores_read_blocks_once_for_many_candidates(spark, monkeypatch):
    rows = rng_rows = np.random.default_rng(1).normal(size=(300, 4))
    blocks = [rng_rows[:100], rng_rows[100:101], rng_rows[101:]]
    read = []
    monkeypatch.setattr(SIM, "read_block", lambda p: read.append(p) or blocks[p])
    monkeypatch.setattr(SIM, "ROWS_AT_ONCE", 7)
    best = SIM.best_of_blocks(rows, [0, 1, 2], 3)
    assert read == [0, 1, 2] and np.allclose(best, -np.sort(-(rows @ rows.T), axis=1)[:, :3])


def test_hits_do_not_depend_on_the_number_of_terms(spark):
    texts = ["the w0001 w0002 w0001", "", None, "nothing", "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for terms in (["the", "he"], ["a", ""], ["a", ""] + [f"w{i:04d}" for i in range(1500)] + ["the", "he", "a"]):
        got = [r.h for r in df.select(TX.count_hits(F.col("t"), terms).alias("h")).collect()]
        assert got == [sum(1 for x in dict.fromkeys(terms) if x in (t or "")) for t in texts]


def test_read_table_and_write_results(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).write.parquet(os.path.join(base, "ds", "train"))
    assert io.read_table(spark, "ds", "train", base_dir=base).count() == 3
    res = spark.createDataFrame([("i", "o")], "Input string, Output string")
    io.write_results(res, os.path.join(base, "res"))
    io.write_results(res, os.path.join(base, "res"))  # replaced, not appended
    assert spark.read.json(os.path.join(base, "res")).count() == 1


def test_group_rank_index_equals_window(spark):
    import random
    rnd = random.Random(1)
    rows = [(p, g, float(rnd.randint(0, 3))) for p in range(20) for g in range(rnd.randint(1, 6))]
    rows += [(99, g, float(g % 3)) for g in range(300)]  # one hot group
    df = spark.createDataFrame(rows, "prompt_id long, gen_id int, reward double")
    a = {(r.prompt_id, r.gen_id): (r.rank, r.row_number) for r in R.group_rank(df, method="window").collect()}
    b = {(r.prompt_id, r.gen_id): (r.rank, r.row_number) for r in R.group_rank(df, method="index").collect()}
    assert a == b
