"""Ordered passes over range partitions: conversations cut anywhere, one of them a third of all turns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from alignfold.operators import segments as SG
from alignfold.operators import templates as TPL
from alignfold.operators import tokens as K
from alignfold.operators import turns as TU

ARRAYS = "conv_id long, conversations array<struct<from:string,value:string,role:string,content:string>>, system_prompt string"
LONG = "conv_id long, turn long, from string, value string"


def conversations(seed, n=60, hot=400):
    rnd = random.Random(seed)
    roles = ["human", "gpt", "human", "gpt", "system", "tool", None]

    def conv(c, size, noise):
        head = rnd.choice([[], ["system"], ["gpt"], ["system", "gpt"]])
        body = [rnd.choice(roles) if rnd.random() < noise else ("human", "gpt")[t % 2] for t in range(size)]
        return [(r, rnd.choice([None, "", f"c{c}t{t}", f"c{c} t{t} more"])) for t, r in enumerate(head + body)]

    out = [conv(c, rnd.randint(0, 9), rnd.choice([0, 0, 0.3])) for c in range(n)]
    out[n // 2] = conv(n // 2, hot, 0)  # a third of all turns or more
    out[n // 3] = conv(n // 3, hot // 4, 0.02)
    return out


def frames(spark, convs):
    arrays = spark.createDataFrame([(c, [(r, v, None, None) for r, v in conv], None) for c, conv in enumerate(convs)], ARRAYS)
    rows = [(c, t, r, v) for c, conv in enumerate(convs) for t, (r, v) in enumerate(conv)]
    random.Random(1).shuffle(rows)
    return arrays, spark.createDataFrame(rows, LONG).repartition(4)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("parts,seed", [(1, 1), (7, 2), (40, 3), (200, 4)])
def test_dialogs_cut_anywhere_equal_the_record_form(spark, strict, parts, seed):
    arrays, turns = frames(spark, conversations(seed))
    want = TU.normalize_dialog(arrays, strict=strict).collect()
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        convs, pairs = TU.normalize_dialog_long(turns, strict=strict)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    assert sorted((r.conv_id, r.system, r.n_pairs) for r in convs.collect()) == sorted((r.conv_id, r.system, len(r.pairs)) for r in want)
    got = sorted(((r.conv_id, r.k, r.query, r.answer, r.system) for r in pairs.collect()), key=str)
    assert got == sorted(((r.conv_id, k, p.query, p.answer, r.system if k == 0 else None) for r in want
                          for k, p in enumerate(r.pairs)), key=str)


def test_examples_of_a_hot_conversation(spark):
    base = TPL.get_template("qwen")
    arrays, turns = frames(spark, conversations(9))
    arrays, turns = (d.withColumn("conversations", F.transform("conversations", lambda t: t.withField("value", F.concat(F.coalesce(t["value"], F.lit("")), F.lit(" x")))))
                     if "conversations" in d.columns else d.withColumn("value", F.concat(F.coalesce("value", F.lit("")), F.lit(" x")))
                     for d in (arrays, turns))
    d = TU.normalize_dialog(arrays).select("conv_id", TPL.render_dialog("pairs", "system", base).alias("dialog"))
    for max_len in (8, 60, 3000):
        want = {(r.conv_id, tuple(r.input_ids), tuple(r.labels)) for r in K.build_sft_examples(d, "dialog", max_len, keep=("conv_id",)).collect()}
        convs, pairs = TU.normalize_dialog_long(turns)
        got = K.build_sft_examples_long(convs, pairs, base, max_len=max_len).collect()
        assert {(r.conv_id, tuple(r.input_ids), tuple(r.labels)) for r in got} == want and len(got) == len(want)
        assert all(r.attention_mask == [1] * len(r.input_ids) for r in got)


def test_the_hot_conversation_lies_in_many_partitions_and_text_is_moved_once(spark):
    _, turns = frames(spark, conversations(5, hot=2000))
    held = SG.sorted_partitions(turns, ["conv_id", "turn"], 16)
    sizes = [r["count"] for r in held.groupBy(SG.PID).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 3 * sum(sizes) / len(sizes)
    _, pairs = TU.normalize_dialog_long(turns)
    plan = pairs.filter("k > 0 AND k < 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "RepartitionByExpression" not in plan and plan.count("Join") <= 1  # the join of cut pairs


def test_null_key_and_empty_table(spark):
    rows = [(None, 0, "human", "a"), (None, 1, "gpt", "b"), (1, 0, "system", None), (1, 1, "human", "q"), (1, 2, "gpt", "r")]
    convs, pairs = TU.normalize_dialog_long(spark.createDataFrame(rows, LONG))
    assert sorted((str(r.conv_id), r.system, r.n_pairs) for r in convs.collect()) == [("1", "", 1), ("None", "", 1)]
    assert sorted((str(r.conv_id), r.k, r.query, r.answer, r.system) for r in pairs.collect()) == [("1", 0, "q", "r", ""), ("None", 0, "a", "b", "")]
    convs, pairs = TU.normalize_dialog_long(spark.createDataFrame([], LONG))
    assert convs.count() == 0 and pairs.count() == 0


def test_stretches_add_up():
    """Any cut of any sequence of roles folds to the state of the whole."""
    rnd = random.Random(3)
    for _ in range(400):
        roles = np.array([rnd.choice([0, 0, 1, 1, 2, 3] if rnd.random() < 0.4 else [i % 2]) for i in range(rnd.randint(2, 14))])
        cuts = sorted(rnd.sample(range(1, len(roles)), rnd.randint(1, min(4, len(roles) - 1))))
        span = SG.Span(list(range(len(cuts) + 1)), [SG.Stretch.of(p) for p in np.split(roles, cuts)])
        whole = SG.Span([0], [SG.Stretch.of(roles)])
        for strict in (False, True):
            end = {(s.stays, s.n_pairs) for s in span.states(strict)}
            assert end == {(s.stays, s.n_pairs) for s in whole.states(strict)}
    assert SG.stretches(pa.chunked_array([[None, None, 1, 1, 2]])).tolist() == [0, 2, 4]
