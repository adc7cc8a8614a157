"""Inline-row unit tests for operator semantics and hazards."""

import math

import pytest
from pyspark.sql import functions as F

from alignfold.functions.schemas import SFT
from alignfold.operators import metrics as M
from alignfold.operators import prompts as P
from alignfold.operators import splits as S
from alignfold.operators import templates as TPL
from alignfold.operators import tokens as K
from alignfold.operators import turns as TU


def turn(frm=None, value=None, role=None, content=None):
    return {"from": frm, "value": value, "role": role, "content": content}


def sft_df(spark, convs, system=None):
    return spark.createDataFrame([(c, system) for c in convs], SFT)


def test_first_user_turn_aliases_and_unicode_strip(spark):
    convs = [[turn("system", "s"), turn("human", "   "), turn(role="user", content="　q1 "), turn("gpt", "a")],
             [], [turn("gpt", "only answer")]]
    out = TU.first_user_turn(sft_df(spark, convs)).collect()
    assert [r.question for r in out] == ["q1"]


def _dialog(spark, roles, strict=False, system=None):
    convs = [[turn(r, f"t{i}") for i, r in enumerate(roles)]]
    return TU.normalize_dialog(sft_df(spark, convs, system), strict=strict).collect()


def test_dialog_rules(spark):
    assert _dialog(spark, ["human", "gpt", "human"]) == []                       # odd
    assert _dialog(spark, ["system", "human"]) == []                             # too short after system
    r = _dialog(spark, ["human", "human", "human", "human"])                     # parity never re-synchronised
    assert [(p.query, p.answer) for p in r[0].pairs] == [("t0", "t2")]
    assert _dialog(spark, ["human", "human", "human", "human"], strict=True) == []
    r = _dialog(spark, ["human", "gpt", "gpt", "human"])
    assert [(p.query, p.answer) for p in r[0].pairs] == [("t0", "t1")]
    assert _dialog(spark, ["human", "gpt", "gpt", "human"], strict=True) == []
    r = _dialog(spark, ["human", "gpt", "tool", "gpt"])
    assert [(p.query, p.answer) for p in r[0].pairs] == [("t0", "t1")]
    r = _dialog(spark, ["system", "gpt", "human", "gpt"])                        # leading non-human dropped
    assert r[0].system == "t0" and [(p.query, p.answer) for p in r[0].pairs] == [("t2", "t3")]
    r = _dialog(spark, ["human", "gpt"], system="row sys")                       # row column is the fallback
    assert r[0].system == "row sys"


def test_render_qwen_and_registry(spark):
    qwen = TPL.get_template("qwen")
    df = spark.createDataFrame([([{"query": "a", "answer": "b"}], "")], "pairs array<struct<query:string,answer:string>>, s string")
    d = df.select(TPL.render_dialog("pairs", "s", qwen).alias("d")).first().d
    assert d == [qwen.system_prompt + "\n" + "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\n", "b"]
    assert len(TPL.TEMPLATES) == 29
    assert TPL.get_template("deepseek").system_prompt == "<BOS_TOKEN>"
    # braces inside user text are never parsed
    df2 = spark.createDataFrame([([{"query": "{x} {{y}}", "answer": ""}],)], "pairs array<struct<query:string,answer:string>>")
    out = df2.select(TPL.render_prompt("pairs", None, TPL.get_template("base")).alias("p")).first().p
    assert out == "{x} {{y}}"


def test_render_all_templates_match_python_format(spark):
    df = spark.createDataFrame([([{"query": "q1", "answer": "a1"}, {"query": "q2", "answer": "a2"}],)],
                               "pairs array<struct<query:string,answer:string>>")
    cols = [TPL.render_prompt("pairs", None, t).alias(n) for n, t in TPL.TEMPLATES.items()]
    row = df.select(*cols).first().asDict()
    for n, t in TPL.TEMPLATES.items():
        sys = t.system_prompt + t.sep if t.system_prompt else ""
        exp = sys + t.prompt.format(query="q1") + "a1" + t.sep + t.prompt.format(query="q2") + "a2"
        assert row[n] == exp, n


def test_history_messages(spark):
    df = spark.createDataFrame([([{"query": "q1", "answer": "a1"}, {"query": "q2", "answer": ""}], "q3", "sys")],
                               "h array<struct<query:string,answer:string>>, q string, s string")
    m = df.select(TU.history_to_messages("h", F.col("q"), F.col("s")).alias("m")).first().m
    assert [(x.role, x.content) for x in m] == [("system", "sys"), ("user", "q1"), ("assistant", "a1"),
                                                 ("user", "q2"), ("user", "q3")]


def test_truncation_hazards(spark):
    df = spark.createDataFrame([(list(range(3, 2001)), [5, 6]), ([7] * 256, [8] * 256), ([3, 4], [2])],
                               "src array<int>, tgt array<int>")
    r = df.select(K.truncate_turn("src", "tgt", 512).alias("t")).collect()
    assert len(r[0].t.tgt) == 1                      # max_target 0 -> tgt[:-1]
    assert len(r[0].t.src) == 511                     # floor(512 * 1998 / 2000)
    assert len(r[1].t.tgt) == 255 and len(r[1].t.src) == 256  # a turn that fits still loses one target token
    s = df.select(K.strip_eos("src", "tgt").alias("t")).collect()
    assert s[2].t.tgt == []


def test_turn_budget(spark):
    df = spark.createDataFrame([([{"src": [1] * 150, "tgt": [3] * 149}, {"src": [1] * 150, "tgt": [3] * 149},
                                  {"src": [1] * 5, "tgt": [3] * 4}],)], "t array<struct<src:array<int>,tgt:array<int>>>")
    kept = df.select(K.turn_budget("t", 512).alias("k")).first().k
    assert len(kept) == 1  # costs 300, 300, 10: the second breaks the loop, the third is dropped too


def test_pack_mask_and_drop(spark):
    df = spark.createDataFrame([([{"src": [5, 6], "tgt": [7]}],), ([{"src": [5], "tgt": []}],)],
                               "t array<struct<src:array<int>,tgt:array<int>>>")
    p = df.select(K.pack_turns("t").alias("p")).select("p.*")
    rows = p.collect()
    assert rows[0].input_ids == [5, 6, 7, 2] and rows[0].labels == [-100, -100, 7, 2]
    assert rows[0].attention_mask == [1, 1, 1, 1]
    empty = spark.createDataFrame([([-100, -100],), ([],), ([-100, 4],)], "labels array<int>")
    assert K.drop_unlabelled(empty).count() == 1
    assert empty.select(K.unmask_labels("labels").alias("u")).collect()[2].u == [0, 4]


def test_whitespace_tokenizer_matches_python_split(spark):
    texts = ["a  b\tc　d e ", "", "  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [len(r.ids) for r in df.select(K.whitespace_tokenize("t").alias("ids")).collect()]
    assert got == [len(t.split()) for t in texts]


def test_pad_batch(spark):
    df = spark.createDataFrame([(1, [5, 6, 7], [1, 1, 1], [-100, 6, 7]), (1, [5], [1], [5])],
                               "b int, input_ids array<int>, attention_mask array<int>, labels array<int>")
    rows = K.pad_batch(df, "b", 4).orderBy(F.size(F.filter("attention_mask", lambda x: x == 1))).collect()
    assert rows[0].input_ids == [5, 0, 0, 0] and rows[0].labels == [5, -100, -100, -100]
    assert rows[1].attention_mask == [1, 1, 1, 0]


def test_pairwise_metrics(spark):
    df = spark.createDataFrame([(0.0, 800.0)], "chosen_score double, rejected_score double")
    assert M.pairwise_logloss(df).first().logloss == pytest.approx(800.0)
    d = spark.createDataFrame([(1.0, 3.0)], "chosen_score double, rejected_score double")
    r = M.pair_distance(d).first()
    assert r.mse == 4.0 and r.mae == 2.0
    assert math.isinf(spark.range(1).select(M.perplexity(F.lit(1000.0)).alias("p")).first().p)


def test_row_index_matches_sort(spark):
    import random
    keys = list(range(1000))
    random.Random(0).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = S.with_row_index(df, ["k"], num_partitions=5).collect()
    assert all(r.row_idx == r.k for r in got)


def test_splits_disjoint_and_complete(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    tr, te = S.random_split(df, 0.1, 42, "k", exact=True)
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert len(b) == 50 and not (a & b) and len(a | b) == 500
    tr, va = S.head_split(df, 10, ["k"])
    assert {r.k for r in va.collect()} == set(range(50))
    tr, ev = S.tail_holdout(df, 100, ["k"])
    assert {r.k for r in ev.collect()} == set(range(400, 500))
    u = S.prompt_union(df.select(F.col("k").cast("string").alias("question")), df.select(F.col("k").cast("string").alias("question")))
    assert u.count() == 500  # dedup is idempotent over a self-union


def test_ensure_validation(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    out = S.ensure_validation({"train": df}, 0.1, 1, "k")
    assert out["validation"].count() == 10
    with pytest.raises(ValueError):
        S.ensure_validation({"validation": df}, 0.0, 1, "k")


def test_reward_pairs_drop_empty(spark):
    df = spark.createDataFrame([(" q ", "c", "r"), ("q", "　", "r"), (None, "c", "r")], "question string, response_chosen string, response_rejected string")
    out = P.to_reward_pairs(df).collect()
    assert len(out) == 1 and out[0].question == "q" and out[0].history == [] and out[0].system == ""


def test_clean_response(spark):
    df = spark.createDataFrame([(" answer </s> tail",), ("no stop ",)], "c string")
    assert [r.x for r in df.select(P.clean_response("c", "</s>").alias("x")).collect()] == ["answer", "no stop"]
    assert df.select(P.clean_response("c", "</s>", strip_output=False).alias("x")).first().x == " answer "


def test_take_n_is_ordered_for_any_n(spark):
    df = spark.range(200).withColumn("k", (F.col("id") * 7919) % 200)
    assert [r.k for r in S.take_n(df, 30, ["k"]).collect()] == list(range(30))
    assert [r.k for r in S.take_n(df, 10**9, ["k"]).collect()] == list(range(200))
    assert [r.id for r in S.shuffle(df, 1, "id").collect()] == [r.id for r in S.sample_n(df, 200, 1, "id").collect()]
    assert S.sample_n(df, 10, 1, "id").count() == 10


def test_with_counts(spark):
    m = spark.range(1).select(F.lit(0.5).alias("loss"))
    r = M.with_counts(m, spark.range(7)).first()
    assert r.loss == 0.5 and r.samples == 7


def test_observe_counts_no_extra_pass(spark, tmp_path):
    df, obs = M.observe_counts(spark.range(10).filter("id % 3 = 0"), "after_filter")
    df.write.parquet(str(tmp_path / "o"))
    assert obs.get == {"after_filter": 4}


@pytest.mark.parametrize("strict", [False, True])
def test_dialog_long_form_equals_array_form(spark, strict):
    import random
    rnd = random.Random(7)
    roles = ["human", "gpt", "human", "gpt", "system", "tool", None]
    convs = [[(rnd.choice(roles) if rnd.random() < 0.3 else ("human", "gpt")[t % 2], f"c{c}t{t}")
              for t in range(rnd.randint(0, 9))] for c in range(300)]
    arr = spark.createDataFrame([(c, [turn(r, v) for r, v in conv], None) for c, conv in enumerate(convs)],
                                "conv_id long, conversations array<struct<from:string,value:string,role:string,content:string>>, system_prompt string")
    a = TU.normalize_dialog(arr, strict=strict).collect()
    exp_convs = {(r.conv_id, r.system, len(r.pairs)) for r in a}
    exp_pairs = {(r.conv_id, k, p.query, p.answer) for r in a for k, p in enumerate(r.pairs)}
    longdf = spark.createDataFrame([(c, t, r, v) for c, conv in enumerate(convs) for t, (r, v) in enumerate(conv)],
                                   "conv_id long, turn long, from string, value string")
    cv, pr = TU.normalize_dialog_long(longdf, strict=strict)
    assert {(r.conv_id, r.system, r.n_pairs) for r in cv.collect()} == exp_convs
    assert {(r.conv_id, r.k, r.query, r.answer) for r in pr.collect()} == exp_pairs


def test_running_sum_equals_window(spark):
    import random
    from pyspark.sql import Window
    rnd = random.Random(3)
    rows = [(g, i, rnd.randint(1, 9)) for g in range(30) for i in range(rnd.randint(1, 5))]
    rows += [(99, i, rnd.randint(1, 9)) for i in range(400)]  # one hot group
    df = spark.createDataFrame(rows, "g long, i long, v long")
    got = {(r.g, r.i): r.running for r in S.with_running_sum(df, ["g", "i"], "v").collect()}
    w = Window.orderBy("g", "i").rowsBetween(Window.unboundedPreceding, 0)
    exp = {(r.g, r.i): r.c for r in df.select("g", "i", F.sum("v").over(w).alias("c")).collect()}
    assert got == exp


def test_sft_examples_long_equals_record_form(spark):
    import random
    rnd = random.Random(5)
    words = ["a", "bb", "c d", "", " ", "e f g h", "i"]
    convs = []
    for c in range(120):
        n = rnd.randint(0, 8)
        convs.append([(("human", "gpt")[t % 2] if rnd.random() > 0.1 else "system", " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12))))
                      for t in range(n)])
    base = TPL.get_template("base")
    arr = spark.createDataFrame([(c, [turn(r, v) for r, v in conv], None) for c, conv in enumerate(convs)],
                                "conv_id long, conversations array<struct<from:string,value:string,role:string,content:string>>, system_prompt string")
    d = TU.normalize_dialog(arr).select("conv_id", TPL.render_dialog("pairs", "system", base).alias("dialog"))
    exp = {(r.conv_id, tuple(r.input_ids), tuple(r.labels)) for r in K.build_sft_examples(d, "dialog", 16, keep=("conv_id",)).collect()}
    longdf = spark.createDataFrame([(c, t, r, v) for c, conv in enumerate(convs) for t, (r, v) in enumerate(conv)],
                                   "conv_id long, turn long, from string, value string")
    cv, pr = TU.normalize_dialog_long(longdf)
    got = {(r.conv_id, tuple(r.input_ids), tuple(r.labels)) for r in K.build_sft_examples_long(cv, pr, base, max_len=16).collect()}
    assert got == exp
