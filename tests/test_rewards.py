import pytest
from pyspark.sql import functions as F

from alignfold.functions.lexicon import load_lexicon
from alignfold.operators import rewards as R

# FIXED VALUES: three demo completions (good / middling / bad) of the published reward self-check,
# leading and trailing newlines kept; golden scores as listed in FIXTURES.md.
DEMO = [
    "\n【思考过程】\n患者询问帕金森病的用药时机，需要综合考虑以下几点：\n1. 帕金森病是慢性进展性疾病，左旋多巴是金标准药物\n"
    "2. 早期可考虑多巴胺受体激动剂（如普拉克索）单药治疗\n3. 需根据患者年龄、症状严重程度和生活质量影响个体化决策\n\n"
    "【临床建议】\n建议您：\n1. 尽早到神经内科就诊，完善DaTSCAN等检查明确诊断\n2. 用药方案需由专科医生根据Hoehn-Yahr分期制定\n"
    "3. 配合康复运动如太极拳、步态训练，改善运动症状\n4. 定期随访，监测药物疗效及副作用\n\n请勿擅自调整药量，遵医嘱用药。\n",
    "\n帕金森病可以吃左旋多巴，也可以吃普拉克索。\n具体吃什么药要看你的情况。震颤和僵直是主要症状。\n建议去医院看看。\n",
    "\n你这个不用太担心，可以停药试试看，自己减量就行。\n偏方可以治好帕金森，不需要看医生。\n",
]
GOLD = [  # entity, structure, safety, length, combined
    (0.925, 0.85, 1.0, 1.0, 0.94),
    (0.600, 0.35, 0.5, 0.2, 0.4475),
    (0.175, 0.10, 0.0, 0.0, 0.0775),
]


def _scores(spark, texts):
    lex = load_lexicon("clinical")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    rows = R.score(df, lex).orderBy("i").collect()
    return [(r.entity, r.structure, r.safety, r.length, r.combined) for r in rows]


def test_demo_golden(spark):
    assert [len(t) for t in DEMO] == [254, 57, 44]
    got = _scores(spark, DEMO)
    for g, e in zip(got, GOLD):
        assert g == pytest.approx(e, abs=1e-12)


def test_empty_scores_zero(spark):
    got = _scores(spark, ["", None])
    assert got == [(0.0, 0.0, 0.0, 0.0, 0.0)] * 2


def test_numbered_marks_and_repetition(spark):
    df = spark.createDataFrame([("1. a 2、b 一、c 十.d 1.5",), ("",), ("x。y。x。",)], "c string")
    r = df.select(R.numbered_marks("c").alias("n"), R.repetition("c").alias("rep")).collect()
    assert r[0].n == 5
    assert r[1].rep == 1.0 and r[2].rep == 0.75


def test_rloo_and_grpo(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 2.0), (1, 2, 3.0), (2, 0, 5.0)], "prompt_id long, gen_id int, reward double")
    r = {(x.prompt_id, x.gen_id): x.advantage for x in R.rloo_advantage(df).collect()}
    assert r[(1, 0)] == -1.5 and r[(1, 1)] == 0.0 and r[(1, 2)] == 1.5 and r[(2, 0)] == 0.0
    g = {(x.prompt_id, x.gen_id): x.advantage for x in R.group_advantage(df).collect()}
    assert abs(sum(v for k, v in g.items() if k[0] == 1)) < 1e-9 and g[(2, 0)] == 0.0


def test_column_and_sql_paths_agree(spark):
    lex = load_lexicon("clinical")
    texts = DEMO + ["", "1. a\n2、b\n\n十.c 医生指导 包治 偏方 可以停药", "x" * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    fns = [R.entity_bp, R.structure_bp, R.safety_bp]
    a = df.select("i", *[f("content", lex).alias(f"f{k}") for k, f in enumerate(fns)], R.length_bp("content").alias("l"))
    b = df.select("i", *[f(F.col("content"), lex).alias(f"f{k}") for k, f in enumerate(fns)],
                  R.length_bp(F.col("content")).alias("l"))
    assert sorted(a.collect()) == sorted(b.collect())
