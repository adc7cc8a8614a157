"""Property tests, each hypothesis example evaluated as one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alignfold.functions.lexicon import load_lexicon
from alignfold.operators import rewards as R
from alignfold.operators import splits as S
from alignfold.operators import tokens as K

LEX = load_lexicon("clinical")
PIECES = [t for c in ("drug", "symptom", "safety", "danger", "think", "advice") for t in LEX.get(c)][:40] + \
    ["1.", "二、", "\n", " ", "。", "x" * 120, "　"]
SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

texts = st.lists(st.lists(st.sampled_from(PIECES), max_size=60).map("".join), min_size=1, max_size=40)


@SETTINGS
@given(texts)
def test_rewards_in_unit_interval(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, content string")
    out = R.score(df, LEX)
    cols = ["entity", "structure", "safety", "length", "combined"]
    bad = out.filter(" OR ".join(f"{c} < 0 OR {c} > 1" for c in cols)).count()
    assert bad == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=60))
def test_rloo_sums_to_zero(spark, rows):
    df = spark.createDataFrame([(p, g, float(r)) for g, (p, r) in enumerate(rows)], "prompt_id long, gen_id int, reward double")
    sums = R.rloo_advantage(df).groupBy("prompt_id").agg(F.sum("advantage").alias("s")).collect()
    assert all(abs(r.s) < 1e-9 for r in sums)


@SETTINGS
@given(st.lists(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), max_size=8), min_size=1, max_size=20),
       st.sampled_from([16, 64, 512]))
def test_budget_never_exceeds_max(spark, convs, max_len):
    data = [([{"src": [5] * a, "tgt": [6] * b} for a, b in c],) for c in convs]
    df = spark.createDataFrame(data, "t array<struct<src:array<int>,tgt:array<int>>>")
    packed = df.select(K.packed_ids(K.turn_budget("t", max_len)).alias("ids"))
    assert packed.filter(F.size("ids") > max_len).count() == 0


@SETTINGS
@given(st.lists(st.text(max_size=6), min_size=1, max_size=50))
def test_dedup_idempotent(spark, qs):
    df = spark.createDataFrame([(q,) for q in qs], "question string")
    once = S.prompt_union(df)
    twice = S.prompt_union(once, once)
    assert sorted(r.question for r in once.collect()) == sorted(r.question for r in twice.collect()) == sorted(set(qs))
