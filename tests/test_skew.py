"""Hot keys: one group holds a third of all rows. Results stay exact; the row index spreads it."""

import random

from pyspark.sql import functions as F

from alignfold.operators import filters as FL
from alignfold.operators import rewards as R
from alignfold.operators import splits as S


def _skewed(spark, n=3000, seed=11):
    rnd = random.Random(seed)
    rows = [(0 if i < n // 3 else rnd.randint(1, 400), i, float(rnd.randint(0, 20))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "prompt_id long, gen_id int, reward double").repartition(8)


def test_group_operators_exact_on_hot_prompt(spark):
    rows, df = _skewed(spark)
    groups = {}
    for p, g, r in rows:
        groups.setdefault(p, []).append((g, r))
    rloo = {(r.prompt_id, r.gen_id): r.advantage for r in R.rloo_advantage(df).collect()}
    for p, items in groups.items():
        k, s = len(items), sum(r for _, r in items)
        for g, r in items:
            exp = 0.0 if k == 1 else r - (s - r) / (k - 1)
            assert abs(rloo[(p, g)] - exp) < 1e-9
    best = {r.prompt_id: (r.reward, r.gen_id) for r in R.best_of_n(df, payload=()).collect()}
    for p, items in groups.items():
        top = max(r for _, r in items)
        assert best[p] == (top, min(g for g, r in items if r == top))
    ranks = {(r.prompt_id, r.gen_id): (r.rank, r.row_number) for r in R.group_rank(df).collect()}
    hot = sorted(groups[0], key=lambda x: (-x[1], x[0]))
    for pos, (g, r) in enumerate(hot):
        assert ranks[(0, g)] == (1 + sum(1 for _, x in hot if x > r), pos + 1)


def test_row_index_spreads_hot_group(spark):
    rows, df = _skewed(spark)
    idx = S.with_row_index(df, ["prompt_id", "gen_id"], num_partitions=8)
    parts = idx.filter(F.col("prompt_id") == 0).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 2  # the hot third is not confined to one task
    got = sorted((r.prompt_id, r.gen_id, r.row_idx) for r in idx.collect())
    exp = [(p, g, i) for i, (p, g) in enumerate(sorted((p, g) for p, g, _ in rows))]
    assert got == exp


def test_repeated_value_audit_with_hot_value(spark):
    texts = ["placeholder answer"] * 1000 + [f"text {i}" for i in range(2000)] + ["twice"] * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(8)
    rep = {r.n for r in FL.repeated_values(df, "text", 2).collect()}
    assert rep == {1000, 2}
    assert FL.drop_repeated(df, "text", 2).count() == 2000


def test_null_groups_and_rewards_survive_and_nan_is_no_reward(spark):
    nan = float("nan")
    rows = [(1, 1, 0.5), (1, 2, None), (1, 3, nan), (1, 4, 0.1), (None, 5, 0.3), (None, 6, 0.7), (2, 7, None), (3, 8, nan)]
    df = spark.createDataFrame(rows, "prompt_id long, gen_id int, reward double").withColumn("content", F.col("gen_id").cast("string"))
    for op in (R.group_advantage, R.rloo_advantage, R.group_rank):
        assert sorted(r.gen_id for r in op(df).collect()) == list(range(1, 9))
    a = {(r.gen_id, r.rank, r.row_number) for r in R.group_rank(df).collect()}
    assert a == {(r.gen_id, r.rank, r.row_number) for r in R.group_rank(df, method="window").collect()}
    pairs = {r.prompt_id: (r.chosen, r.rejected) for r in R.pairs_from_scores(df).collect()}
    assert pairs == {1: ("1", "4"), None: ("6", "5")}
    best = {r.prompt_id: (r.reward, r.gen_id, r.n) for r in R.best_of_n(df).collect()}
    assert best == {1: (0.5, 1, 4), None: (0.7, 6, 2), 2: (None, None, 1), 3: (None, None, 1)}


def test_join_back_spreads_the_hot_key(spark):
    n, parts = 24_000, 16
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, (str(parts), "-1", "false")):
            spark.conf.set(k, v)
        df = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit(None).cast("long")).otherwise(F.col("id") % 3001)
                                   .alias("prompt_id"), F.col("id").cast("int").alias("gen_id"), F.rand(1).alias("reward"))
        for out in (R.group_advantage(df), R.rloo_advantage(df)):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == n and max(sizes) < 3 * n / parts  # the hot third alone would be n / 3
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_null_stratum_and_null_batch(spark):
    base = spark.createDataFrame([("a",)] * 3 + [(None,)], "s string")
    pool = spark.createDataFrame([(i, x) for i, x in enumerate(["a"] * 5 + [None] * 5 + ["b"] * 5 + ["c"])], "k long, s string")
    got = {}
    for r in FL.fill_quota(base, pool, "s", 3, 1, "k").collect():
        got[r.s] = got.get(r.s, 0) + 1
    assert got == {None: 2, "b": 3, "c": 1}
    train = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i long, t string")
    assert sorted(r.i for r in S.overlap_rows(train, train.filter("i <> 3"), "t").collect()) == [1, 2]


def test_join_hot_is_exact_and_copies_nothing(spark):
    from alignfold.functions.rows import join_hot

    n, parts = 24_000, 16
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, (str(parts), "-1", "false")):
            spark.conf.set(k, v)
        # one column, and a third of its rows are equal: nothing but the task tells them apart
        one = spark.range(n).repartition(48).select(
            F.when(F.col("id") < n // 3, F.lit(None).cast("long")).otherwise(F.col("id") % 3001).alias("k"))
        stats = one.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.count(F.lit(1)).alias("times"))
        out = join_hot(one, stats.filter("k IS NULL OR k % 2 = 0"), ["k"], "c", hot_rows=1000)
        assert out.columns == ["k", "times"]
        sizes = {r["p"]: r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()}
        want = one.filter("k IS NULL OR k % 2 = 0").groupBy("k").count().collect()
        assert sum(sizes.values()) == sum(r["count"] for r in want) and max(sizes.values()) < 3 * n / parts
        got = {(r.k, r.times): r["count"] for r in out.groupBy("k", "times").count().collect()}
        assert got == {(r.k, r["count"]): r["count"] for r in want}
        left = join_hot(one, stats.filter("k = 7"), ["k"], "c", "left", hot_rows=1)
        assert left.count() == n and {r.k for r in left.filter("times IS NOT NULL").collect()} == {7}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
