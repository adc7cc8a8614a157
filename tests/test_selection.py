"""The first n rows against a plain sort: any n, any first column, small bins so that they are cut finer."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from alignfold.operators import selection as SEL
from alignfold.operators import splits as S


def values(kind, rng):
    nan, inf = float("nan"), float("inf")
    return {
        "long": lambda: rng.choice([None, 0, 1, -5, rng.randint(-10**18, 10**18), 10**18 + rng.randint(0, 3), rng.randint(0, 9)]),
        "double": lambda: rng.choice([None, nan, inf, -inf, 0.0, -0.0, 1e308, -1e-300, rng.random(), rng.gauss(0, 1e6)]),
        "string": lambda: rng.choice([None, "", "https://example.org/" + "x" * rng.randint(0, 9), "é" * rng.randint(0, 5), "a\0",
                                      "a", "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))]),
        "date": lambda: rng.choice([None, dt.date(1970, 1, 1) + dt.timedelta(days=rng.randint(-9000, 9000))]),
        "timestamp": lambda: rng.choice([None, dt.datetime(2001, 1, 1) + dt.timedelta(seconds=rng.randint(-10**8, 10**8))]),
        "boolean": lambda: rng.choice([None, True, False]),
    }[kind]


@pytest.mark.parametrize("kind", ["long", "double", "string", "date", "timestamp", "boolean"])
@pytest.mark.parametrize("way", ["asc", "desc"])
def test_first_n_of_any_column(spark, kind, way):
    rng = random.Random(kind)
    draw = values(kind, rng)
    rows = [(i, draw()) for i in range(400)] + [(400 + i, rows_value) for i, rows_value in enumerate([draw()] * 200)]
    df = spark.createDataFrame(rows, f"k long, v {kind}").repartition(4).persist()
    want = [r.k for r in df.orderBy(F.col("v").asc() if way == "asc" else F.col("v").desc(), "k").collect()]
    for n in (7, 300, 10_000):
        got = SEL.first_n(df, n, [("v", way), "k"], ranked=20, bins=8)
        assert [r.k for r in got.collect()] == want[:n], n
    assert SEL.first_n(df, 0, ["v"]).count() == 0
    df.unpersist()


def test_empty_table_and_second_column_descends(spark):
    assert SEL.first_n(spark.createDataFrame([], "k long, v string"), 5, ["v"]).count() == 0
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    got = [(r.g, r.id) for r in S.take_n(df, 400, ["g", ("id", "desc")]).collect()]
    assert got == sorted(((i % 3, i) for i in range(1000)), key=lambda x: (x[0], -x[1]))[:400]


def test_no_task_holds_all_that_is_taken(spark):
    df = spark.range(0, 40_000, 1, 8).select("id", (F.col("id") % 7).alias("g"))
    for out, n in ((S.sample_n(df, 20_000, 3, "id"), 20_000), (S.take_n(df, 15_000, ["g", "id"]), 15_000)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan
        assert out.count() == n
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sum(sizes) == n and max(sizes) < n / 3


def test_magnitude_never_falls(spark):
    xs = sorted([-math.inf, -1e308, -1e300, -2.0, -1e-310, 0.0, 1e-310, 0.5, 1.0, 1 + 2**-52, 1e15, 1e15 + 1, 1e308, math.inf])
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*xs, math.nan])], "i long, x double")
    got = [r[0] for r in df.orderBy("i").select(SEL.magnitude(F.col("x"), df.schema["x"].dataType, 0)[0]).collect()]
    assert got == sorted(got) and all(math.isfinite(g) for g in got)
