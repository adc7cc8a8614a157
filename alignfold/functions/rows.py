"""Row-level helpers shared by operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Row filter evaluated in place, as a generator over a 0/1-element array.

    A ``Filter`` above a deterministic projection is pushed below it with the projection
    inlined, so an expensive column (a token pipeline, a long ``contains`` chain) would be
    computed once for the predicate and again for the output. A generator is not pushed
    through, so the column is computed once per row.
    """
    flag = F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return df.withColumn("_keep", F.explode(flag)).drop("_keep")


def spread_of(columns: Sequence[str]) -> Column:
    """A number that differs between rows: the hash of ``columns`` and of the task's partition, so that
    equal rows and frames of one column are spread too. A repeated task gives its rows the same numbers."""
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in columns])


def join_back(rows: DataFrame, stats: DataFrame, keys: Sequence[str], spread: Sequence[str] = (), how: str = "inner",
              salts: int = 32) -> DataFrame:
    """Raw rows joined with one row per key, with the rows of every key spread over ``salts`` groups.

    An aggregate above its exchange is no plain shuffle stage, so adaptive skew splitting does not
    act on such a join. The small side is repeated ``salts`` times and each row picks one by the hash
    of its ``spread`` columns and its partition. Keys are compared null-safely: no row is lost for a
    null key. With ``how='left_semi'`` / ``'left_anti'`` the rows are filtered. Where the rows of each key
    are counted, ``join_hot`` needs no copies.
    """
    salt = F.pmod(spread_of(spread), F.lit(salts)).cast("int")
    left = rows.withColumn("_salt", salt)
    right = stats.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                         *[c for c in stats.columns if c not in keys]) \
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cond = F.col("_salt") == F.col("_copy")
    for i, k in enumerate(keys):
        cond &= left[k].eqNullSafe(F.col(f"_key{i}"))
    return left.join(right, cond, how).drop("_salt", "_copy", *[f"_key{i}" for i in range(len(keys))])


#: A key is hot from this part of an even shuffle partition on; a table has at most
#: HOT_PARTS x spark.sql.shuffle.partitions such keys.
HOT_PARTS = 4


def join_hot(rows: DataFrame, stats: DataFrame, keys: Sequence[str], count: str, how: str = "inner",
             spread: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Rows joined with one row per key, which says in ``count`` how many rows have the key.

    The statistics of hot keys are broadcast; they are few, as each has a set part of all rows that ``stats``
    counts (or ``hot_rows`` rows). All others meet their rows in a shuffle, over which the rows of hot keys
    are dealt evenly, as they match nothing there. So no row of ``stats`` is copied. Rows of a hot key go by
    their task's partition, and by ``spread`` columns if given. Keys are compared null-safely. ``how`` is
    ``inner`` or ``left``; ``count`` is not in the result.
    """
    if hot_rows is None:
        parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        total = stats.agg(F.sum(count)).scalar()
        is_hot = F.coalesce(F.col(count) * F.lit(HOT_PARTS * parts) >= total, F.lit(False))
    else:
        is_hot = F.col(count) >= hot_rows
    names = [c for c in stats.columns if c not in (*keys, count)]
    packed = F.struct(F.lit(True).alias("there"), *[F.col(f"`{c}`") for c in names])

    def side(part: DataFrame, out: str) -> DataFrame:
        return part.select(*[F.col(f"`{k}`").alias(f"_{out}{i}") for i, k in enumerate(keys)], packed.alias(f"_{out}"),
                           *[c for c in part.columns if c == "_zero"])

    def same(out: str) -> Column:
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond &= F.col(f"`{k}`").eqNullSafe(F.col(f"_{out}{i}"))
        return cond

    hot = side(stats.filter(is_hot), "hot")
    # a literal 0 would be no key of the shuffle: the optimizer makes it a condition on the rows' side alone
    cold = side(stats.filter(~is_hot).withColumn("_zero", F.shiftright(F.col(count), 62)), "cold")
    met = rows.join(F.broadcast(hot), same("hot"), "left")
    # 0 looks for its key in the shuffle; any other number only says where a row goes
    met = met.withColumn("_at", F.when(F.col("_hot").isNotNull(), spread_of(spread).bitwiseOR(F.lit(1))).otherwise(F.lit(0)))
    met = met.join(cold, same("cold") & (F.col("_at") == F.col("_zero")), "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    if how == "inner":
        met = met.filter(found.isNotNull())
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], *[found[c].alias(c) for c in names])
