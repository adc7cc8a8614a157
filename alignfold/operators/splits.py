"""Set operations, ordering, sampling and splits (T1-T14, J4) plus a distributed row index.

Order-dependent operators (head, tail, head-percent, exact split) take explicit
order columns: a DataFrame has no file order. None of them uses an unpartitioned
window; the global row index is built from range partitions (see ``with_row_index``).
"""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.functions.rows import join_hot
from alignfold.functions.text import col_of, content_hash, hash_unit, seeded_key
from alignfold.operators.selection import OrderItem, first_n, sort_columns
from alignfold.operators.sketches import CELLS, maybe_in
from alignfold.session import cut_lineage

IDX = "row_idx"


# ---------- T1 / T2 / T3 / T4 ----------
def prompt_union(*dfs: DataFrame, col: str = "question") -> DataFrame:
    """Union of prompt lists with exact dedup (one partial + final hash aggregate)."""
    u = dfs[0].select(col)
    for d in dfs[1:]:
        u = u.unionByName(d.select(col))
    return u.dropDuplicates([col])


def build_prompt_set(*question_sets: DataFrame, min_len: int = 8, col: str = "question",
                     sort: bool = True) -> DataFrame:
    """Union + dedup + minimum length (inclusive, code points) + text sort; records {question, answer: ''}."""
    u = prompt_union(*question_sets, col=col).filter(F.length(col) >= min_len)
    u = u.select(F.col(col).alias("question"), F.lit("").alias("answer"))
    return u.orderBy("question") if sort else u


def source_overlap(a: DataFrame, b: DataFrame, col: str = "question") -> DataFrame:
    """Counts of only-a, only-b and both in one aggregation pass (instead of three set operations)."""
    u = (a.select(F.col(col).alias("_q"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
         .unionByName(b.select(F.col(col).alias("_q"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per = u.groupBy("_q").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return per.agg(
        F.sum(F.when((F.col("_a") == 1) & (F.col("_b") == 0), 1).otherwise(0)).cast("long").alias("only_a"),
        F.sum(F.when((F.col("_a") == 0) & (F.col("_b") == 1), 1).otherwise(0)).cast("long").alias("only_b"),
        F.sum(F.when((F.col("_a") == 1) & (F.col("_b") == 1), 1).otherwise(0)).cast("long").alias("both"))


def intersect_prompts(a: DataFrame, b: DataFrame, col: str = "question") -> DataFrame:
    return a.select(col).intersect(b.select(col))


def except_prompts(a: DataFrame, b: DataFrame, col: str = "question") -> DataFrame:
    return a.select(col).subtract(b.select(col))


# ---------- T6 / T7 / T8 ----------
def shuffle(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Seeded, engine-independent shuffle: order by md5(seed:key), ties by key."""
    return df.orderBy(seeded_key(seed, key), F.col(key))


def take_n(df: DataFrame, n: int | None, order: Sequence[OrderItem]) -> DataFrame:
    """Head-n in a declared order, sorted; n <= 0 or None means all rows (capped at the row count).

    ``order`` holds names, columns or (column, "desc"). See ``selection.first_n``."""
    return df.orderBy(*sort_columns(order)) if n is None or n <= 0 else first_n(df, n, order)


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Shuffled sample of exactly min(n, rows) rows (seeded md5 order, ties by key)."""
    return first_n(df, int(n), [seeded_key(seed, key), F.col(key)])


# ---------- row index (2.5.1) ----------
def with_row_index(df: DataFrame, order_cols: Sequence, out: str = IDX, num_partitions: int | None = None,
                   checkpoint: bool = True) -> DataFrame:
    """0-based global row index in ``order_cols`` order without an unpartitioned window.

    Range-partition + sort within partitions, checkpoint (so the two passes see the
    same partitions even after an executor loss), count rows per partition (one small
    row per partition reaches the driver), prefix-sum, and add the in-partition position.
    ``order_cols`` must give a total order (add a unique tiebreaker).
    """
    spark = df.sparkSession
    cols = [col_of(c) for c in order_cols]
    n_parts = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
    if checkpoint:
        ranged = cut_lineage(ranged)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    counts = sorted((r["_pid"], r["n"]) for r in tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for pid, n in counts:
        offsets.append((pid, acc))
        acc += n
    if not offsets:
        return tagged.drop("_pid", "_pos").withColumn(out, F.lit(None).cast("long"))
    off = spark.createDataFrame(offsets, "_pid int, _off long")
    # the offsets table has one row per partition: a bounded, known size, safe to broadcast
    return (tagged.join(F.broadcast(off), "_pid").withColumn(out, F.col("_off") + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))


def with_running_sum(df: DataFrame, order_cols: Sequence, value: str, out: str = "running",
                     num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order_cols`` order, without a per-group window.

    Same two passes as ``with_row_index``; the in-partition cumulative sum is a window over
    the Spark partition id, so each window holds one range partition, never one group.
    Pass a narrow frame (keys + value) and join the result back: the window's exchange then
    moves only those columns.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    cols = [col_of(c) for c in order_cols]
    n_parts = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = cut_lineage(df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols))
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    sums = sorted((r["_pid"], r["s"] or 0) for r in tagged.groupBy("_pid").agg(F.sum(value).alias("s")).collect())
    offsets, acc = [], 0
    for pid, v in sums:
        offsets.append((pid, acc))
        acc += v
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    w = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (tagged.join(F.broadcast(off), "_pid").withColumn(out, F.col("_off") + F.sum(value).over(w))
            .drop("_pid", "_pos", "_off"))


# ---------- T9 / T10 / T11 / T12 ----------
def random_split(df: DataFrame, frac: float, seed: int, key: str, exact: bool = False):
    """Seeded (train, test) split. Default: hash bucket < frac (no sort, no count).

    ``exact``: test is the ceil(n * frac) rows with the smallest seeded hash, like a
    library split whose test size rounds up.
    """
    if not exact:
        u = hash_unit(seed, key)
        return df.filter(u >= frac), df.filter(u < frac)
    idx = with_row_index(df, [seeded_key(seed, key), F.col(key)])
    n = idx.count()
    k = int(math.ceil(n * frac))
    return idx.filter(F.col(IDX) >= k).drop(IDX), idx.filter(F.col(IDX) < k).drop(IDX)


def head_split(df: DataFrame, pct: float, order_cols: Sequence[str]):
    """(train, validation): the first round(n * pct / 100) rows in order go to validation."""
    idx = with_row_index(df, order_cols)
    n = idx.count()
    k = int(round(n * pct / 100.0))
    return idx.filter(F.col(IDX) >= k).drop(IDX), idx.filter(F.col(IDX) < k).drop(IDX)


def tail_holdout(df: DataFrame, n: int, order_cols: Sequence[str]):
    """(train, eval): the last n rows in order are held out for evaluation."""
    idx = with_row_index(df, order_cols)
    total = idx.count()
    cut = max(total - n, 0)
    return idx.filter(F.col(IDX) < cut).drop(IDX), idx.filter(F.col(IDX) >= cut).drop(IDX)


def ensure_validation(splits: Mapping[str, DataFrame], frac: float, seed: int, key: str,
                      required: Sequence[str] = ("train", "validation")) -> dict:
    """Split only when no validation set is given; fail when a required split is absent."""
    out = dict(splits)
    if "validation" not in out and "train" in out and frac > 0:
        out["train"], out["validation"] = random_split(out["train"], frac, seed, key, exact=True)
    missing = [s for s in required if s not in out]
    if missing:
        raise ValueError(f"missing split(s): {missing}")
    return out


def prompt_set_funnel(a: DataFrame, b: DataFrame, min_len: int = 8, col: str = "question") -> DataFrame:
    """M1 for the prompt-set build in one aggregation pass: rows per source, after dedup,
    after the length filter (instead of one job per stage)."""
    u = (a.select(F.col(col).alias("_q"), F.lit(1).alias("_a"), F.lit(0).alias("_b"))
         .unionByName(b.select(F.col(col).alias("_q"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    per = u.groupBy("_q").agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    tot = per.agg(F.sum("_na").alias("n0"), F.sum("_nb").alias("n1"), F.count(F.lit(1)).alias("n2"),
                  F.sum(F.when(F.length("_q") >= min_len, 1).otherwise(0)).alias("n3"))
    names = ["sft_questions", "preference_questions", "after_dedup", "after_min_length"]
    rows = F.stack(F.lit(4), *[x for i, nm in enumerate(names) for x in (F.lit(i), F.lit(nm), F.col(f"n{i}").cast("long"))])
    return tot.select(rows.alias("step", "stage", "n"))


# ---------- T13 / T14 / J4 ----------
def fan_out(df: DataFrame, k: int, out: str = "gen_id") -> DataFrame:
    """k generation slots per prompt (1..k)."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(int(k)))))


def union_sources(sources: Mapping[str, DataFrame], col: str = "question") -> DataFrame:
    """Multi-source union with a provenance column."""
    out = None
    for name, d in sources.items():
        part = d.select(F.col(col), F.lit(name).alias("source"))
        out = part if out is None else out.unionByName(part)
    return out


def overlap_rows(train: DataFrame, val: DataFrame, key: str, words: int = CELLS) -> DataFrame:
    """Rows of train whose content also occurs in val.

    A Bloom filter of val's contents is tested in the scan of train, so about the rows that overlap are
    shuffled; an exact join on a 64-byte content hash follows, with the hot contents of train spread and
    no content of val copied. A null content is one content."""
    likely = maybe_in(train, key, val, key, words).withColumn("_h", content_hash(key))
    v = val.select(content_hash(key).alias("_v")).distinct()
    both = likely.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).join(v, F.col("_h").eqNullSafe(F.col("_v")), "left_semi")
    others = [c for c in train.columns if c != key]
    return join_hot(likely, both, ["_h"], "_n", spread=others).drop("_h")
