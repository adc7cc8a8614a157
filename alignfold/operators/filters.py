"""Row filters and data audits (F1, F7, F9-F13); the many-to-anchor similarity join (F8 / J5) is in ``similarity``."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.functions.rows import join_back, join_hot, keep_rows
from alignfold.functions.text import blank, content_hash, count_hits, hash_unit
from alignfold.operators.sketches import CELLS, maybe_frequent

PLACEHOLDER = r"\{[A-Za-z_][A-Za-z0-9_]*\}"


# ---------- F1 / F6 ----------
def min_length(df: DataFrame, col: str, n: int = 8) -> DataFrame:
    """Keep rows whose text has at least n code points."""
    return df.filter(F.length(col) >= n)


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose text is null, empty or white space only."""
    return df.filter(~blank(col))


# ---------- F7 ----------
def keyword_filter(df: DataFrame, col: str, terms: Sequence[str], min_hits: int = 1, out: str | None = "hits"):
    """Keep rows hitting at least ``min_hits`` distinct terms (case-sensitive substrings)."""
    name = out or "_hits"
    res = keep_rows(df.withColumn(name, count_hits(F.col(col), terms)), F.col(name) >= min_hits)
    return res if out else res.drop(name)


# ---------- F9 ----------
def judge_filter(df: DataFrame, score: str, min_score: float) -> DataFrame:
    return df.filter(F.col(score) >= min_score)


def judge_pass_rate(df: DataFrame, score: str, min_score: float) -> Column:
    return F.avg(F.when(F.col(score) >= min_score, 1.0).otherwise(0.0))


# ---------- F10 ----------
def repeated_values(df: DataFrame, col: str, min_count: int, cells: int = CELLS) -> DataFrame:
    """Values repeated at least ``min_count`` times, keyed by a content hash.

    A sketch of fixed size says first which rows may hold one; only their hashes are counted exactly, by a
    partial aggregate (a value that fills a third of the table is combined map-side)."""
    likely = maybe_frequent(df.select(col), col, min_count, cells)
    return (likely.groupBy(content_hash(col).alias("value_hash"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.length(col)).alias("value_len"))
            .filter(F.col("n") >= min_count))


def drop_repeated(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """Drop every row whose value is one of the repeated placeholders (anti-join on the hash)."""
    bad = repeated_values(df, col, min_count).select("value_hash", "n", F.lit(True).alias("_bad"))
    others = [c for c in df.columns if c != col]
    return join_hot(df.withColumn("value_hash", content_hash(col)), bad, ["value_hash"], "n", "left", others) \
        .filter(F.col("_bad").isNull()).drop("value_hash", "_bad")


# ---------- F11 ----------
def unresolved_placeholders(df: DataFrame, col: str, pattern: str = PLACEHOLDER) -> DataFrame:
    return df.filter(F.col(col).rlike(pattern))


# ---------- F12 ----------
def length_match(df: DataFrame, tol: float, chosen: str = "response_chosen", rejected: str = "response_rejected"):
    """Ratio len(rejected) / len(chosen); keep pairs with |ratio - 1| <= tol."""
    ratio = F.try_divide(F.length(rejected).cast("double"), F.length(chosen).cast("double"))
    return df.withColumn("length_ratio", ratio).filter(F.abs(F.col("length_ratio") - 1.0) <= tol)


# ---------- F13 ----------
def fill_quota(base: DataFrame, pool: DataFrame, stratum: str, target: int, seed: int, key: str) -> DataFrame:
    """Rows of ``pool`` that top each stratum of ``base`` up to ``target`` rows, chosen by seeded hash.

    Exact and skew-proof: the pool's strata that have a gap are globally ordered by (stratum, hash)
    with range partitions (a hot stratum spans many partitions), each row's index within its stratum
    is its global index minus the stratum's first index, and rows below the gap are kept. A null
    stratum is one of its own.
    """
    from alignfold.operators.splits import with_row_index

    have = base.groupBy(stratum).agg(F.count(F.lit(1)).alias("_have"))
    open_ = join_back(pool, have.filter(F.col("_have") >= target), [stratum], [key], "left_anti")
    idx = with_row_index(open_, [F.col(stratum), hash_unit(seed, key), F.col(key)], out="_gidx")
    first = idx.groupBy(stratum).agg(F.min("_gidx").alias("_first"))
    gaps = first.join(have.withColumnRenamed(stratum, "_stratum"), F.col(stratum).eqNullSafe(F.col("_stratum")), "left") \
        .select(stratum, "_first", (F.lit(target) - F.coalesce(F.col("_have"), F.lit(0))).alias("_gap"))
    ranked = join_back(idx, gaps, [stratum], [key])
    return ranked.filter(F.col("_gidx") - F.col("_first") < F.col("_gap")).drop("_gidx", "_first", "_gap")
