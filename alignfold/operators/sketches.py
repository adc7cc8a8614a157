"""Small mergeable sketches that say which rows need not be shuffled. What they let through is checked exactly.

Both are ordinary partial aggregates over a fixed number of cells, so neither grows with the data: what a task
sends is at most one row a cell, and what is broadcast is at most the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 20  # 16 bytes each where they are broadcast
SEEDS = (17, 71)


def cell(seed: int, col: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), col.isNull(), col), F.lit(cells)).cast("int")


def maybe_frequent(df: DataFrame, col: str, min_count: int, cells: int = CELLS) -> DataFrame:
    """The rows of ``df`` whose value may occur ``min_count`` times or more (a count-min sketch of two lines).

    A cell counts all rows that fall in it, so no frequent value is left out; a rare one stays if it shares
    a full cell in both lines. With many more than ``cells`` x ``min_count`` rows all cells are full and all
    rows stay.
    """
    value = F.col(col)
    marked = df.select(*[F.struct(F.lit(i).alias("line"), cell(s, value, cells).alias("cell")).alias(f"c{i}") for i, s in enumerate(SEEDS)])
    full = marked.select(F.explode(F.array("c0", "c1")).alias("c")).groupBy("c.line", "c.cell").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") >= min_count)
    out = df
    for i, seed in enumerate(SEEDS):
        held = full.filter(F.col("line") == i).select(F.col("cell").alias(f"_cell{i}"))  # at most ``cells`` numbers
        out = out.join(F.broadcast(held), cell(seed, value, cells) == F.col(f"_cell{i}"), "left_semi")
    return out


def bits_of(col: Column, words: int) -> tuple[Column, Column]:
    """(word of the filter, four bits in it) of a value."""
    h = F.xxhash64(F.lit(SEEDS[0]), col.isNull(), col)
    mask = F.lit(0).cast("long")
    for turn in range(4):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 16 + 6 * turn).bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(F.xxhash64(F.lit(SEEDS[1]), col.isNull(), col), F.lit(words)), mask


def maybe_in(df: DataFrame, col: str, other: DataFrame, other_col: str, words: int = CELLS) -> DataFrame:
    """The rows of ``df`` whose value may be among those of ``other`` (a Bloom filter of ``words`` x 64 bits).

    A value sets four bits of one word. Its words are put together by an aggregate and met in a broadcast;
    no row with a common value is left out, and nulls are a value. With many more than 16 values a word
    most bits are set and most rows stay.
    """
    word, mask = bits_of(F.col(other_col), words)
    held = other.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    word, mask = bits_of(F.col(col), words)
    return df.join(F.broadcast(held), (word == F.col("_word")) & (F.col("_bits").bitwiseAND(mask) == mask), "left_semi")
