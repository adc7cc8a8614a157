"""Proportional stratified interleaving: shards that all show the corpus' mixture of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import global_order, label_key, salted_join, stage


def interleave_shards(df: DataFrame, n_shards: int, seed: int = 17, id_col: str = "doc_id",
                      source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``df`` (id, source and ``carry`` columns) with ``shard`` and gapless ``slot``.

    Rows are shuffled by a seeded hash within their source and get the fractional rank
    (rank + 1/2) / rows of the source. The order by fractional rank shows every stretch the
    sources in proportion; it is cut into ``n_shards`` runs whose row counts differ by one at
    most, and the position in the run is the slot. Text never moves: pass the narrow columns
    that the result needs in ``carry``.

    A source of any size is spread over the range partitions by its hash. A null source is a
    source of its own, a null id is hashed as null, and rows equal in all carried columns are
    interchangeable (any order among them gives the same result). No rows, no shards.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    narrow = df.select(F.col(id_col), F.col(source_col), *[F.col(c) for c in carry]).select(
        "*", label_key(source_col).alias("_source"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_shuffle"))
    ties: list[Column] = [F.col(c) for c in ("_shuffle", id_col, *carry)]
    ranked, _ = global_order(narrow, [F.col("_source"), *ties], "_at", "shard-rank")
    sizes = stage(ranked.groupBy("_source").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")),
                  "shard-sources")
    mixed = salted_join(ranked, sizes, "_source", F.col("_shuffle")).withColumn(
        "_fraction", (F.col("_at") - F.col("_first") + 0.5) / F.col("_rows"))
    placed, total = global_order(mixed.drop("_at", "_first", "_rows"),
                                 [F.col("_fraction"), F.col("_source"), *ties], "_at", "shard-mix")
    cut = placed.withColumn("shard", F.expr(f"cast(_at * {n_shards} div {max(total, 1)} as int)"))
    start = F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")  # first position of the shard
    return cut.select(id_col, source_col, *carry, "shard", (F.col("_at") - start).alias("slot"))
