"""Helpers shared by the corpus operators: staged tables, global row order, salted joins, batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alignfold.session import checkpoint_dir, ship_package

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what every operator here calls a word


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (every executor sees it)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/alignfold-llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id written as decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def label_key(col: str) -> Column:
    """A never-null string key: null is a value of its own, apart from every string."""
    return F.coalesce(F.concat(F.lit("s"), F.col(col)), F.lit("n"))


PID, POS = "_pid", "_pos"


def global_order(df: DataFrame, order: Sequence[Column], out: str, name: str) -> tuple[DataFrame, int]:
    """(df with its 0-based position ``out`` in ``order``, number of rows).

    Rows are range-partitioned and sorted, written once with their place in the partition, and
    get the partition's offset on reading. Only one count per partition reaches the driver, and
    that table (one row per partition) is the only one that is broadcast.
    """
    spark = df.sparkSession
    seq = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage(ranged.withColumn(PID, F.spark_partition_id()).withColumn(
        POS, seq.bitwiseAND(F.lit((1 << 33) - 1))), name)
    counts = sorted((r[0], r[1]) for r in staged.groupBy(PID).count().collect())
    offsets, total = [], 0
    for pid, n in counts:
        offsets.append((pid, total))
        total += n
    off = spark.createDataFrame(offsets or [(0, 0)], f"{PID} int, _off long")
    placed = staged.join(F.broadcast(off), PID).withColumn(out, F.col("_off") + F.col(POS))
    return placed.drop(PID, POS, "_off"), total


def global_order_sums(df: DataFrame, order: Sequence[Column], value: str, out: str, name: str) -> DataFrame:
    """df with ``out``: the sum of ``value`` over all rows before it in ``order``. As ``global_order``."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(PID, F.spark_partition_id())
    at = ranged.columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            v = batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(v) + before
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - v)], [*batch.schema.names, "_before"])
            before = int(upto[-1]) if len(v) else before

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    staged = stage(ranged.mapInArrow(run, f"{types}, _before long"), name)
    offsets, total = [], 0
    for pid, n in sorted((r[0], r[1] or 0) for r in staged.groupBy(PID).agg(F.sum(value)).collect()):
        offsets.append((pid, total))
        total += n
    off = spark.createDataFrame(offsets or [(0, 0)], f"{PID} int, _off long")
    return staged.join(F.broadcast(off), PID).withColumn(out, F.col("_off") + F.col("_before")) \
        .drop(PID, "_off", "_before")


def salted_join(rows: DataFrame, stats: DataFrame, key: str, spread: Column, salts: int = 64) -> DataFrame:
    """Inner join of raw rows with one row per key; a hot key is spread over ``salts`` groups."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def slices(batches: Iterator, max_bytes: int = 8 << 20) -> Iterator:
    """Arrow batches cut into runs of rows of about ``max_bytes`` (a longer row stands alone)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, int(n * max_bytes / max(batch.nbytes, 1)))
        for start in range(0, n, step):
            yield batch.slice(start, step)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def row_key(df: DataFrame) -> Column:
    """128 bits of all columns as text: rows with one key are equal in every column."""
    cols = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]  # the hash skips nulls
    return F.concat(F.hex(F.xxhash64(*cols)), F.lit("-"), F.hex(F.xxhash64(F.lit("second"), *cols)))


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the package shipped to Python workers and the checkpoint folder known."""
    ship_package(spark)
    checkpoint_dir(spark)
    return spark
