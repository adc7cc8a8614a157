"""Similarity of every candidate to a set of anchors, by blocks on the executors."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.session import checkpoint_dir, ship_package

BLOCK_BYTES = 32 << 20  # bytes of an anchor block
CANDIDATE_BYTES = 32 << 20  # bytes of candidates for which a task reads all blocks once
ROWS_AT_ONCE = 1024  # candidates of one matrix product
ANCHORS_AT_ONCE = 2048  # anchors of one matrix product


def unit_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows of length one, places of the vectors that they are). A null vector and one with a null or
    non-finite component are left out; a zero vector stays zero."""
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(), 0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    place = np.repeat(np.arange(len(lengths)), lengths)
    bad = np.bincount(place, ~np.isfinite(flat), minlength=len(lengths)) > 0
    there = np.flatnonzero((lengths > 0) & ~bad)
    dims = sorted(set(lengths[there].tolist()))
    if len(dims) > 1:
        raise ValueError(f"vectors of different lengths: {dims}")
    rows = flat[~bad[place]].reshape(len(there), dims[0] if dims else 0)
    rows = rows / np.maximum(np.abs(rows).max(1, initial=0), 1e-300)[:, None]  # so that no square overflows
    norm = np.linalg.norm(rows, axis=1)
    return rows / np.where(norm > 0, norm, 1)[:, None], there


def write_blocks(anchors: DataFrame, vec: str, n_blocks: int) -> list[str]:
    """The anchors' unit vectors as ``n_blocks`` matrices in the shared folder; paths of those that are not empty.

    Each task writes a file of its own name and hands over the name, so what a lost task wrote is not read.
    """
    folder = f"{checkpoint_dir(anchors.sparkSession).rstrip('/')}/alignfold-anchors/{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [m for m in (unit_rows(b.column(0))[0] for b in batches) if len(m)]
        if rows:
            files, base = fs.FileSystem.from_uri(folder)
            files.create_dir(base, recursive=True)
            name = f"{uuid.uuid4().hex}.npy"
            out = io.BytesIO()
            np.save(out, np.concatenate(rows))
            with files.open_output_stream(f"{base}/{name}") as f:
                f.write(out.getbuffer())
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])

    return sorted(r["path"] for r in anchors.select(vec).repartition(n_blocks).mapInArrow(run, "path string").collect())


def read_block(path: str) -> np.ndarray:
    files, base = fs.FileSystem.from_uri(path)
    with files.open_input_file(base) as f:
        return np.load(io.BytesIO(f.read()))


def best_of_blocks(rows: np.ndarray, paths: Sequence[str], k: int) -> np.ndarray:
    """The k greatest products of each row with the rows of all blocks, descending; -inf where there are fewer.

    The blocks are read one after the other, and only the k best of a row are held. A product has at most
    ROWS_AT_ONCE x ANCHORS_AT_ONCE numbers, however many anchors a block has.
    """
    best = np.full((len(rows), k), -np.inf)
    for path in paths:
        block = read_block(path)
        if rows.shape[1] != block.shape[1]:
            raise ValueError(f"candidates of {rows.shape[1]} components, anchors of {block.shape[1]}")
        for a in range(0, len(rows), ROWS_AT_ONCE):
            mine, held = rows[a:a + ROWS_AT_ONCE], best[a:a + ROWS_AT_ONCE]
            for b in range(0, len(block), ANCHORS_AT_ONCE):
                found = mine @ block[b:b + ANCHORS_AT_ONCE].T
                better = np.flatnonzero(found.max(axis=1) > held[:, -1])
                found = found[better]
                if found.shape[1] > k:
                    found = np.partition(found, found.shape[1] - k, axis=1)[:, -k:]
                both = np.concatenate([held[better], found], axis=1)
                held[better] = np.sort(both, axis=1)[:, :-k - 1:-1]
    return best


def with_scores(cand: DataFrame, anchors: DataFrame, vec: str = "embedding", k: int = 5, block_bytes: int = BLOCK_BYTES,
                blocks: int | None = None, max_out: str = "max_sim", mean_out: str = "topk_mean") -> DataFrame:
    """Every row of ``cand`` with its highest cosine similarity to the anchors and the mean of its k highest.

    The anchors are laid out once as matrix blocks in the shared folder, by tasks. A task takes its
    candidates in runs of CANDIDATE_BYTES, reads the blocks one after the other and keeps the k best
    of each row, so nothing goes through the driver but the blocks' paths (one per ``block_bytes`` of
    anchors), no candidate is shuffled and no pair is emitted. The result does not depend on the number
    of blocks. Rows are told apart by themselves, so keys may repeat or be null and have any type.

    Null vectors and those with null or non-finite components are no vectors: candidates get nulls,
    anchors do not count. A zero vector has similarity 0 to all. With fewer than k anchors the mean
    is over all of them, and with none both values are null.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    ship_package(cand.sparkSession)
    if blocks is None:
        size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("dim")).first()
        blocks = max(1, -(-(size["n"] or 0) * max(size["dim"] or 0, 1) * 8 // block_bytes))
    paths = write_blocks(anchors, vec, blocks)
    at, names = cand.columns.index(vec), cand.columns

    def scored(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        real, places = [], []
        for batch in batches:
            rows, there = unit_rows(batch.column(at))
            places.append(there)
            if len(there):
                real.append(rows)
        if len({rows.shape[1] for rows in real}) > 1:
            raise ValueError("vectors of different lengths")
        best = best_of_blocks(np.concatenate(real), paths, k) if real and paths else None
        real.clear()
        start = 0
        for batch, there in zip(batches, places):
            top, mean = np.full(batch.num_rows, np.nan), np.full(batch.num_rows, np.nan)
            if best is not None and len(there):
                mine = best[start:start + len(there)]
                start += len(there)
                known = np.isfinite(mine)
                top[there], mean[there] = mine[:, 0], np.where(known, mine, 0).sum(1) / known.sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top, from_pandas=True), pa.array(mean, from_pandas=True)],
                                             [*names, max_out, mean_out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= CANDIDATE_BYTES:
                yield from scored(held)
                held, size = [], 0
        if held:
            yield from scored(held)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cand.schema.fields)
    return cand.mapInArrow(run, f"{types}, `{max_out}` double, `{mean_out}` double")


def semantic_scores(cand: DataFrame, anchors: DataFrame, key: str = "vec_id", vec: str = "embedding", k: int = 5,
                    blocks: int | None = None) -> DataFrame:
    """Key, ``max_sim`` and ``topk_mean`` of every candidate row (see ``with_scores``)."""
    return with_scores(cand.select(key, vec), anchors, vec, k, blocks=blocks).select(key, "max_sim", "topk_mean")


def semantic_filter(cand: DataFrame, anchors: DataFrame, threshold: float, agg: str = "max", k: int = 5,
                    vec: str = "embedding", blocks: int | None = None) -> DataFrame:
    """F8: the rows of ``cand`` whose max (or top-k mean) similarity to the anchors reaches ``threshold``."""
    scored = with_scores(cand, anchors, vec, k, blocks=blocks, max_out="_max_sim", mean_out="_topk_mean")
    col = "_max_sim" if agg == "max" else "_topk_mean"
    return scored.filter(F.col(col) >= threshold).select(*[F.col(f"`{c}`") for c in cand.columns])
