"""Codes of vectors cut into parts, one codebook a part, trained by Lloyd rounds on two trees.

Vectors are gathered into blocks and each part of a block gets a tree: a node has the box, the number and
the sum of its parts. A round makes a tree of the codebook's entries too and walks both at once. The
distances between two boxes bound those of all pairs below them, so entries that are farther than some
other entry's worst case are left out for the whole node; a node with one entry left is assigned as one,
by its cached sum; what is uncertain in a leaf is decided by integer distances. All numbers are integers,
so a round's sums do not depend on the order in which tasks add them.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import free_name, prepared, slices, stage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
BLOCK = 4096  # vectors of a block
LEAF = 32  # vectors of a leaf, unless they are all equal


@dataclass
class Tree:
    """Points in the order of a tree's leaves. Children stand side by side; a leaf has none (-1)."""

    order: np.ndarray  # the points' former places
    points: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, leaf: int) -> Tree:
        """Nodes of more than ``leaf`` points are halved at the median of their widest side."""
        order, nodes = np.arange(len(points)), [(0, len(points))]
        child, low, high = [], [], []
        for begin, end in nodes:  # grows while it is walked
            held = points[order[begin:end]]
            lo, hi = held.min(0, initial=2**62), held.max(0, initial=-2**62)
            low.append(lo)
            high.append(hi)
            wide = hi - lo
            if end - begin <= leaf or (not wide.any() and leaf > 1):
                child.append(-1)
                continue
            half = (end - begin) // 2
            order[begin:end] = order[begin:end][np.argpartition(held[:, wide.argmax()], half)] if wide.size else order[begin:end]
            child.append(len(nodes))
            nodes += [(begin, begin + half), (begin + half, end)]
        at = np.array(nodes)
        return cls(order, points[order], at[:, 0], at[:, 1], np.array(child), np.array(low), np.array(high))

    def __post_init__(self) -> None:
        upto = np.concatenate([np.zeros((1, self.points.shape[1]), np.int64), np.cumsum(self.points, 0, dtype=np.int64)])
        self.sums = upto[self.end] - upto[self.begin]
        self.width = (self.high - self.low).max(1, initial=0)


def bounds(a: Tree, i: np.ndarray, b: Tree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between points of nodes ``i`` of one tree and ``j`` of another."""
    over, under = b.low[j] - a.high[i], a.low[i] - b.high[j]
    gap = np.maximum(np.maximum(over, under), 0)
    far = np.maximum(np.abs(b.high[j] - a.low[i]), np.abs(a.high[i] - b.low[j]))
    return (gap * gap).sum(1), (far * far).sum(1)


def firsts(x: np.ndarray) -> np.ndarray:
    """Places at which a sorted array's values begin."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def assign(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(nearest entry of each point in the tree's order, lower numbers first on ties; sums and numbers of the
    points of each entry; how many points were assigned by whole nodes)."""
    nearest = np.zeros(len(tree.points), np.int64)
    sums, counts, wholesale = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64), 0
    if not len(nearest):
        return nearest, sums, counts, 0
    codes = Tree.build(entries, 1)
    single = codes.child < 0
    node, code, cap = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(len(tree.begin), 2**62)
    uncertain = []
    while len(node):
        near, far = bounds(tree, node, codes, code)
        at = firsts(node)
        which = node[at]
        cap[which] = np.minimum(cap[which], np.minimum.reduceat(far, at))
        stays = near <= cap[node]
        node, code = node[stays], code[stays]
        at = firsts(node)
        which, of = node[at], np.repeat(np.arange(len(at)), np.diff(np.append(at, len(node))))
        open_ = ~single[code]
        any_open = np.maximum.reduceat(open_, at)
        alone = (np.bincount(of) == 1) & ~any_open
        for n, e in zip(which[alone], codes.order[codes.begin[code[at[alone]]]]):
            a, b = tree.begin[n], tree.end[n]
            nearest[a:b] = e
            sums[e] += tree.sums[n]
            counts[e] += b - a
            wholesale += int(b - a)
        leaf = tree.child[which] < 0
        widest = np.maximum.reduceat(np.where(open_, codes.width[code], -1), at)
        halve = ~alone & ~leaf & (~any_open | (tree.width[which] > widest))
        done = ~alone & leaf & ~any_open
        if done.any():
            rows = done[of]
            uncertain.append((node[rows], codes.order[codes.begin[code[rows]]]))
        parts = []
        grow = (~alone & ~halve & ~done)[of]
        n, c = node[grow], code[grow]
        parts += [(n[single[c]], c[single[c]])]
        n, c = n[~single[c]], codes.child[c[~single[c]]]
        parts += [(n, c), (n, c + 1)]
        rows = halve[of]
        n, c = tree.child[node[rows]], code[rows]
        cap[tree.child[which[halve]]] = cap[tree.child[which[halve]] + 1] = cap[which[halve]]
        parts += [(n, c), (n + 1, c)]
        node, code = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(node, kind="stable")
        node, code = node[order], code[order]
    if uncertain:
        settle(tree, entries, uncertain, nearest, sums, counts)
    return nearest, sums, counts, wholesale


def settle(tree: Tree, entries: np.ndarray, uncertain: list, nearest: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Leaves with several entries left: integer distances of each point to each of them."""
    node, entry = (np.concatenate(x) for x in zip(*uncertain))
    order = np.lexsort((entry, node))  # entries ascend, so that the first least one has the lowest number
    node, entry = node[order], entry[order]
    most = 2 * max(int(np.abs(tree.points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    # doubles hold integers below 2 to the 53rd exactly and are multiplied faster
    kind = np.float64 if entries.shape[1] * most * most < 1 << 52 else np.int64
    points, codes = tree.points.astype(kind), entries.astype(kind)
    norms = (codes * codes).sum(1)
    at = firsts(node)
    for a, b in zip(at, np.append(at[1:], len(node))):
        rows, held = slice(tree.begin[node[a]], tree.end[node[a]]), entry[a:b]
        nearest[rows] = held[(norms[held] - 2 * (points[rows] @ codes[held].T)).argmin(1)]
    uncertain_rows = np.concatenate([np.arange(tree.begin[n], tree.end[n]) for n in node[at]])
    np.add.at(sums, nearest[uncertain_rows], tree.points[uncertain_rows])
    counts += np.bincount(nearest[uncertain_rows], minlength=len(counts))


def integers(column: pa.Array) -> np.ndarray:
    """floor(SCALE * x) of every component, one row a vector. A vector of another length is an error, and so
    are components whose squared distances would not fit 64 bits."""
    lengths = np.diff(column.offsets.to_numpy())
    if len(set(lengths.tolist())) > 1 or lengths[0] % PARTS:
        raise ValueError(f"vectors must all have one length that {PARTS} divides, not {sorted(set(lengths.tolist()))}")
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(x) and lengths[0] * (2 * float(np.abs(x).max())) ** 2 >= 2.0**62:
        raise ValueError("components are too large for 64-bit squared distances")
    return x.astype(np.int64).reshape(len(lengths), int(lengths[0]))


def usable(df: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and has only finite components."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.coalesce(F.col(vector_col).isNotNull() & fine, F.lit(False)))


def packed(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{name}{i}": getattr(t, name) for i, t in enumerate(trees) for name in Tree.__dataclass_fields__})
    return out.getvalue()


def unpacked(raw: bytes) -> list[Tree]:
    with np.load(io.BytesIO(raw)) as got:
        return [Tree(*(got[f"{name}{i}"] for name in Tree.__dataclass_fields__)) for i in range(PARTS)]


def blocks(rows: DataFrame) -> DataFrame:
    """One row for each block of at most BLOCK vectors (the last column of ``rows``): the other columns as
    arrays, and the trees of the vectors' parts. Built once and staged; every round reads it."""
    carried = rows.schema.fields[:-1]
    names = [f.name for f in carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def made(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).combine_chunks()
            ints = integers(table.column(len(names)).combine_chunks())
            lists = [pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table.column(i).combine_chunks())
                     for i in range(len(names))]
            trees = [Tree.build(np.ascontiguousarray(p), LEAF) for p in np.split(ints, PARTS, axis=1)]
            return pa.RecordBatch.from_arrays([*lists, pa.array([packed(trees)], pa.binary())], [*names, "trees"])

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                if n + part.num_rows > BLOCK:
                    yield made(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield made(held)

    types = ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in carried)
    return stage(rows.mapInArrow(run, f"{types}{', ' if types else ''}trees binary"), "vector-blocks")


def lloyd_round(held: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round. Tasks add up their blocks; the driver gets the entries' sums alone."""
    sent = held.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(c.shape, np.int64) for c in sent.value]
        counts = [np.zeros(len(c), np.int64) for c in sent.value]
        for batch in batches:
            for raw in batch.column(0):
                for i, tree in enumerate(unpacked(raw.as_py())):
                    _, more, n, _ = assign(tree, sent.value[i])
                    sums[i] += more
                    counts[i] += n
        rows = [(i, e, int(counts[i][e]), sums[i][e].tolist()) for i in range(PARTS) for e in np.flatnonzero(counts[i])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], ["part", "entry", "n", "sums"])

    added = held.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    each = added.select("part", "entry", "n", F.posexplode("sums").alias("place", "x"))
    new = [c.copy() for c in codebooks]
    for r in each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():
        new[r["part"]][r["entry"], r["place"]] = r["x"] // r["n"]
    return new


def digest(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def encode(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           carry: tuple[str, ...] = ()) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, ``carry``, ``code`` and ``error`` of every row with a usable vector; the final codebooks).

    Rows whose vector is null or has null or non-finite components are left out. The codebooks begin
    as the parts of the ENTRIES smallest ids (ascending, null ids last, equal ids by their vectors)
    and change ROUNDS times; with fewer vectors there are fewer entries, and with none an empty
    result. Repeated rows and ids are each coded. Vectors of unequal length, or of one that PARTS
    does not divide, are an error.
    """
    spark = prepared(df.sparkSession)
    kept = usable(df.select(df[id_col].alias("id"), F.struct(*[df[c] for c in carry]).alias("carried"), df[vector_col].alias("x")), "x") \
        if carry else usable(df.select(df[id_col].alias("id"), df[vector_col].alias("x")), "x")
    held = blocks(kept)
    first = kept.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    start = np.array([[int(np.floor(v * SCALE)) for v in r["x"]] for r in first], np.int64)
    codebooks = [np.ascontiguousarray(c) for c in np.split(start, PARTS, axis=1)] if first else [np.zeros((0, 0), np.int64)] * PARTS
    for _ in range(ROUNDS if first else 0):
        codebooks = lloyd_round(held, codebooks)
    sent = spark.sparkContext.broadcast(codebooks)
    names = held.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for i in range(batch.num_rows):
                columns = [batch.column(j).slice(i, 1).flatten() for j in range(len(names))]
                codes, error = np.zeros((len(columns[0]), PARTS), np.uint8), np.zeros(len(columns[0]), np.int64)
                for p, tree in enumerate(unpacked(batch.column(len(names))[i].as_py())):
                    nearest = assign(tree, sent.value[p])[0]
                    off = tree.points - sent.value[p][nearest]
                    codes[tree.order, p], error[tree.order] = nearest, error[tree.order] + (off * off).sum(1)
                text = codes.tobytes().hex()
                step = 2 * PARTS
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([text[a:a + step] for a in range(0, len(text), step)], pa.string()), pa.array(error)],
                    [*names, "code", "error"])

    types = ", ".join(f"`{f.name}` {f.dataType.elementType.simpleString()}" for f in held.schema.fields[:-1])
    found = held.mapInArrow(run, f"{types}, code string, error long")
    return found.select(F.col("id").alias(id_col), *[F.col(f"carried.`{c}`").alias(c) for c in carry], "code", "error"), codebooks


def with_label_errors(found: DataFrame, label_col: str = "label") -> DataFrame:
    """``found`` with ``label_error``: the sum of ``error`` over the rows of the same label (nulls together)."""
    from alignfold.functions.rows import join_hot

    key = free_name(found, "_label")
    sums = found.groupBy(F.col(label_col).alias(key)).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows"))
    return join_hot(found.withColumn(key, F.col(label_col)), sums, [key], "_rows").drop(key)
