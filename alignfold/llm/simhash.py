"""SimHash near-duplicates by the generalised pigeonhole principle.

Every document gets a 64-bit fingerprint. Correlated bits are grouped into partitions; the largest
distance is shared out among the partitions as unequal thresholds by dynamic programming on
estimated candidate counts; each fingerprint then probes an index of partition values, and what it
finds is verified. Links are joined to components on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import prepared, slices, stage, text_or_empty

BITS = 64
SEED = 42
#: Probes of one index value that meet in one join group; larger buckets are cut into blocks.
BLOCK = 4096
#: Cost of verifying a candidate pair, with that of one index or probe row as 1.
VERIFY = 0.25


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str, width: int = 3) -> int:
    """SimHash of the lower-cased text: a bit is set if it is in over half the shingle hashes."""
    words = text.encode().lower().split()  # bytes: only A-Z change, and white space is ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        shingles = [joined]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        shingles = [joined[a:b - 1] for a, b in zip([0, *ends], ends[width - 1:])]
    digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(shingles)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int, carry: tuple[str, ...]) -> DataFrame:
    prepared(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c) for c in carry], text_or_empty(text_col).alias("whole"))
    kept = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fp = [signed(fingerprint(t, width)) for t in batch.column("whole").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(fp, pa.int64())],
                                             [*kept, "fp"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, fp long")


def bit_sums(prints: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, how often each pair of bits is set together): 64 x 64 sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            fp = batch.column("fp").to_numpy().astype(np.int64)
            x = ((fp[:, None] >> np.arange(BITS)) & 1).astype(np.float32)
            n += len(fp)
            both += x.T @ x
        at = np.arange(BITS * BITS + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(both.ravel(), n))], ["at", "n"])

    total = prints.select("fp").mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n"))
    sums = np.zeros(BITS * BITS + 1)
    for r in total.collect():  # always 4,097 rows at most
        sums[r["at"]] = r["n"]
    return int(sums[-1]), sums[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near equal size; the most correlated bits stand together."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    strength = np.abs(cov / scale)
    np.fill_diagonal(strength, 0)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        seed = max(sorted(free), key=lambda b: strength[b, sorted(free)].sum())
        group = [seed]
        free.discard(seed)
        while len(group) < size:
            nxt = max(sorted(free), key=lambda b: strength[b, group].sum())
            group.append(nxt)
            free.discard(nxt)
        groups.append(sorted(group))
    return groups


def ball(width: int, radius: int) -> int:
    """Values within ``radius`` of a partition value of ``width`` bits."""
    size, term = 0, 1
    for r in range(radius + 1):
        size += term
        term = term * (width - r) // (r + 1)
    return size


def allocate(cost: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds (one of each partition's keys) that sum to ``budget`` at the least total cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for choices in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, taken) in best.items():
            for radius, extra in choices.items():
                if used + radius not in step or c + extra < step[used + radius][0]:
                    step[used + radius] = (c + extra, [*taken, radius])
        best = step
    return best[budget]


def mask_of(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def plan_partitions(prints: DataFrame, distance: int) -> list[tuple[int, list[int], int]]:
    """(mask, bits, threshold) of each partition, for the number of partitions of least cost.

    With m partitions the thresholds sum to distance - m + 1 (a threshold of -1 leaves a partition
    out): any pair within ``distance`` is within the threshold of one partition at least. The
    candidates of threshold 0 are counted from the histogram of all partition values; those of a
    larger one are estimated from it and the odds that a pair differs in a further bit.
    """
    n, both = bit_sums(prints)
    p = np.diag(both) / max(n, 1)
    odds = 2 * p * (1 - p) / np.maximum(p * p + (1 - p) * (1 - p), 1e-9)
    plans = {m: group_bits(n, both, m) for m in range(1, distance + 2)}
    masks = [(m, i, mask_of(bits)) for m, groups in plans.items() if m > 1 for i, bits in enumerate(groups)]
    values = prints.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(mask)).alias("v"))
        for m, i, mask in masks])).alias("s")).select("s.*")
    pairs = {(r["m"], r["i"]): float(r["pairs"]) for r in values.groupBy("m", "i", "v").agg(
        F.count(F.lit(1)).cast("double").alias("c")).groupBy("m", "i").agg(
        F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("pairs")).collect()}
    best = None
    for m, groups in plans.items():
        cost = []
        for i, bits in enumerate(groups):
            same, q = pairs.get((m, i), 0.0), odds[bits]
            choices, within, term = {-1: 0.0}, same, [1.0] + [0.0] * distance
            for x in q:  # elementary symmetric sums of the odds
                for r in range(distance, 0, -1):
                    term[r] += term[r - 1] * x
            for radius in range(distance - m + 2):
                within += same * term[radius] if radius else 0.0
                choices[radius] = n * (1 + ball(len(bits), radius)) + VERIFY * within
            cost.append(choices)
        got = allocate(cost, distance - m + 1)
        if best is None or got[0] < best[0]:
            best = (*got, groups)
    assert best is not None
    return [(mask_of(bits), bits, radius) for bits, radius in zip(best[2], best[1])]


def links(prints: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Pairs (a < b) of different fingerprints within ``distance`` bits, each once."""
    plan = plan_partitions(prints, distance)
    used = [(k, mask, bits, radius) for k, (mask, bits, radius) in enumerate(plan) if radius >= 0]
    index = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value"))
        for k, mask, _, _ in used])).alias("s")).select("fp", "s.*")
    probes = None
    for k, mask, bits, radius in used:
        flips = [signed(sum(1 << b for b in some)) for r in range(radius + 1) for some in combinations(bits, r)]
        one = prints.select("fp", F.lit(k).alias("part"), F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip"))
        one = one.select("fp", "part", F.col("fp").bitwiseAND(F.lit(mask)).bitwiseXOR(F.col("flip")).alias("value"))
        probes = one if probes is None else probes.unionByName(one)
    large = stage(index.groupBy("part", "value").count().filter(F.col("count") > block)
                  .select("part", "value", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "buckets")
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    left = probes.join(large, ["part", "value"], "left").select(
        F.col("fp").alias("a"), "part", "value", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    right = index.join(large, ["part", "value"], "left").select(
        F.col("fp").alias("b"), "part", "value", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance)
    for i, (k, _, _, _) in enumerate(used):  # only the first partition that finds a pair reports it
        for _, mask, _, radius in used[:i]:
            near &= (F.col("l.part") != k) | (F.bit_count(differ.bitwiseAND(F.lit(mask))) > radius)
    keys = (F.col("l.part") == F.col("r.part")) & (F.col("l.value") == F.col("r.value")) & \
        (F.col("l.block") == F.col("r.block"))
    return left.alias("l").join(right.alias("r"), keys & near).select("a", "b")


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node that a pair names; the root is one node of its component.

    Rounds of contraction: every node points to its smallest neighbour or itself, pointers are
    followed to their ends, and pairs are renamed to the ends until none joins two of them. All
    tables stay on Spark; each round is written to the shared folder.
    """
    edges = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "edges")
    known = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
                      .select("node", F.least("node", "root").alias("root")), "pointers")
        moved = 1
        while moved:
            end = point.select(F.col("node").alias("root"), F.col("root").alias("end"))
            new = stage(point.join(end, "root").select("node", F.col("end").alias("root"),
                                                       (F.col("end") != F.col("root")).alias("moved")), "pointers")
            moved = new.filter("moved").limit(1).count()
            point = new.select("node", "root")
        ends = point.select(F.col("node").alias("root"), F.col("root").alias("end"))
        if known is None:
            known = point
        else:
            known = stage(known.join(ends, "root", "left").select(
                "node", F.coalesce("end", "root").alias("root")), "roots")
        for side in ("a", "b"):
            edges = edges.join(point.select(F.col("node").alias(side), F.col("root").alias(f"new_{side}")), side)
        edges = stage(edges.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
                      .filter("a <> b").distinct(), "edges")
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return known


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    distance: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """Id, carried columns, ``fp`` (signed 64 bits), ``component`` (a fingerprint that names the group)
    and ``component_id`` (the smallest id in the group) of every row.

    Rows of equal fingerprint stand together from the start, so copies are never paired. Texts
    without a word (null, empty, blank) have fingerprint zero and link like any other. Fewer words
    than ``width`` make one shingle. A group whose ids are all null has a null component_id. Rows
    that are repeated are each returned; an empty table gives none.
    """
    docs = stage(fingerprints(df, id_col, text_col, width, carry), "prints")
    prints = stage(docs.groupBy("fp").agg(F.min("id").alias("first")), "distinct-prints")
    roots = components(links(prints.select("fp"), distance))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("component"), "first")
    named = stage(named, "named-prints")
    smallest = stage(named.groupBy("component").agg(F.min("first").alias("component_id")), "smallest")
    table = stage(named.drop("first").join(smallest, "component"), "print-components")
    return docs.join(table, "fp").withColumnRenamed("id", id_col)
