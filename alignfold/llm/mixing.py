"""Mixing overlapping sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.functions.rows import join_hot
from alignfold.llm.common import global_order, global_order_sums, prepared, stage

#: Membership patterns of several sources that the flow is solved for, on the driver.
MAX_PATTERNS = 100_000


def source_targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Each source's share of ``total`` by weight, at most ``most`` times its size; what a source
    cannot take is shared again by weight among the others until none is above."""
    open_, target, left = {s for s in sizes if weights[s] > 0}, dict.fromkeys(sizes, 0.0), float(total)
    while open_:
        share = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * share > most * sizes[s]}
        if not full:
            for s in open_:
                target[s] = weights[s] * share
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def route(sizes: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], passes: int) -> np.ndarray:
    """Tokens of each pattern (row) given to each source (column): a maximum flow of least cost.

    A pattern offers its size ``passes`` times, the k-th time at cost k (convex: repeating costs
    more than taking fresh text anywhere). Successive cheapest augmenting paths, found by
    Bellman-Ford on the small graph start - patterns - sources - end.
    """
    n_pat, n_src = len(sizes), len(quotas)
    start, end = n_pat + n_src, n_pat + n_src + 1
    head: list[list[int]] = [[] for _ in range(end + 1)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, size: int, price: int) -> int:
        for x, y, r, c in ((a, b, size, price), (b, a, 0, -price)):
            head[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
        return len(to) - 2

    for p, size in enumerate(sizes):
        for k in range(passes):
            arc(start, p, int(size), k)
    given = {(p, s): arc(p, n_pat + s, int(sizes[p]) * passes, 0) for p in range(n_pat) for s in set(members[p])}
    for s, quota in enumerate(quotas):
        arc(n_pat + s, end, int(quota), 0)
    while True:
        far = [None] * (end + 1)
        via = [-1] * (end + 1)
        far[start], queue, waiting = 0, deque([start]), {start}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in head[x]:
                y = to[e]
                if room[e] > 0 and (far[y] is None or far[x] + cost[e] < far[y]):
                    far[y], via[y] = far[x] + cost[e], e
                    if y not in waiting:
                        waiting.add(y)
                        queue.append(y)
        if far[end] is None:
            break
        path, x = [], end
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    flow = np.zeros((n_pat, n_src), np.int64)
    for (p, s), e in given.items():
        flow[p, s] = room[e ^ 1]
    return flow


def whole_quotas(targets: Sequence[float]) -> list[int]:
    """Integers with the targets' rounded total, each within one of its target."""
    down = [int(np.floor(t)) for t in targets]
    rest = round(sum(targets)) - sum(down)
    for i in sorted(range(len(targets)), key=lambda i: down[i] - targets[i])[:max(rest, 0)]:
        down[i] += 1
    return down


def source_table(patterns: DataFrame, weigh, share: float, passes: int) -> DataFrame:
    """(source, own, shared, target) of every source, staged: its size, whether it shares rows with another, and its
    target, as ``source_targets`` gives them. The level that open sources reach is found by a few aggregates."""
    each = patterns.select(F.explode("pattern").alias("source"), "size", (F.size("pattern") > 1).alias("shared"))
    owned = each.groupBy("source").agg(F.sum("size").alias("own"), F.max("shared").alias("shared"))
    # "s..." sorts before "z": code point order with null last
    ranked, n = global_order(owned, [F.col("source")], "rank", "mix-sources")
    if hasattr(weigh, "column"):
        weighed = ranked.withColumn("w", weigh.column(F.col("rank")))
    else:  # one number a source from the driver
        listed = patterns.sparkSession.createDataFrame([(i, float(w)) for i, w in enumerate(weigh(n))] or [(0, 0.0)], "rank long, w double")
        weighed = ranked.join(listed, "rank")
    held = stage(weighed, "mix-weights")
    total = share * (patterns.filter(F.size("pattern") > 0).agg(F.sum("size")).first()[0] or 0)
    most, level, closed = F.lit(passes) * F.col("own"), None, -1
    while True:
        full = F.lit(False) if level is None else F.col("w") * F.lit(level) > most
        r = held.filter("w > 0").agg(F.sum(F.when(full, most).otherwise(0)).alias("taken"), F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("w"),
                                     F.count(F.when(full, 1)).alias("n")).first()
        if r["n"] == closed or not r["w"]:
            break
        closed, level = r["n"], (total - (r["taken"] or 0)) / r["w"]
    target = F.when(F.col("w") <= 0, 0.0).otherwise(F.least(F.col("w") * F.lit(float(level or 0)), most.cast("double")))
    return stage(held.select("source", "own", "shared", target.alias("target")), "mix-targets")


def shared_stops(patterns: DataFrame, sources: DataFrame, passes: int) -> DataFrame:
    """(pattern, stops) of the patterns of sources that share rows: the flow, solved on the driver."""
    spark = patterns.sparkSession
    mine = sources.filter("shared").select("source", "target")
    first = patterns.withColumn("source", F.col("pattern")[0])
    found = patterns.filter(F.size("pattern") > 1).select("pattern", "size").limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of several sources")
    found += first.filter(F.size("pattern") == 1).join(mine, "source").select("pattern", "size").collect() if found else []
    found = sorted((list(r["pattern"]), r["size"]) for r in found)
    targets = {r["source"]: r["target"] for r in mine.collect()} if found else {}  # no more than the patterns' sources
    at = {s: i for i, s in enumerate(sorted(targets))}
    quotas = whole_quotas([targets[s] for s in sorted(targets)])
    flow = route([n for _, n in found], [[at[s] for s in p] for p, _ in found], quotas, passes)
    stops = [np.cumsum(given) for given in flow]
    return spark.createDataFrame([(p, [float(x[at[s]]) for s in p]) for (p, _), x in zip(found, stops)], "pattern array<string>, stops array<double>")


def mix_rows(df: DataFrame, size: Column, members: Column, weigh, share: float = 1.5, passes: int = 2, seed: int = 29,
             id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(id, carried columns, ``size``, ``pattern``, ``given``: an array of the sources a row is given to, once for
    each time it is taken, and ``sizes`` and ``targets`` of the pattern's sources; a table of the sources:
    ``source``, ``own`` size, ``target``).

    ``members`` is an array of the sources a row belongs to (a null in it is a source of its own;
    an empty or null array belongs to none and is never taken), ``weigh`` gives the weights of the
    sources, listed by code point with null last. Targets share ``share`` times all sizes, and none
    is over ``passes`` times its source's size. Rows are summed by pattern. A source that shares no
    row with another takes from its own pattern up to its target, on Spark, however many such sources
    there are; the others' patterns are routed by the flow. Rows then stand in a seeded order in their
    pattern, and a row is given to the source into whose stretch of the pattern's passes the row's
    middle falls. So a source misses its target by about half a row at each end of its stretches. No
    row is taken more than ``passes`` times. The result depends on (id, size, pattern) alone; rows equal
    in them are interchangeable. Rows of size 0 count as taken in the pass they fall in. An empty
    table gives empty tables.

    The driver holds the patterns of several sources (at most MAX_PATTERNS, else ValueError) and of the
    sources in them, never rows of df.
    """
    prepared(df.sparkSession)
    named = F.transform(members, lambda m: F.coalesce(F.concat(F.lit("s"), m), F.lit("z")))
    rows = df.select(F.col(id_col).alias("id"), *[F.col(c) for c in carry], size.cast("long").alias("size"),
                     F.coalesce(F.array_sort(F.array_distinct(named)), F.array().cast("array<string>")).alias("pattern"))
    rows = stage(rows, "mix-rows")
    patterns = stage(rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "mix-patterns")
    sources = source_table(patterns, weigh, share, passes)
    order = [F.col("pattern"), F.xxhash64(F.lit(seed), F.col("id")), F.col("id"), F.col("size"), *[F.col(c) for c in carry]]
    run = global_order_sums(rows, order, "size", "before", "mix-order")
    bases = run.groupBy("pattern").agg(F.min("before").alias("base"))
    parts = patterns.select("pattern", F.posexplode("pattern").alias("i", "source")).join(sources, "source")
    parts = parts.groupBy("pattern").agg(F.sort_array(F.collect_list(F.struct("i", "own", "target"))).alias("parts"))
    plan = patterns.withColumnRenamed("size", "room").join(bases, "pattern").join(parts, "pattern", "left") \
        .join(shared_stops(patterns, sources, passes), "pattern", "left")
    none = F.array().cast("array<double>")
    plan = plan.select("pattern", "n", "room", "base", F.coalesce("stops", F.col("parts.target"), none).alias("stops"),
                       F.col("parts.own").alias("sizes"), F.col("parts.target").alias("targets"))
    joined = join_hot(run, plan, ["pattern"], "n")
    given = F.expr(f"""filter(transform(sequence(0, {passes - 1}), k ->
        get(filter(pattern, (x, i) -> 2 * (k * room + before - base) + size < 2 * stops[i]), 0)), x -> x IS NOT NULL)""")
    out = joined.select(F.col("id").alias(id_col), *carry, "size", "pattern", given.alias("given"), "sizes", "targets")
    return out, sources.select(F.expr("CASE WHEN source <> 'z' THEN substring(source, 2) END").alias("source"), "own", "target")


def mix(df: DataFrame, size: Column, members: Column, weigh, **options) -> tuple[DataFrame, dict]:
    """``mix_rows`` without ``sizes`` and ``targets``, and the sources as {source: (size, target)}, by code point with
    null last: for as many sources as a driver holds."""
    out, sources = mix_rows(df, size, members, weigh, **options)
    held = sorted(sources.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    return out.drop("sizes", "targets"), {r["source"]: (r["own"], r["target"]) for r in held}


def repeating(weights: Sequence[float]):
    """Weights repeated over as many sources as there are, as a list or as a column of the source's place."""
    def listed(n: int) -> list[float]:
        return [float(weights[i % len(weights)]) for i in range(n)]

    listed.column = lambda rank: F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    return listed

