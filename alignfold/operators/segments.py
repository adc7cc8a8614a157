"""Ordered passes over range partitions: one row after the other within a key, however many rows it has.

``sorted_partitions`` orders a table by (key, order) over range partitions, written once to the shared
checkpoint folder, so that every later pass finds the same rows in the same partitions. Only the first and
the last key of a partition can go on in others. A first pass sums up these two stretches of rows, one
small record a partition; the records are folded in order, and each partition gets the state in which its
first stretch begins and what will become of its last one. A second pass then works on whole partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.text import col_of
from alignfold.session import cut_lineage, ship_package

PID = "_pid"


def sorted_partitions(df: DataFrame, order: list, num_partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions by ``order``, sorted within them, with the partition's number in ``_pid``."""
    spark = df.sparkSession
    cols = [col_of(c) for c in order]
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return cut_lineage(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).withColumn(PID, F.spark_partition_id()))


def by_partition(df: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str | T.StructType) -> DataFrame:
    """``work`` on the rows of each partition that has some, as one Arrow table."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks()).to_batches()

    return df.mapInArrow(run, schema)


def stretches(key: pa.ChunkedArray) -> np.ndarray:
    """Places at which a sorted column's values begin; nulls are one value."""
    code = key.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))


# ---------- dialogs ----------
HUMAN, GPT, SYSTEM, OTHER = range(4)


@dataclass
class Stretch:
    """What turns in a row of one conversation come to, wherever in it they stand."""

    n: int
    first: list[int]  # roles of the first two turns
    bad: list[int]  # place of the first turn of an unknown role from 0, 1 and 2 on; n if there is none
    kept: list[int]  # turns before it whose role is in turn, for an even and an odd start of each

    @classmethod
    def of(cls, role: np.ndarray) -> Stretch:
        n, place = len(role), np.arange(len(role))
        bad = [int(o + np.argmax(role[o:] > GPT)) if (role[o:] > GPT).any() else n for o in range(3)]
        kept = [int((role[o:bad[o]] == (place[o:bad[o]] + a) % 2).sum()) for a in (0, 1) for o in range(3)]
        return cls(n, role[:2].tolist(), bad, kept)


@dataclass
class State:
    """Where a stretch begins in its conversation, and what will become of the conversation."""

    index: int = 0  # turns before it
    offset: int = 0  # turns before the dialog: a system turn, a first turn that is not human
    closed: bool = False  # an unknown role has ended the dialog
    messages: int = 0  # messages kept before it
    stays: bool = False
    n_pairs: int = 0


@dataclass
class Span:
    """A conversation cut by partition borders: its stretches in order, by partition."""

    pids: list[int] = field(default_factory=list)
    parts: list[Stretch] = field(default_factory=list)

    def states(self, strict: bool) -> list[State]:
        roles = [r for p in self.parts for r in p.first][:2]
        offset = dialog_offset(roles[0], roles[1] if len(roles) > 1 else OTHER)
        now, walk, out = State(offset=int(offset)), 0, []
        for part in self.parts:
            out.append(State(**asdict(now)))
            skip, odd = min(max(offset - now.index, 0), 2), (now.index - offset) % 2
            if not now.closed:
                now.messages += part.kept[3 * odd + skip]
                walk += max(part.bad[skip] - skip, 0)
                now.closed = part.bad[skip] < part.n
            now.index += part.n
        stays = dialog_stays(now.index, offset, now.messages, walk, strict)
        for state in out:
            state.stays, state.n_pairs = bool(stays), now.messages // 2
        return out


def dialog_offset(first, second):  # noqa: ANN001, ANN201  (numbers or arrays)
    """Turns before the dialog, from the first two roles."""
    system = np.equal(first, SYSTEM)
    return system + np.not_equal(np.where(system, second, first), HUMAN).astype(int)


def dialog_stays(n, offset, messages, walk, strict):  # noqa: ANN001, ANN201
    stays = (n >= 2) & (n - offset >= 2) & (messages % 2 == 0)
    return stays & (messages == walk) if strict else stays


def role_code(role: str) -> Column:
    c = F.when(F.col(role) == "human", HUMAN).when(F.col(role) == "gpt", GPT).when(F.col(role) == "system", SYSTEM)
    return c.otherwise(OTHER).cast("byte")


def dialog_states(turns: DataFrame, strict: bool) -> dict[int, dict[int, State]]:
    """For each partition the states of its first (0) and last (-1) stretch, if they go on beyond it.

    ``turns`` has a key, a role code and the partition's number, sorted. The driver gets one row a partition.
    """
    key_type = turns.schema[0].dataType.simpleString()
    one = "struct<n: long, first: array<long>, bad: array<long>, kept: array<long>>"

    def sum_up(t: pa.Table) -> pa.Table:
        at, role = stretches(t.column(0)), t.column(1).to_numpy().astype(np.int64)
        ends = [asdict(Stretch.of(part)) for part in (role[at[0]:(at[1] if len(at) > 1 else len(role))], role[at[-1]:])]
        kind = pa.struct([("n", pa.int64()), *[(x, pa.list_(pa.int64())) for x in ("first", "bad", "kept")]])
        return pa.table({"pid": t.column(2).slice(0, 1), "head_key": t.column(0).slice(0, 1), "tail_key": t.column(0).slice(t.num_rows - 1, 1),
                         "stretches": [len(at)], "head": pa.array([ends[0]], kind), "tail": pa.array([ends[1]], kind)})

    rows = by_partition(turns, sum_up, f"pid int, head_key {key_type}, tail_key {key_type}, stretches long, head {one}, tail {one}").collect()
    spans: list[Span] = []
    open_, last_key = None, None
    for r in sorted(rows, key=lambda r: r["pid"]):
        if open_ is not None and r["head_key"] == last_key:
            open_.pids.append(r["pid"])
            open_.parts.append(Stretch(**r["head"].asDict()))
        else:
            open_ = None
        if open_ is None or r["stretches"] > 1:
            open_ = Span([r["pid"]], [Stretch(**r["tail"].asDict())])
            spans.append(open_)
        last_key = r["tail_key"]
    out: dict[int, dict[int, State]] = {}
    for span in spans:
        if len(span.pids) > 1:
            for i, (pid, state) in enumerate(zip(span.pids, span.states(strict))):
                out.setdefault(pid, {})[-1 if i == 0 else 0] = state
    return out


CONV, PAIR, LOOSE = range(3)


def dialog_rows(turns: DataFrame, strict: bool = False) -> DataFrame:
    """Conversations and pairs of a sorted table (key, role code, partition's number, text): rows of ``kind`` CONV
    (key, system, n_pairs), PAIR (key, k, query, answer, and system where k = 0) and LOOSE (pairs of which
    this partition does not have all)."""
    states = dialog_states(turns.select(*turns.columns[:3]), strict)
    key_type = turns.schema[0].dataType.simpleString()
    sent = turns.sparkSession.sparkContext.broadcast(states)  # at most two states a partition

    def work(t: pa.Table) -> pa.Table:
        role, text = t.column(1).to_numpy().astype(np.int64), t.column(3).combine_chunks()
        at = stretches(t.column(0))
        n = np.diff(np.append(at, len(role)))
        of = np.repeat(np.arange(len(at)), n)
        place = np.arange(len(role)) - at[of]
        second = np.where(n > 1, role[np.minimum(at + 1, len(role) - 1)], OTHER)
        known = [State(offset=int(o)) for o in dialog_offset(role[at], second)]
        given = np.zeros(len(at), bool)
        for where, state in sent.value.get(int(t.column(2)[0].as_py()), {}).items():
            known[where], given[where] = state, True
        index, offset, closed, before = (np.array([getattr(s, f) for s in known]) for f in ("index", "offset", "closed", "messages"))
        turn = place + (index - offset)[of]
        bad = (role > GPT) & (turn >= 0)
        end = np.where(closed, 0, np.minimum.reduceat(np.where(bad, place, n[of]), at))
        kept = (turn >= 0) & (place < end[of]) & (role == turn % 2)
        count = np.add.reduceat(kept.astype(np.int64), at)
        stays = dialog_stays(n, offset, count, np.maximum(end - offset, 0), strict)
        n_pairs = count // 2
        for i in np.flatnonzero(given):
            stays[i], n_pairs[i] = known[i].stays, known[i].n_pairs
        upto = np.cumsum(kept) - kept
        message = upto - upto[at][of] + before[of]
        # conversations that begin here
        begin = np.flatnonzero(stays & (index == 0))
        system = np.where(role[at] == SYSTEM, at, -1)
        blank = pa.array([""], pa.string())

        def texts(rows: np.ndarray, otherwise: pa.Array) -> pa.Array:
            """The texts of rows; where there is no row (-1), the one value of ``otherwise``."""
            return pa.concat_arrays([text.cast(pa.string()), otherwise]).take(pa.array(np.where(rows < 0, len(text), rows)))

        systems = texts(system, blank).fill_null("")
        # a message of even number and the next one are a pair
        rows = np.flatnonzero(kept & stays[of])
        even, same = message[rows] % 2 == 0, np.append(of[rows[1:]] == of[rows[:-1]], False)
        after = np.where(same, np.append(rows[1:], -1), -1)  # the next message of the conversation here
        alone = rows[~even & ~np.append(False, same[:-1])[:len(rows)]]  # answers to a query of the partition before
        query, answer = np.concatenate([rows[even], np.full(len(alone), -1)]), np.concatenate([after[even], alone])
        anchor = np.where(query < 0, answer, query)
        k = message[anchor] // 2
        loose = (query < 0) | (answer < 0) | ((k == 0) & (index[of[anchor]] > 0))
        none = pa.array([None], pa.string())
        pair_system = pa.concat_arrays([systems, none]).take(pa.array(np.where((k == 0) & ~loose, of[anchor], len(at))))
        order = np.lexsort((k, of[anchor]))
        pairs = pa.table({
            "kind": pa.array(np.where(loose, LOOSE, PAIR), pa.int8()), "key": t.column(0).combine_chunks().take(pa.array(anchor)),
            "k": pa.array(k, pa.int32()), "n_pairs": pa.nulls(len(k), pa.int32()), "system": pair_system,
            "query": texts(query, none), "answer": texts(answer, none)}).take(pa.array(order))
        convs = pa.table({
            "kind": pa.array(np.full(len(begin), CONV), pa.int8()), "key": t.column(0).combine_chunks().take(pa.array(at[begin])),
            "k": pa.nulls(len(begin), pa.int32()), "n_pairs": pa.array(n_pairs[begin], pa.int32()),
            "system": systems.take(pa.array(begin)), "query": pa.nulls(len(begin), pa.string()),
            "answer": pa.nulls(len(begin), pa.string())})
        return pa.concat_tables([convs, pairs])

    return cut_lineage(by_partition(turns, work, f"kind byte, key {key_type}, k int, n_pairs int, system string, query string, answer string"))


# ---------- ranks ----------
def same_value(a, b) -> bool:  # noqa: ANN001
    """Equal as in a sort: nulls are equal, and so are NaNs."""
    return a == b or (a is None and b is None) or (isinstance(a, float) and isinstance(b, float) and a != a and b != b)


def value_code(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    if pa.types.is_floating(column.type):  # one zero
        column = pa.array(column.to_numpy(zero_copy_only=False) + 0.0, column.type, mask=column.is_null().to_numpy(zero_copy_only=False))
    return column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def begins(*codes: np.ndarray) -> np.ndarray:
    """Places at which a row differs from the one before in any of the codes."""
    differs = np.zeros(len(codes[0]) - 1, bool)
    for c in codes:
        differs |= c[1:] != c[:-1]
    return np.flatnonzero(np.append(True, differs))


def ranked(df: DataFrame, group: str, value: str, order: list) -> DataFrame:
    """``df`` with ``rank`` (rows of equal ``value`` share one) and ``row_number`` within its group, in ``order`` (which
    begins with the group and the value). A group of any size lies in as many partitions as it fills; the
    driver gets one row a partition."""
    held = sorted_partitions(df, order)
    keys = held.select(F.col(group).alias("g"), F.col(value).alias("v"), PID)
    kinds = {f.name: f.dataType.simpleString() for f in keys.schema}

    def sum_up(t: pa.Table) -> pa.Table:
        g, v = value_code(t.column(0)), value_code(t.column(1))
        groups, runs, n = begins(g), begins(g, v), t.num_rows
        last = pa.array([n - 1])
        return pa.table({"pid": t.column(2).slice(0, 1), "n": [n], "groups": [len(groups)], "runs": [len(runs)], "tail_n": [n - int(groups[-1])],
                         "tail_run": [n - int(runs[-1])], "g0": t.column(0).slice(0, 1), "v0": t.column(1).slice(0, 1),
                         "g1": t.column(0).take(last), "v1": t.column(1).take(last)})

    rows = by_partition(keys, sum_up, f"pid int, n long, groups long, runs long, tail_n long, tail_run long, g0 {kinds['g']}, "
                                      f"v0 {kinds['v']}, g1 {kinds['g']}, v1 {kinds['v']}").collect()
    carried, now = {}, None  # rows of the group and of the run before each partition
    for r in sorted(rows, key=lambda r: r["pid"]):
        goes_on = now is not None and same_value(now[0], r["g0"])
        before = now[2] if goes_on else 0
        run = now[3] if goes_on and same_value(now[1], r["v0"]) else 0
        carried[r["pid"]] = (before, run)
        now = (r["g1"], r["v1"], before + r["n"] if r["groups"] == 1 else r["tail_n"], run + r["n"] if r["runs"] == 1 else r["tail_run"])
    sent = df.sparkSession.sparkContext.broadcast(carried)  # two numbers a partition
    at, by = held.columns.index(group), held.columns.index(value)

    def work(t: pa.Table) -> pa.Table:
        before, run = sent.value[int(t.column(PID)[0].as_py())]
        g, v = value_code(t.column(at)), value_code(t.column(by))
        groups, runs, place = begins(g), begins(g, v), np.arange(t.num_rows)
        start = groups[np.searchsorted(groups, place, "right") - 1]
        first = runs[np.searchsorted(runs, place, "right") - 1]
        more = np.where(start == 0, before, 0)
        rank = first - start + 1 + more - np.where(first == 0, run, 0)
        return t.drop_columns([PID]).append_column("rank", pa.array(rank, pa.int32())).append_column(
            "row_number", pa.array(place - start + 1 + more, pa.int32()))

    schema = T.StructType([*[f for f in held.schema if f.name != PID], T.StructField("rank", T.IntegerType()), T.StructField("row_number", T.IntegerType())])
    return by_partition(held, work, schema)
