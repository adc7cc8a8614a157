"""Scores of a gated recurrent language model with a class-factored softmax, trained in numpy.

Words are counted over all training text. The frequent ones stand in classes of equal mass, in
each of which the model learns a softmax; the rare ones in classes by their ending, in which a word
has its smoothed share of the class's count. Classes stand in groups, with a softmax each. The recurrent state is carried over a whole document,
window by window, so a score is the log-likelihood of the complete text.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import prepared, slices, stage, text_or_empty

FREQUENT = 4096  # words with a softmax weight and an embedding of their own, at least; see ``frequent_words``
WORD_CLASSES, ENDING_CLASSES = 64, 64  # word classes: at least
ENDING = 3  # bytes of a rare word that choose its class
HELD = 262_144  # most frequent words whose counts every task holds; rarer ones are joined
HIDDEN = 24
TRAIN_TOKENS = 1_500_000  # tokens of a part of the training documents, learnt in one task; more if the network is larger
ROUNDS = 3  # each learns a third of every part and takes the mean of the weights
SLICE = 4096  # weights that are averaged as one row
RATE = 0.02
STREAMS, STEPS = 256, 16  # parallel streams and window of the truncated backpropagation
LANES = 384  # streams scored side by side
ROWS = 8192  # states whose softmax is taken at once
SAFE = 80  # logits up to this go to the exponential as they are; their sums stay within 32-bit floats
END = b""


def split(texts: pa.Array) -> pa.ListArray:
    """The tokens of each text: lower-cased words (A-Z only; cut at ASCII white space) and the end, which is empty."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    # white space at the end of a text makes an empty token behind it; an empty text is one already
    low = pc.if_else(pc.equal(low, ""), low, pc.binary_join_element_wise(low, "", " "))
    return pc.ascii_split_whitespace(low)


def tokens(text: str) -> list[bytes]:
    """The tokens of one text, as ``split`` finds them."""
    return split(pa.array([text], pa.string())).flatten().cast(pa.binary()).to_pylist()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Words:
    """What a task holds of the counts: the HELD most frequent words by rank, and the classes.

    Token numbers: a frequent word's rank, then one number for each ending class.
    """

    rank: dict[bytes, int]
    count: np.ndarray  # by rank
    total: int  # N
    types: int  # V
    bounds: np.ndarray  # first rank of each word class, then the number of frequent words
    endings: dict[bytes, int]  # ending -> ending class; others: the last class
    mass: np.ndarray  # of the ending classes, smoothed

    def __post_init__(self) -> None:
        self.frequent = int(self.bounds[-1])
        rare = list(self.rank)[self.frequent:]
        self.number = np.concatenate([np.arange(self.frequent), self.frequent + np.array(
            [self.ending(w) for w in rare], np.int64)]).astype(np.int32)
        self.base = np.log10((self.count + 1) / (self.total + self.types + 1))
        share = np.log10(self.count[self.frequent:] + 1) - np.log10(self.mass)[self.number[self.frequent:] - self.frequent]
        self.inside = np.concatenate([np.zeros(self.frequent), share])  # log10 share within an ending class

    def end(self) -> int:
        """The token number of the end."""
        rank = self.rank.get(END)
        return int(self.number[rank]) if rank is not None else self.frequent + self.ending(END)

    def ending(self, word: bytes) -> int:
        return self.endings.get(word[-ENDING:], len(self.mass) - 1)

    def classes(self) -> int:
        return len(self.bounds) - 1 + len(self.mass)

    def class_of(self) -> np.ndarray:
        """The class of each token number."""
        n = len(self.bounds) - 1
        return np.concatenate([np.repeat(np.arange(n), np.diff(self.bounds)), n + np.arange(len(self.mass))])

    @cached_property
    def held(self) -> pa.Array:
        return pa.array(list(self.rank), pa.binary())

    def numbers(self, words: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(rank or -1, token number) of each word."""
        if isinstance(words, list):
            words = pa.array(words, pa.binary())
        at = pc.fill_null(pc.index_in(words, value_set=self.held), -1).to_numpy()
        number = self.number[at] if len(self.number) else np.zeros(len(at), np.int32)
        lacking = np.flatnonzero(at < 0)
        number[lacking] = [self.frequent + self.ending(w) for w in words.take(pa.array(lacking)).to_pylist()]
        return at, number


class Network:
    """Embedding, one gated recurrent layer, softmax over groups of classes, within a group, within a word class.

    A group is a run of as many classes as there are groups, so a token's logits are some tens: its
    group's, its class's beside the others of the group, its word's beside the others of the class.

    All weights are views of one vector, ``flat``, so that a step of the optimiser and a mean are few calls.
    The recurrence runs on arrays of (steps, units, lanes), whose gates are contiguous; the softmaxes on rows.
    """

    def __init__(self, words: Words, hidden: int = HIDDEN, seed: int = 3):
        rng = np.random.default_rng(seed)
        n, c, f = words.frequent + len(words.mass), words.classes(), words.frequent
        mass = np.concatenate([np.add.reduceat(words.count[:f] + 1.0, words.bounds[:-1]) if f else np.zeros(0), words.mass])
        share = np.log(words.count[:f] + 1.0) - np.log(mass)[words.class_of()[:f]] if f else np.zeros(1)
        self.run = math.isqrt(c)
        runs = np.append(np.arange(0, c, self.run), c)
        of_group, groups = np.add.reduceat(mass, runs[:-1]), len(runs) - 1
        # the first output of each softmax, by level, then the number of outputs
        self.levels = np.array([0, groups]), groups + runs, groups + c + words.bounds
        bias = np.concatenate([np.log(np.maximum(of_group, 1) / of_group.sum()),
                               np.log(np.maximum(mass, 1) / np.maximum(of_group, 1)[np.arange(c) // self.run]), share[:f]])
        out = np.zeros((len(bias), hidden + 1))  # a row for each output, its bias last
        out[:, hidden] = bias
        begin = {"emb": (n, hidden), "wx": (hidden, 3 * hidden), "wh": (hidden, 3 * hidden), "b": np.zeros(3 * hidden), "out": out}
        begin = {k: rng.standard_normal(x) * 0.1 if isinstance(x, tuple) else x for k, x in begin.items()}
        self.shapes = {k: x.shape for k, x in begin.items()}
        self.flat = np.concatenate([x.ravel() for x in begin.values()]).astype(np.float32)
        self.p = self.views(self.flat)
        self.of, self.hidden = words.class_of(), hidden
        self.end = words.end()
        self.rooms: dict[str, np.ndarray] = {}

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array that is used again in each window: new ones of this size would cost more than their numbers."""
        size = math.prod(shape)
        if name not in self.rooms or self.rooms[name].size < size:
            self.rooms[name] = np.empty(size, self.flat.dtype)
        return self.rooms[name][:size].reshape(shape)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        ends = np.cumsum([math.prod(shape) for shape in self.shapes.values()])
        return {k: part.reshape(shape) for (k, shape), part in zip(self.shapes.items(), np.split(flat, ends[:-1]))}

    def step(self, gx: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """One step of the recurrence on rows of ``h``, as ``forward`` takes it for whole windows."""
        k = self.hidden
        gh = h @ self.p["wh"]
        rz = sigmoid(gx[:, :2 * k] + gh[:, :2 * k])
        r, z, gn = rz[:, :k], rz[:, k:], gh[:, 2 * k:]
        n = np.tanh(gx[:, 2 * k:] + r * gn)
        return n + z * (h - n), (h, r, z, n, gn)

    def forward(self, before: np.ndarray, h: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """(the states of a window after its steps, what ``gradient`` needs of them if they are to ``keep``).

        ``before`` and the rows of the states are steps, lanes; ``h`` has a row for each lane. A state
        ends with a 1, the factor of a softmax's bias.
        """
        p, k, (steps, lanes) = self.p, self.hidden, before.shape
        flows = (before != self.end).astype(self.flat.dtype)  # a document starts from nothing
        half = np.repeat(np.array([0.5, 1], self.flat.dtype), [2 * k, k])  # sigmoid(x) is tanh(x / 2) / 2 + 1 / 2
        embedded = np.take(p["emb"], before.ravel(), 0, self.room("embedded", steps * lanes, k), "clip").reshape(steps, lanes, k)
        wx, wh, bias = (p["wx"] * half).T, (p["wh"] * half).T, (p["b"] * half)[:, None]
        x = self.room("x", 3 * k, lanes)
        kept = steps if keep else 1
        h0, gh, rz, new = (self.room(name, kept, n * k, lanes) for name, n in (("h0", 1), ("gh", 3), ("rz", 2), ("new", 1)))
        states = self.room("states", steps + 1, k, lanes)
        states[0] = h.T
        for t in range(steps):
            at = t if keep else 0
            begun, g, gates, n, out = h0[at], gh[at], rz[at], new[at], states[t + 1]
            np.matmul(wx, embedded[t].T, out=x)
            x += bias
            np.multiply(states[t], flows[t], out=begun)
            np.matmul(wh, begun, out=g)
            np.add(x[:2 * k], g[:2 * k], out=gates)
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            np.multiply(gates[:k], g[2 * k:], out=n)
            n += x[2 * k:]
            np.tanh(n, out=n)
            np.subtract(begun, n, out=out)
            out *= gates[k:]
            out += n
        rows = self.room("rows", steps, lanes, k + 1)
        rows[:, :, :k] = states[1:].transpose(0, 2, 1)
        rows[:, :, k] = 1
        return rows, (flows, embedded, h0, gh, rz, new)

    def nodes(self, number: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, int, int, np.ndarray]]]:
        """An order of tokens by class, and the softmaxes that they pass: the level, the rows in the order, the
        outputs, and the places of the rows' tokens in the product of rows and outputs."""
        of = self.of[number]
        order = np.argsort(of.astype(np.uint16), kind="stable")  # sorted by radix
        of, number = of[order], number[order].astype(np.int64)
        group, words = of // self.run, int(np.searchsorted(of, len(self.levels[2]) - 1))  # endings come last
        found = []
        for level, (bounds, node, target) in enumerate(zip(
                self.levels, (np.zeros_like(of), group, of[:words]), (group, of, number[:words]))):
            cuts, size = np.searchsorted(node, np.arange(len(bounds))), np.diff(bounds)
            if len(node):
                place = (np.arange(len(node)) - cuts[node]) * size[node] + target + (self.levels[level][0] - bounds[node])
                found += [(level, a, b, lo, hi, place[a:b]) for a, b, lo, hi in zip(
                    cuts.tolist(), cuts[1:].tolist(), bounds.tolist(), bounds[1:].tolist()) if b > a and hi - lo > 1]
        return order, found

    def safe(self, rows: np.ndarray) -> bool:
        """Whether all logits of ``rows`` are far from the range's ends, by the lengths of rows and weights."""
        w, h = self.p["out"][:, :self.hidden], rows[:, :self.hidden]
        most = math.sqrt(np.einsum("ij,ij->i", h, h).max(initial=0))
        return bool((np.sqrt(np.einsum("ij,ij->i", w, w)) * most + np.abs(self.p["out"][:, self.hidden])).max() < SAFE)

    @staticmethod
    def exponentials(x: np.ndarray, at: np.ndarray, safe: bool) -> tuple[np.ndarray, np.ndarray]:
        """(the logit of each row's token, which stands at ``at``, the sums); ``x`` gets the exponentials."""
        if not safe:
            x -= x.max(1, keepdims=True)
        want = x.ravel()[at]
        np.exp(x, out=x)
        return want, x.sum(1)

    def log_probability(self, h: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Natural log of each token's class, times its share of a word class. A state may end with its 1."""
        if h.shape[1] == self.hidden:
            h = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)
        safe, (order, nodes) = self.safe(h), self.nodes(number)
        state = np.take(h, order, 0, self.room("state", *h.shape), "clip")
        want, total = np.zeros((3, len(h)), self.flat.dtype), np.ones((3, len(h)), self.flat.dtype)
        for level, a, b, lo, hi, place in nodes:
            x = np.matmul(state[a:b], self.p["out"][lo:hi].T, out=self.room("x", b - a, hi - lo))
            want[level, a:b], total[level, a:b] = self.exponentials(x, place, safe)
        out = np.empty(len(h), self.flat.dtype)
        out[order] = (want - np.log(total)).sum(0)
        return out

    def gradient(self, before: np.ndarray, number: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient (as ``flat``) and last state for one window: rows are steps, columns streams."""
        p, k = self.p, self.hidden
        gradient = self.room("gradient", len(self.flat))
        gradient[:] = 0
        g = self.views(gradient)
        steps, lanes = number.shape
        n_rows = steps * lanes
        states, (flows, embedded, h0, gh, rz, new) = self.forward(before, h, keep=True)
        last, states = states[-1, :, :k].copy(), states.reshape(n_rows, k + 1)
        safe, (order, nodes) = self.safe(states), self.nodes(number.ravel())
        state, more = np.take(states, order, 0, self.room("state", n_rows, k + 1), "clip"), self.room("more", n_rows, k + 1)
        more[:] = 0
        want, total = np.zeros((3, n_rows), self.flat.dtype), np.ones((3, n_rows), self.flat.dtype)
        for level, a, b, lo, hi, place in nodes:
            held, out = state[a:b], p["out"][lo:hi]
            x = np.matmul(held, out.T, out=self.room("x", b - a, hi - lo))
            want[level, a:b], sums = self.exponentials(x, place, safe)
            total[level, a:b] = sums
            x /= sums[:, None]
            x.ravel()[place] -= 1
            np.matmul(x.T, held, out=g["out"][lo:hi])
            more[a:b] += x @ out
        loss = float(np.log(total).sum()) - float(want.sum())
        back_order = np.empty_like(order)
        back_order[order] = np.arange(n_rows)
        dh = np.take(more, back_order, 0, self.room("state", n_rows, k + 1), "clip")
        d_states = self.room("d_states", steps, k, lanes)
        d_states[:] = dh.reshape(steps, lanes, k + 1)[:, :, :k].transpose(0, 2, 1)
        # factors of the gates' gradients, for all steps
        slope = np.multiply(rz, rz, out=self.room("slope", steps, 2 * k, lanes))
        np.subtract(rz, slope, out=slope)
        slope[:, :k] *= gh[:, 2 * k:]
        h_new = np.subtract(h0, new, out=self.room("more", steps, k, lanes))
        slope[:, k:] *= h_new
        np.multiply(new, new, out=new)
        np.subtract(1, new, out=new)
        dgx, dgh, back = self.room("gx", steps, 3 * k, lanes), gh, np.zeros((k, lanes), self.flat.dtype)
        for t in reversed(range(steps)):
            d, dx, dg = d_states[t], dgx[t], dgh[t]
            d += back
            through = d * rz[t, k:]
            np.multiply(d, slope[t, k:], out=dg[k:2 * k])
            d -= through
            dn = np.multiply(d, new[t], out=dx[2 * k:])
            np.multiply(dn, slope[t, :k], out=dg[:k])
            np.multiply(dn, rz[t, :k], out=dg[2 * k:])
            back = p["wh"] @ dg
            back += through
            back *= flows[t]
        dgx[:, :2 * k] = dgh[:, :2 * k]
        by_lane = dgx.transpose(0, 2, 1)
        g["wh"][:] = np.matmul(h0, dgh.transpose(0, 2, 1)).sum(0)
        g["wx"][:], g["b"][:] = np.matmul(embedded.transpose(0, 2, 1), by_lane).sum(0), dgx.sum((0, 2))
        back = np.matmul(by_lane, p["wx"].T, out=self.room("dh", steps, lanes, k)).reshape(n_rows, k)
        before = before.ravel()
        order = np.argsort(before.astype(np.uint16) if len(p["emb"]) <= 1 << 16 else before, kind="stable")
        sorted_ = before[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        g["emb"][sorted_[first]] = np.add.reduceat(np.take(back, order, 0, self.room("more", n_rows, k), "clip"), first, axis=0)
        return loss, gradient, last

    def train(self, stream: np.ndarray, epochs: int = 1, rate: float = RATE, after: int = 0,
              of: int | None = None) -> list[float]:
        """Truncated backpropagation by Adam over the stream in STREAMS parallel parts; the state
        runs on from window to window. Every token is learnt; the parts overlap by the few tokens
        that make them equally long. The rate falls over ``of`` epochs, of which ``after`` are
        over. Returns each epoch's loss a token."""
        lanes = max(1, min(STREAMS, len(stream) // (4 * STEPS)))
        length = -(-len(stream) // lanes)
        if not length:
            return []
        at = np.arange(length)[:, None] + np.arange(lanes) * (len(stream) - length) // max(lanes - 1, 1)
        lane, ahead = stream[at], np.concatenate([np.array([self.end], stream.dtype), stream[:-1]])[at]
        m, v, change = (np.zeros_like(self.flat) for _ in range(3))
        windows = -(-length // STEPS)
        n, losses, total = 0, [], (of or epochs) * windows
        for _ in range(epochs):
            h, loss, seen = np.zeros((lanes, self.hidden), np.float32), 0.0, 0
            for a in range(0, length, STEPS):
                want = lane[a:a + STEPS]
                part, x, h = self.gradient(ahead[a:a + STEPS], want, h)
                loss, seen, n = loss + part, seen + want.size, n + 1
                speed = rate * max(0.05, 1 - (after * windows + n) / total)
                speed = np.float32(speed * math.sqrt(1 - 0.99 ** n) / (1 - 0.9 ** n))
                # m and v are kept as sums, of gradients and squares that are not divided by the lanes
                np.clip(x, -lanes, lanes, out=x)
                m *= np.float32(0.9)
                m += x
                v *= np.float32(0.99)
                x *= x
                v += x
                np.sqrt(v, out=change)
                change += np.float32(1e-5 * lanes)
                np.divide(m, change, out=change)
                change *= speed
                self.flat -= change
            losses.append(loss / max(seen, 1))
        return losses

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log-likelihood of whole documents (token numbers, the end included).

        Documents run side by side in lanes, one after the other in a lane, as in training: the state
        is carried from window to window and starts from nothing after an end. What is held beside the
        documents is one window of states, however long a document is.
        """
        out = np.zeros(len(documents))
        if not documents:
            return out
        lanes: list[list[int]] = [[] for _ in range(min(LANES, len(documents)))]
        load = [(0, i) for i in range(len(lanes))]
        for d in sorted(range(len(documents)), key=lambda i: -len(documents[i])):  # to the shortest lane
            size, lane = heapq.heappop(load)
            lanes[lane].append(d)
            heapq.heappush(load, (size + len(documents[d]), lane))
        lanes.sort(key=lambda held: -sum(len(documents[d]) for d in held))
        streams = [documents[held[0]] if len(held) == 1 else np.concatenate([documents[d] for d in held]) for held in lanes]
        size = np.array([len(x) for x in streams])
        ends = [np.cumsum([len(documents[d]) for d in held]).tolist() for held in lanes]
        flat_ends, flat_docs = np.array([e for x in ends for e in x]), np.array([d for held in lanes for d in held])
        n_docs = np.array([len(held) for held in lanes])
        base, begun = np.cumsum(n_docs) - n_docs, np.zeros(len(lanes), np.int64)  # lanes' first documents; those not yet over
        h, last, t = np.zeros((len(lanes), self.hidden), np.float32), np.full(len(lanes), self.end), 0
        while t < size[0]:
            live = int(np.searchsorted(-size, -t, side="left"))  # lanes with tokens left; they end in order
            steps = max(8, ROWS // live)
            window = np.full((steps, live), self.end, np.int32)
            for j in range(live):
                part = streams[j][t:t + steps]
                window[:len(part), j] = part
            states, _ = self.forward(np.concatenate([last[None, :live], window[:-1]]), h[:live])
            h, last = states[-1, :, :self.hidden].copy(), window[-1]
            found = np.zeros((steps, live))
            if size[live - 1] - t >= steps:
                found[:] = self.log_probability(states.reshape(steps * live, -1), window.ravel()).reshape(steps, live)
            else:
                real = np.arange(steps)[:, None] < size[:live] - t
                found[real] = self.log_probability(states[real], window[real])
            upto = np.cumsum(found, axis=0)
            # documents of a lane that have a part in the window end at these places in it
            a, b = begun[:live], np.array([bisect_left(ends[j], min(t + steps, int(size[j])), int(begun[j])) for j in range(live)])
            n = b - a + 1
            lane = np.repeat(np.arange(live), n)
            place = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
            cut = np.minimum(flat_ends[base[lane] + place], t + steps) - t
            sums = upto[cut - 1, lane]
            sums[1:] -= np.where(lane[1:] == lane[:-1], sums[:-1].copy(), 0)
            out[flat_docs[base[lane] + place]] += sums
            begun[:live] = b + (flat_ends[base[:live] + b] <= t + steps)
            t += steps
        return out

    def put(self, flat: np.ndarray) -> None:
        self.flat[:] = flat

    def saved(self) -> bytes:
        return self.flat.tobytes()

    def load(self, raw: bytes) -> Network:
        self.flat[:] = np.frombuffer(raw, np.float32)
        return self


def count_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, c) over all texts, ends included. Tasks sum up some megabytes of text each time before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = pc.value_counts(split(batch.column(0)).flatten().cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "c"])

    rows = df.select(text_or_empty(text_col)).mapInArrow(run, "word binary, c long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(types: int) -> int:
    """Words with weights of their own: FREQUENT, from a million types on four times their root."""
    return max(FREQUENT, math.isqrt(16 * types))


def word_table(counts: DataFrame) -> Words:
    """The part of the counts that tasks hold (at most HELD words, ENDING_CLASSES endings), and the sums.

    The held words are those above the least count at which there are no more than HELD of them,
    found from a histogram over some thousands of logarithmic steps. So the driver gets the held
    words alone, not the best HELD of every partition.
    """
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    step = F.floor(F.log2("c") * 64).cast("int")
    least, words_above = None, 0
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        words_above += r["count"]
        if words_above > HELD:
            break
        least = r["step"]
    held = [] if least is None else counts.filter(step >= least).collect()
    top = sorted(held, key=lambda r: (-r["c"], bytes(r["word"])))
    rank = {bytes(r["word"]): i for i, r in enumerate(top)}
    count = np.array([r["c"] for r in top], np.int64)
    frequent = min(frequent_words(int(sums["v"] or 0)), len(top))
    classes = max(WORD_CLASSES, math.isqrt(frequent))
    share = np.cumsum(count[:frequent]) / max(count[:frequent].sum(), 1)
    bounds = np.unique(np.concatenate([[0], np.searchsorted(share, np.arange(1, classes) / classes) + 1, [frequent]]))
    bounds = bounds[bounds <= frequent]
    # rare words by ending: all of them, so also those that no task holds
    last = top[frequent - 1] if frequent else None
    rare = counts if last is None else counts.filter(
        (F.col("c") < last["c"]) | ((F.col("c") == last["c"]) & (F.col("word") > F.lit(bytearray(last["word"])))))
    by_ending = rare.groupBy(F.expr(f"substring(word, -least({ENDING}, length(word)), {ENDING})").alias("ending")) \
        .agg(F.sum(F.col("c") + 1).alias("m"))
    # the end alone has no ending: where it is no frequent word, it has a class of its own
    chosen = by_ending.orderBy(F.length("ending") > 0, F.desc("m"), "ending").limit(ENDING_CLASSES - 1).collect()
    all_mass = by_ending.agg(F.sum("m")).first()[0] or 0
    mass = [r["m"] for r in chosen]
    mass.append(all_mass - sum(mass))
    return Words(rank, count, int(sums["n"] or 0), int(sums["v"] or 0), bounds.astype(np.int64),
                 {bytes(r["ending"]): i for i, r in enumerate(chosen)}, np.array(mass, float) + 1)


def code(docs: DataFrame, words: Words) -> DataFrame:
    """Every document (``id``, ``whole``, ``learn``) as token numbers, staged with a number for its ``row`` and ``h``, a
    hash of its id and text: ``numbers``
    (2 or 4 bytes each), ``n_tokens``, ``n_held`` (words whose counts tasks hold), ``base`` (their part of the base
    score, and what the others have without their counts), ``inside`` (words' shares within their ending
    classes, as far as they are known) and the ``rare`` words that are not held, with their ``times``."""
    held = docs.sparkSession.sparkContext.broadcast(words)
    kind = number_kind(words)
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held.value
        unseen, log_mass = np.log10(words.total + words.types + 1), np.log10(words.mass)
        base, share = np.append(words.base, -unseen), np.append(words.inside, 0)  # the last: of words that are not held
        for batch in slices(batches, 4 << 20):
            lists = split(batch.column("whole"))
            got, starts = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy()
            at, number = words.numbers(got)
            lacking = np.flatnonzero(at < 0)
            # what the join adds for the rare ones is log10(c + 1), the same for either score
            inside = share[at]
            inside[lacking] = -log_mass[number[lacking] - words.frequent]
            n_held, by_base, inside = (np.add.reduceat(x, starts[:-1]) for x in ((at >= 0).astype(np.int64), base[at], inside))
            names, cuts = got.take(pa.array(lacking)).to_pylist(), np.searchsorted(lacking, starts).tolist()
            rare = [Counter(names[a:b]) for a, b in zip(cuts, cuts[1:])]
            number = number.astype(kind)
            numbers = pa.Array.from_buffers(pa.binary(), len(lists), [
                None, pa.py_buffer((starts * number.itemsize).astype(np.int32)), pa.py_buffer(number)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("learn"), batch.column("h"), numbers, pa.array(np.diff(starts).astype(np.int64)),
                 pa.array(n_held), pa.array(by_base), pa.array(inside), pa.array(map(list, rare), pa.list_(pa.binary())),
                 pa.array((list(x.values()) for x in rare), pa.list_(pa.int64()))],
                ["id", "learn", "h", "numbers", "n_tokens", "n_held", "base", "inside", "rare", "times"])

    whole = text_or_empty("whole")
    coded = docs.select("id", "learn", F.xxhash64("id", whole).alias("h"), whole.alias("whole")).mapInArrow(
        run, f"id {id_type}, learn boolean, h long, numbers binary, n_tokens long, n_held long, base double, inside double, "
             "rare array<binary>, times array<long>")
    return stage(coded.withColumn("row", F.monotonically_increasing_id()), "lm-coded")


def number_kind(words: Words) -> str:
    return "<u2" if words.frequent + len(words.mass) <= 1 << 16 else "<i4"


def train(coded: DataFrame, words: Words, seed: int = 11) -> Network:
    """The network, trained on every document of ``coded`` that is to be learnt.

    Documents are dealt by a seeded hash to parts of about TRAIN_TOKENS tokens (or as many as the network
    has weights, so that the weights of all parts are no more than the tokens), and those of a part to
    ROUNDS rounds. Copies of a row that fill a good share of a part are dealt each by itself. In a round a task learns its part's documents from the current weights, and the mean
    of all parts' weights, by their tokens, is taken on Spark, slice by slice. So every document is
    learnt once, and the driver gets one network a round.
    """
    net = Network(words)
    if not words.total:
        return net
    spark = coded.sparkSession
    n_parts = -(-words.total // max(TRAIN_TOKENS, len(net.flat)))
    n_slices = -(-len(net.flat) // SLICE)
    held = spark.sparkContext.broadcast(words)
    kind = number_kind(words)
    mine = coded.filter("learn")
    times = mine.groupBy("h").count()
    # at most 4 hashes a part and round
    many = times.filter(F.col("count") * (4 * n_parts * ROUNDS) > mine.agg(F.count(F.lit(1))).scalar()).select("h", F.lit(True).alias("many"))
    own = F.when(F.col("many"), F.xxhash64("h", "row")).otherwise(F.col("h"))
    dealt = mine.join(F.broadcast(many), "h", "left").select(F.xxhash64(F.lit(seed), own).alias("h"), "numbers")
    dealt = dealt.withColumn("part", F.pmod("h", F.lit(n_parts)))
    for turn in range(ROUNDS):
        raw = spark.sparkContext.broadcast(net.saved())

        def learn(batches: Iterator[pa.RecordBatch], turn: int = turn, raw=raw) -> Iterator[pa.RecordBatch]:
            total, seen, part, docs = 0.0, 0, None, []

            def fit() -> None:
                nonlocal total, seen
                stream = np.concatenate(docs)
                net = Network(held.value).load(raw.value)
                net.train(stream, after=turn, of=ROUNDS)
                total, seen = total + net.flat.astype(np.float64) * len(stream), seen + len(stream)
                docs.clear()

            for batch in batches:
                for p, numbers in zip(batch.column("part").to_pylist(), batch.column("numbers").to_pylist()):
                    if p != part and docs:
                        fit()
                    part = p
                    docs.append(np.frombuffer(numbers, kind))
            if docs:
                fit()
            if seen:
                mean = (total / seen).astype(np.float32)
                cut = [mean[a:a + SLICE].tobytes() for a in range(0, len(mean), SLICE)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array([seen] * len(cut), pa.int64()),
                                                  pa.array(cut, pa.binary())], ["slice", "n", "weights"])

        def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict = {}
            for batch in batches:
                for k, n, weights in zip(*(c.to_pylist() for c in batch.columns)):
                    total, seen = sums.get(k, (0.0, 0))
                    sums[k] = total + np.frombuffer(weights, np.float32).astype(np.float64) * n, seen + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([n for _, n in sums.values()], pa.int64()),
                 pa.array([(t / n).astype(np.float32).tobytes() for t, n in sums.values()], pa.binary())],
                ["slice", "n", "weights"])

        schema = "slice int, n long, weights binary"
        now = dealt.filter(F.pmod(F.xxhash64("h"), F.lit(ROUNDS)) == turn)
        learnt = now.repartitionByRange(n_parts, "part").sortWithinPartitions("part", "h").mapInArrow(learn, schema)
        got = sorted(learnt.repartition(min(n_slices, n_parts), "slice").mapInArrow(mean, schema).collect())
        if got:  # a round may have no documents
            net.put(np.concatenate([np.frombuffer(r["weights"], np.float32) for r in got]))
    return net


def score(df: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10) of
    every whole text of ``df``, learning from the rows for which ``learn`` holds.

    Counts cover all training rows; words that tasks do not hold get theirs by a join. A null text
    is empty: its end alone. A null ``learn`` counts as not held out of nothing: false. Repeated
    rows are each counted and scored; with no training rows every word is unseen.
    """
    spark = prepared(df.sparkSession)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("whole"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = stage(count_words(docs.filter("learn"), "whole"), "word-counts")
    words = word_table(counts)
    coded = code(docs, words)
    net = train(coded, words)
    held = spark.sparkContext.broadcast((words, net.saved()))
    kind = number_kind(words)
    made: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "net" not in made:
            made["net"] = Network(held.value[0]).load(held.value[1])
        for batch in slices(batches, 16 << 20):  # enough documents to fill the lanes
            numbers = [np.frombuffer(x, kind) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made["net"].score(numbers) / np.log(10))], ["row", "model"])

    scored = stage(coded.select("row", "numbers").mapInArrow(run, "row long, model double"), "lm-scores")
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    found = rare.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"))
    both = coded.drop("h", "numbers", "rare", "times").join(scored, "row").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return both.select(
        F.col("id").alias(id_col), (~F.col("learn")).alias("held_out"), "n_tokens",
        (F.col("n_held") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("model") + F.col("inside") + more).alias("score"))
