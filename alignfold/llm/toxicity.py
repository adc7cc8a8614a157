"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text. A text is cut
into windows of whole words; each window is compressed with either dictionary, and the bytes that
the toxic one saves are its gain. A calibrated model turns the gains of a text into a probability.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import prepared, slices, text_or_empty

WINDOW = 64  # bytes after which a window ends with the word
ORDINARY_BYTES, TOXIC_BYTES = 16384, 4096
#: The classifier is fitted on at most so many labelled documents of each class, by seeded hash:
#: one half for the dictionaries, the other for the calibration.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 1400, 4000
#: The ordinary dictionary is trained on about so many of the sample's windows, evenly spread over it. This bounds
#: the trainer's memory where the sample holds very long texts.
ORDINARY_WINDOWS = 60_000
GRAM = 5


def windows(text: str) -> list[bytes]:
    out, held, n = [], [], 0
    for word in text.encode().lower().split():
        held.append(word)
        n += len(word) + 1
        if n >= WINDOW:
            out.append(b" " + b" ".join(held) + b" ")
            held, n = [], 0
    if held:
        out.append(b" " + b" ".join(held) + b" ")
    return out


def compressor(content: bytes):
    known = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(
        6, source_size=WINDOW + 32, dict_size=len(content), strategy=zstandard.STRATEGY_LAZY2, min_match=4,
        window_log=17, write_checksum=0, write_content_size=0, write_dict_id=0)
    known.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=params).compress


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary's content; of few samples (zstandard needs more), the samples themselves."""
    if len(samples) >= 8:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:size]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray  # of the features, the constant last
    centre: np.ndarray
    scale: np.ndarray

    def __post_init__(self) -> None:
        self.compressors = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "compressors": None}

    def features(self, text: str) -> np.ndarray:
        """Mean gain, largest, sum of the two largest, and the log of the sum of gains over 2."""
        if self.compressors is None:
            self.compressors = compressor(self.ordinary), compressor(self.toxic + self.ordinary)
        plain, toxic = self.compressors
        gain = sorted([len(plain(w)) - len(toxic(w)) for w in windows(text)])
        if not gain:
            return np.zeros(4)
        return np.array([sum(gain) / len(gain), gain[-1], sum(gain[-2:]), np.log1p(sum(g - 2 for g in gain if g > 2))])

    def score(self, text: str) -> float:
        x = np.append((self.features(text) - self.centre) / self.scale, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -35, 35))))


def toxic_words(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """The words of toxic texts that hold a run of GRAM bytes seen in many different surroundings
    there and hardly in ordinary texts. Counting surroundings (the word before) rather than places
    keeps the text of copied documents out."""
    def runs(text: str) -> Iterator[tuple[bytes, bytes]]:
        before = b""
        for word in text.encode().lower().split():
            held = b" " + word + b" "
            for i in range(len(held) - GRAM + 1):
                yield held[i:i + GRAM], before
            before = word

    around = Counter(run for run, _ in {x for t in toxic for x in runs(t)})
    least = max(3, len(toxic) // 60)
    around = {run: n for run, n in around.items() if n >= least}
    usual = Counter(run for run, _ in {x for t in ordinary for x in runs(t) if x[0] in around})
    ratio = len(toxic) / max(len(ordinary), 1)
    marked = {run for run, n in around.items() if n > 8 * ratio * (usual[run] + 0.5)}
    return [word for t in toxic for word in t.encode().lower().split()
            if any(held[i:i + GRAM] in marked for held in (b" " + word + b" ",) for i in range(len(held) - GRAM + 1))]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton steps; the last column of x is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_sample(rows: list[tuple[str, int, int]], prior: float) -> Model:
    """``rows``: (text, toxic, half). Half 0 trains the dictionaries, half 1 the calibration."""
    rows = list(dict.fromkeys(rows))  # copies add nothing
    part = lambda half, y: [t for t, label, h in rows if h == half and label == y]
    toxic, ordinary = part(0, 1), part(0, 0)
    plain = [w for t in ordinary for w in windows(t)]
    step = max(1, len(plain) // ORDINARY_WINDOWS)
    words = toxic_words(toxic, ordinary)
    grouped = [b" " + b" ".join(words[i:i + 8]) + b" " for i in range(0, len(words), 8)]
    model = Model(trained(plain[::step], ORDINARY_BYTES), trained(grouped, TOXIC_BYTES),
                  np.zeros(5), np.zeros(4), np.ones(4))
    texts = [(t, label) for t, label, h in rows if h == 1]
    y = np.array([label for _, label in texts], float)
    if not 0 < y.sum() < len(y):
        model.weights[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        return model
    x = np.array([model.features(t) for t, _ in texts])
    model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.hstack([(x - model.centre) / model.scale, np.ones((len(x), 1))])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))  # as frequent as in all labels
    model.weights = logistic(x, y, weight)
    return model


def fit(df: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", seed: int = 5) -> Model:
    """The model of the labelled documents of ``df`` for whose id ``learn`` holds.

    Fitted in one task on a bounded sample (TOXIC_SAMPLE and ORDINARY_SAMPLE documents, by seeded
    hash of their ids); how frequent toxic text is comes from all labels learnt from. Labels that
    are null or neither 0 nor 1 are not used; an id labelled twice is toxic if one label says so.
    Without both classes, every score is the share of toxic labels (0 without labels).
    """
    spark = prepared(df.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).filter(learn) \
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64(F.lit(seed), F.col("id")), F.col("id")]
    chosen = [known.filter(F.col("y") == y).orderBy(*order).limit(n)
              for y, n in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))]
    # at most TOXIC_SAMPLE + ORDINARY_SAMPLE ids: small enough to send to every executor
    ids = chosen[0].unionByName(chosen[1])
    sample = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("whole")).join(F.broadcast(ids), "id")
    sample = sample.select("whole", "y", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id")), F.lit(2)).cast("int").alias("half"))
    prior = count.get(1, 0) / max(sum(count.values()), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for b in batches for row in zip(*[c.to_pylist() for c in b.columns])]
        m = fit_sample(sorted(rows), prior)
        out = io.BytesIO()
        np.savez(out, ordinary=np.frombuffer(m.ordinary, np.uint8), toxic=np.frombuffer(m.toxic, np.uint8),
                 weights=m.weights, centre=m.centre, scale=m.scale)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    if not got:  # no labelled document: Spark drops the empty task
        return fit_sample([], prior)
    with np.load(io.BytesIO(bytes(got[0]["model"]))) as m:
        return Model(m["ordinary"].tobytes(), m["toxic"].tobytes(), m["weights"], m["centre"], m["scale"])


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = (), out: str = "score") -> DataFrame:
    """Id, carried columns and ``out`` (0 to 1) of every whole text.

    The text alone decides. Null and empty texts have no window: all their features are 0. A text
    of one endless word is one window. Equal texts have equal scores, repeated rows a row each, an empty
    table none. ``out`` must differ from the names carried.
    """
    prepared(df.sparkSession)
    kept = [id_col, *carry]
    # by place, so that no name of df can clash with another
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], text_or_empty(text_col).alias("whole"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = [model.score(t) for t in batch.column("whole").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:-1], "score"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, score double").toDF(*kept, out)
