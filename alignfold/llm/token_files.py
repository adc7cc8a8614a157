"""Token-id files: raw id payloads with a minimal perfect hash index from document keys to offsets.

A shard is two files: ``.ids`` (a small header, then the ids of its documents one after the other)
and ``.idx`` (a header with the places of its arrays: document ids, offsets, and a minimal perfect hash
of the different ids, with a rank count a block and a fingerprint for each). Keyed access hashes the id a
few times, reads a block of bits a try, compares one fingerprint and reads one slice: a few small reads
of either file, whatever its size. Shards are cut from the documents in ascending order of their ids, so
the manifest's lowest and highest ids say which shard may hold a key.
"""

from __future__ import annotations

import operator
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alignfold.llm.bpe import PieceEncoder, added_tokens, pieces_of, resolved
from alignfold.llm.common import prepared, scratch_path, slices, stage, text_or_empty

MAGIC = b"AFTOKENS"
#: Ids in a shard before the next one begins (a longer document stands alone).
SHARD_IDS = 8 << 20
#: Bits for each key in a level of the hash.
ROOM = 2.0


def scramble(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mix of each key (xor-shift and multiply), different for each salt."""
    x = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Minimal perfect hash in levels: a key whose place in a level no other key takes sets that
    place's bit; the others go on to the next level. A key's number is the rank of its bit."""

    sizes: np.ndarray  # places of each level
    bits: np.ndarray  # packed, level after level

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, found, left, level = [], [], keys.astype(np.int64), 0
        while len(left):
            size = max(int(len(left) * ROOM), 8)
            at = (scramble(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            found.append(alone)
            left = left[~alone[at]]
            level += 1
        bits = np.packbits(np.concatenate(found)) if found else np.zeros(0, np.uint8)
        return cls(np.array(sizes, np.int64), bits)

    def __post_init__(self) -> None:
        flags = np.unpackbits(self.bits, count=int(self.sizes.sum())) if len(self.bits) else np.zeros(0, np.uint8)
        self.flags = flags.astype(bool)
        self.rank = np.cumsum(flags, dtype=np.int64) - flags
        self.first = np.cumsum(self.sizes) - self.sizes

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; -1 where no level has its bit (surely absent)."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (scramble(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.first[level]
            hit = self.flags[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out


def key_print(keys: np.ndarray) -> np.ndarray:
    return (scramble(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


INDEX_MAGIC = b"AFINDEX1"
SECTIONS = {"sizes": "<i8", "bits": "u1", "ranks": "<i8", "prints": "<u4", "rows": "<i8", "runs": "<i8", "offsets": "<i8",
            "doc_ids": "<i8", "null_id": "u1"}
BLOCK_BITS = 512  # places of the hash for which one rank is stored


class Shard:
    """A shard's two files. Arrays are read whole on first use, and ``get`` reads only what a key needs."""

    def __init__(self, path: str):
        self.path = path
        files, base = fs.FileSystem.from_uri(path)
        self.index, self.payload = files.open_input_file(base + ".idx"), files.open_input_file(base + ".ids")
        head = np.frombuffer(self.index.read(8 + 16 * len(SECTIONS)), np.uint8)
        kind = self.payload.read(16)
        if head[:8].tobytes() != INDEX_MAGIC or kind[:8] != MAGIC:
            raise ValueError(f"{path}: not a token file")
        table = head[8:].view("<i8").reshape(-1, 2)
        self.sections = {name: (int(at), int(n)) for name, (at, n) in zip(SECTIONS, table)}
        self.kind = np.dtype({2: "<u2", 4: "<u4"}[kind[8]])
        self.sizes = self.part("sizes", 0, self.sections["sizes"][1])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.whole: dict[str, np.ndarray] = {}

    def part(self, name: str, start: int, n: int) -> np.ndarray:
        """``n`` values of an array of the index."""
        at, kind = self.sections[name][0], np.dtype(SECTIONS[name])
        self.index.seek(at + start * kind.itemsize)
        return np.frombuffer(self.index.read(n * kind.itemsize), kind)

    def __getattr__(self, name: str) -> np.ndarray:
        if name not in SECTIONS:
            raise AttributeError(name)
        if name not in self.whole:
            self.whole[name] = self.part(name, 0, self.sections[name][1])
        return self.whole[name]

    def slice(self, a: int, b: int) -> np.ndarray:
        self.payload.seek(16 + a * self.kind.itemsize)
        return np.frombuffer(self.payload.read((b - a) * self.kind.itemsize), self.kind)

    @property
    def ids(self) -> np.ndarray:
        return self.slice(0, int(self.offsets[-1]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, number of rows) of each document id; 0 rows where the shard does not hold it."""
        number = PerfectHash(self.sizes, self.bits).number(keys)
        safe = np.maximum(number, 0)
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        there = (number >= 0) & (self.prints[safe] == key_print(keys))
        return self.rows[safe], np.where(there, self.runs[safe], 0)

    def find_one(self, key: int) -> tuple[int, int]:
        """``find`` for one id: a block of bits and its rank for each level tried, then one entry."""
        hashed = np.array([key], np.int64)
        for level, size in enumerate(self.sizes):
            at = int(scramble(hashed, level)[0] % np.uint64(size)) + int(self.first[level])
            block = at // BLOCK_BITS
            most = self.sections["bits"][1] - block * BLOCK_BITS // 8
            flags = np.unpackbits(self.part("bits", block * BLOCK_BITS // 8, min(BLOCK_BITS // 8, most)))
            inside = at - block * BLOCK_BITS
            if flags[inside]:
                number = int(self.part("ranks", block, 1)[0]) + int(flags[:inside].sum())
                if self.part("prints", number, 1)[0] != key_print(hashed)[0]:
                    break
                return int(self.part("rows", number, 1)[0]), int(self.part("runs", number, 1)[0])
        return 0, 0

    def get(self, doc_id: int) -> list[np.ndarray]:
        """The ids of the documents with this id, in the order of the file."""
        row, n = self.find_one(doc_id)
        ends = self.part("offsets", row, n + 1) if n else np.zeros(1, np.int64)
        held = self.slice(int(ends[0]), int(ends[-1])).astype("<u4")
        return [held[a:b] for a, b in zip(ends - ends[0], ends[1:] - ends[0])]


def save_shard(path: str, doc_ids: np.ndarray, null_id: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
    files, base = fs.FileSystem.from_uri(path)
    real = np.flatnonzero(~null_id)  # nulls come first in the order, the others ascend
    keys, first, runs = np.unique(doc_ids[real], return_index=True, return_counts=True)
    table = PerfectHash.build(keys)
    number = table.number(keys)
    prints, rows, count = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    prints[number], rows[number], count[number] = key_print(keys), real[first] if len(real) else first, runs
    with files.open_output_stream(base + ".ids") as f:
        f.write(MAGIC + bytes([ids.dtype.itemsize]) + bytes(7))
        f.write(memoryview(np.ascontiguousarray(ids)).cast("B") if len(ids) else b"")
    arrays = {"sizes": table.sizes, "bits": table.bits, "ranks": table.rank[::BLOCK_BITS], "prints": prints, "rows": rows,
              "runs": count, "offsets": np.concatenate([[0], np.cumsum(sizes)]), "doc_ids": doc_ids, "null_id": null_id}
    at, table_, body = 8 + 16 * len(SECTIONS), [], []
    for name, kind in SECTIONS.items():
        raw = arrays[name].astype(kind).tobytes()
        table_.append((at, len(arrays[name])))
        body.append(raw + bytes(-len(raw) % 8))
        at += len(body[-1])
    with files.open_output_stream(base + ".idx") as f:
        f.write(INDEX_MAGIC + np.array(table_, "<i8").tobytes() + b"".join(body))


MANIFEST = "part int, seq int, path string, docs long, ids long, low long, high long"


def write_files(df: DataFrame, folder: str, tokenizer: str, pattern: str, end_id: int = 2, id_col: str = "doc_id",
                text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards of all documents, in ascending order of (id, hash of the text), below ``folder``.

    Returns the manifest, a staged table with one row per shard: place in the order, path, numbers
    of documents and ids, lowest and highest document id. ``folder`` is a URI that all executors
    reach (a path or any scheme of pyarrow.fs). Each task writes files of its own name and only the
    manifest says which count, so a repeated or lost task leaves no wrong shard.

    Added tokens of the library's JSON file are found inside texts, as the library does by default (a
    rank file has none); the rest is cut by the pattern. A null text is empty (its end id alone), a null id
    comes first and is read by place, equal ids stand side by side. An empty table gives an empty manifest. Ids are stored in 2 bytes where the vocabulary allows it, else in 4.
    """
    prepared(df.sparkSession)
    files, base = fs.FileSystem.from_uri(folder)
    files.create_dir(base, recursive=True)
    order = [F.col("doc"), F.col("h")]  # a hash, as the range sampling sends keys to the driver
    whole = text_or_empty(text_col)
    sorted_ = df.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(whole).alias("h"), whole.alias("whole")) \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    added = added_tokens(tokenizer)
    with_added = reduce(operator.or_, (F.contains("whole", F.lit(t)) for t in added), F.lit(False))
    rows = sorted_.select("doc", *pieces_of(F.when(with_added, "").otherwise(F.col("whole")), pattern),
                          F.when(with_added, F.col("whole")).alias("with_added"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceEncoder.of(tokenizer)
        kind = np.dtype("<u2" if max(len(coder.tokens), end_id + 1, *(i + 1 for i in added.values())) <= 1 << 16 else "<u4")
        docs, sizes, parts, held, seq = [], [], [], 0, 0
        attempt = uuid.uuid4().hex

        def flush() -> pa.RecordBatch:
            doc = pa.concat_arrays(docs)
            null = doc.is_null().to_numpy(zero_copy_only=False)
            key, size = doc.fill_null(0).to_numpy(), np.concatenate(sizes)
            name = f"{folder}/part-{part:05d}-{seq:05d}-{attempt}"
            save_shard(name, key, null, size, np.concatenate(parts))
            known = key[~null]
            row = (part, seq, name, len(key), int(size.sum()), *((int(known[0]), int(known[-1])) if len(known) else (None, None)))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (
                pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4))], [c.split()[0] for c in MANIFEST.split(", ")])

        for batch in slices(batches):
            part = batch.column("part")[0].as_py()
            ids, at = coder.encode(resolved(batch, pattern))
            n = len(at) - 1
            whole = batch.column("with_added")
            if whole.null_count < n:
                got = [ids[a:b] for a, b in zip(at, at[1:])]
                rows = np.flatnonzero(whole.is_valid().to_numpy(zero_copy_only=False))
                for i, row in zip(rows, coder.encode_whole(whole.drop_null().to_pylist(), pattern)):
                    got[i] = row
                ids, at = np.concatenate(got), np.concatenate([[0], np.cumsum([len(x) for x in got])])
            ids = np.insert(ids, at[1:], end_id).astype(kind)
            docs.append(batch.column("doc"))
            sizes.append(np.diff(at) + 1)
            parts.append(ids)
            held += len(ids)
            if n and held >= shard_ids:
                yield flush()
                docs, sizes, parts, held, seq = [], [], [], 0, seq + 1
        if docs:
            yield flush()

    return stage(rows.mapInArrow(run, MANIFEST), "token-manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, found through the index: id, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers).

    The driver holds the manifest's counts, one row per shard.
    """
    spark = manifest.sparkSession
    shards = sorted((r["part"], r["seq"], r["path"], r["ids"]) for r in manifest.select("part", "seq", "path", "ids").collect())
    starts, total = [], 0
    for _, _, path, n in shards:
        starts.append((path, total))
        total += n
    plan = spark.createDataFrame(starts or [], "path string, start long").repartition(max(len(starts), 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path)
                null = shard.null_id.astype(bool)
                keys = np.unique(shard.doc_ids[~null])
                row, n = shard.find(keys)
                nulls = np.flatnonzero(null)
                at = np.concatenate([nulls, np.repeat(row - (np.cumsum(n) - n), n) + np.arange(n.sum())])
                doc = pa.array(np.concatenate([np.zeros(len(nulls), np.int64), np.repeat(keys, n)]),
                               mask=np.arange(len(at)) < len(nulls))
                a, b = shard.offsets[at], shard.offsets[at + 1]
                held = memoryview(shard.ids.astype("<u4")).cast("B") if b.max(initial=0) else b""
                crc = [zlib.crc32(held[4 * x:4 * y]) for x, y in zip(a.tolist(), b.tolist())]
                yield pa.RecordBatch.from_arrays([doc, pa.array(start + a), pa.array(b - a), pa.array(crc, pa.int64())],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    return plan.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Id and ``ids`` (array of long) of every document whose id is in ``keys``, by keyed access.

    The manifest's lowest and highest ids choose the shards that may hold a key (two or more where equal
    ids go on in the next shard). Keys are brought together by shard, those of a much-asked shard over
    several tasks, and each costs a few small reads. Equal keys count once; null ids have no key, and
    absent ids give no row. The driver holds the manifest, one row a shard.
    """
    spark = manifest.sparkSession
    known = manifest.filter("low IS NOT NULL").select("path", "low", "high", "part", "seq").collect()
    shards = sorted(known, key=lambda r: (r["part"], r["seq"]))
    sent = spark.sparkContext.broadcast(([r["path"] for r in shards], np.array([r["low"] for r in shards], np.int64),
                                         np.array([r["high"] for r in shards], np.int64)))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, low, high = sent.value
        for batch in batches:
            asked = batch.column(0).to_numpy()
            first, last = np.searchsorted(high, asked, "left"), np.searchsorted(low, asked, "right")
            n = np.maximum(last - first, 0)
            shard = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asked, n)), pa.array(shard, pa.int32())], ["id", "shard"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, at = None, None
        for batch in batches:
            ids, got = [], []
            for key, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != at:
                    opened, at = Shard(sent.value[0][shard]), shard
                found = opened.get(key)
                ids += [key] * len(found)
                got += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(got, pa.list_(pa.int64()))], ["id", "ids"])

    asked = keys.select(F.col(id_col).cast("long").alias("id")).dropna().distinct().mapInArrow(choose, "id long, shard int")
    dealt = asked.repartition("shard", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("shard", "id")
    return dealt.mapInArrow(read, "id long, ids array<long>").withColumnRenamed("id", id_col)


def new_folder(df: DataFrame) -> str:
    return scratch_path(df.sparkSession, "token-files")
