"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Spark cuts texts into the pattern's matches (pieces); each task encodes every different piece of
a batch once with the library's BPE model on the piece's byte-to-character form and lays the ids
out with array arithmetic. Decoding reverses the byte table.
"""

from __future__ import annotations

import base64
import gc
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alignfold.llm.common import prepared, slices, text_or_empty

#: Pieces a worker remembers between batches (some 30 bytes each); beyond it, it keeps those of the last batch.
REMEMBERED_PIECES = 400_000


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow U+0100."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {b: chr(b) for b in printable}
    for b in range(256):
        table.setdefault(b, chr(256 + len(table) - len(printable)))
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_rules(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The pair that makes each longer token: what is left when only lower ranks may merge."""
    rules = []
    for token, rank in sorted(ranks.items(), key=lambda kv: kv[1]):
        parts = [bytes([b]) for b in token]
        while len(parts) > 2:
            near = [(ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best, i = min(near)
            if best >= rank:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            rules.append((parts[0], parts[1]))
    return rules


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of the library's JSON file, which it finds inside texts; a rank file has none."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens") or []}


class PieceEncoder:
    """Encodes pieces with a ``tokenizers`` BPE model; one per worker and vocabulary file."""

    _made: dict[str, PieceEncoder] = {}
    _libraries: dict[tuple[str, str], object] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer, models

        self.path = path
        chars = byte_characters()
        self.to_chars = str.maketrans({chr(b): c for b, c in chars.items()})
        if path.endswith(".json"):
            model = Tokenizer.from_file(path).model
            with open(path, encoding="utf-8") as f:
                vocab = json.load(f)["model"]["vocab"]
        else:
            ranks = read_ranks(path)
            form = lambda token: "".join(chars[b] for b in token)
            vocab = {form(t): r for t, r in ranks.items()}
            model = models.BPE(vocab=vocab, merges=[(form(a), form(b)) for a, b in merge_rules(ranks)])
        self.model = model
        back = {c: b for b, c in chars.items()}
        size = max(vocab.values()) + 1
        tokens: list[bytes] = [b""] * size
        for token, i in vocab.items():
            tokens[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.tokens = pa.array(tokens, pa.binary())
        self.token_bytes = np.array([len(t) for t in tokens], np.int64)
        self.whole = {t: i for i, t in enumerate(tokens)}
        self.known = pa.array([], pa.string())  # pieces, and the ids of each, 4 bytes an id
        self.known_ids = pa.array([], pa.large_binary())

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def encode_piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        i = self.whole.get(raw)
        if i is not None:
            return [i]
        return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(self.to_chars))]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, 4 bytes an id. Tokens are many small objects without cycles: the collector of
        cycles would walk over them in vain."""
        was_on = gc.isenabled()
        gc.disable()
        try:
            return [np.array(self.encode_piece(p), np.int32).tobytes() for p in pieces]
        finally:
            if was_on:
                gc.enable()

    def encode_whole(self, texts: list[str], pattern: str) -> list[np.ndarray]:
        """Ids of whole texts by the library with its defaults: added tokens first, each stretch between
        them cut by the pattern."""
        if (self.path, pattern) not in self._libraries:
            from tokenizers import Regex, Tokenizer, pre_tokenizers

            library = Tokenizer.from_file(self.path)
            library.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(Regex(pattern), "removed", invert=True),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            library.no_truncation()
            library.no_padding()
            self._libraries[self.path, pattern] = library
        library = self._libraries[self.path, pattern]
        return [np.array(e.ids, np.int32) for e in library.encode_batch(texts, add_special_tokens=False)]

    def encode(self, pieces: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, row starts with the end added)."""
        coded = pieces.flatten().dictionary_encode()
        different = coded.dictionary
        held = pc.index_in(different, value_set=self.known)
        unseen = held.is_null().to_numpy(zero_copy_only=False)
        fresh = different.filter(pa.array(unseen))
        got = self.encode_pieces(fresh.to_pylist())
        at = held.fill_null(0).to_numpy().astype(np.int64)
        at[unseen] = len(self.known) + np.arange(len(got))
        every = pa.concat_arrays([self.known_ids, pa.array(got, pa.large_binary())])
        mine = every.take(pa.array(at))
        laid = mine.take(coded.indices)
        if len(self.known) + len(got) > REMEMBERED_PIECES:
            self.known, self.known_ids = different.cast(pa.string()), mine
        else:
            self.known, self.known_ids = pa.concat_arrays([self.known, fresh.cast(pa.string())]), every
        ends = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1, 8 * laid.offset) // 4
        ids = np.frombuffer(laid.buffers()[2], np.int32, int(ends[-1])) if ends[-1] else np.zeros(0, np.int32)
        rows = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        return ids, ends[rows]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The bytes of each row's ids; a character may be split between tokens."""
        parts = pc.take(self.tokens, pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), parts), b"")

    def spans(self, raw: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Character offsets of the tokens; tokens that share a split character overlap in it."""
        lead = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # characters begun up to each byte
        end = np.cumsum(self.token_bytes[ids])
        start = end - self.token_bytes[ids]
        return lead[start] - 1, lead[end - 1]


def pieces_of(text: Column, pattern: str) -> list[Column]:
    """``pieces`` (matches in Java's engine) and ``odd``: the text where it holds characters that
    this JVM's Unicode tables do not know, for which the task's newer tables decide."""
    odd = (F.octet_length(text) != F.length(text)) & text.rlike(r"\p{Cn}")  # no ASCII character is unknown
    pieces = F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return [F.when(odd, none).otherwise(pieces).alias("pieces"), F.when(odd, text).alias("odd")]


def resolved(batch: pa.RecordBatch, pattern: str) -> pa.ListArray:
    pieces, odd = batch.column("pieces"), batch.column("odd")
    if odd.null_count == len(odd):
        return pieces
    import regex

    rows = pieces.to_pylist()
    for i, text in enumerate(odd.to_pylist()):
        if text is not None:
            rows[i] = regex.findall(pattern, text)
    return pa.array(rows, pieces.type)


def encode(df: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           offsets: bool = False, decoded: bool = False) -> DataFrame:
    """One row per row of ``df``: the id, ``ids`` array<int> and, on request, ``starts`` and ``ends``
    (character offsets of each token) and ``decoded`` (the bytes that the ids stand for, as by
    ``decode``, made in the same task).

    ``tokenizer`` is a rank file (base64 token and rank a line) or the library's JSON file; every
    match of ``pattern`` is encoded on its own and special tokens are ordinary text. A null text
    counts as empty: no ids. Whole texts of any length; other columns of ``df`` are not read. Repeated
    rows give a row each, an empty table none. A text of one endless match costs that match's memory in one task, as it is one row.
    """
    prepared(df.sparkSession)
    text = text_or_empty(text_col)
    extra = [text.alias("text")] if offsets else []
    rows = df.select(F.col(id_col).alias("id"), *pieces_of(text, pattern), *extra)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceEncoder.of(tokenizer)
        for batch in slices(batches):
            ids, at = coder.encode(resolved(batch, pattern))
            lists = [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))]
            if offsets:
                both = [coder.spans(t.encode(), ids[a:b]) if b > a else ((), ())
                        for t, a, b in zip(batch.column("text").to_pylist(), at, at[1:])]
                lists += [pa.array([list(map(int, x[k])) for x in both], pa.list_(pa.int32())) for k in (0, 1)]
            if decoded:
                lists.append(coder.decode(ids, at))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *lists], names)

    schema = f"id {id_type}, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "") \
        + (", decoded binary" if decoded else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The id, the ids and ``decoded``, the bytes they stand for: whole characters again where a
    character was split between tokens (``decoded_text`` shows bytes that are no UTF-8, as at a cut
    end, as U+FFFD). Null ids count as none; an id outside the vocabulary is an error."""
    prepared(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceEncoder.of(tokenizer)
        for batch in slices(batches):
            ids = batch.column("ids")
            at = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            raw = coder.decode(ids.flatten().to_numpy(zero_copy_only=False), at)
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids, raw], ["id", "ids", "decoded"])

    out = rows.mapInArrow(run, f"id {id_type}, ids array<int>, decoded binary").withColumnRenamed("id", id_col)
    return out.withColumnRenamed("ids", ids_col)


def decoded_text(raw: bytes) -> str:
    return raw.decode("utf-8", errors="replace")
