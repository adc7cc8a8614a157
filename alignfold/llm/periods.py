"""Runs: stretches of words that repeat with a period, found on sparse diagonals of the self-match table.

Cell (i, q) of the table says that word i equals word i - q; a diagonal of cells is a match length that
each word raises by one, and a run of period q is a diagonal of at least two periods. Words are taken in
order and only few cells of a word are active. A cell is entered with the block of K words that ends at
the word, K the power of two with K/2 < q <= K, and the only active lag of that block is the one to its
nearest earlier occurrence. This leaves no run out: where K words and the same K words q before lie in a
stretch of smallest period q <= K, an occurrence at a lag d < q would give the stretch the period
gcd(d, q) (Fine and Wilf). For the same reason a diagonal found this way is as long as the run allows,
and its lag is the smallest period. Blocks of 2K words are pairs of blocks that occur twice, so ordinary
text is through after a few short levels, and a word repeated a million times has one cell a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from alignfold.llm.common import prepared, slices, text_or_empty

MIN_WORDS, MIN_PERIODS = 24, 3
RUNS = "array<struct<start: long, length: long, period: long>>"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts one after the other, place of each text's first word and the end)."""
    split = pc.ascii_split_whitespace(texts)
    words, cuts = split.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # ends of texts that begin or end with a space
    return words.filter(pa.array(real)), np.concatenate([[0], np.cumsum(real)])[cuts]


def nearest_earlier(block: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For blocks at ascending places: (place of the same block before or -1, whether it occurs twice, its number)."""
    order = np.argsort(block, kind="stable")
    same = block[order[1:]] == block[order[:-1]]
    before = np.full(len(at), -1, np.int64)
    before[order[1:][same]] = at[order[:-1][same]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    number = np.empty(len(at), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(~same)]) if len(at) else 0
    return before, twice, number


def ended_diagonals(at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of words, lag) of each diagonal: it goes on while the next word has the same lag."""
    if not len(at):
        return at, at, lag
    begins = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(lag) != 0)])
    first = np.flatnonzero(begins)
    return at[first], np.diff(np.concatenate([first, [len(at)]])), lag[first]


def find_runs(ids: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS,
              min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of every run in texts of word numbers, by text, start and period.

    Text k has the words ``ids[first[k]:first[k + 1]]``. Memory is a few numbers for each word;
    ``min_periods`` is 3 or more.
    """
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(ids)) - first[text]
    at = np.flatnonzero(size[text] >= max(min_words, min_periods))
    block = text[at] * (int(ids.max(initial=0)) + 1) + ids[at]
    held, found, k = np.full(len(ids), -1, np.int64), [], 1
    while len(at):
        before, twice, number = nearest_earlier(block, at)
        lag = at - before
        active = (before >= 0) & (lag > k // 2) & (lag <= k)
        begin, cells, period = ended_diagonals(at[active], lag[active])
        length = cells + k - 1 + period
        whole = length >= np.maximum(min_words, min_periods * period)
        begin, length, period = begin[whole], length[whole], period[whole]
        found.append((text[begin], place[begin] - k + 1 - period, length, period))
        held[at] = np.where(twice, number, -1)
        more = at[twice & (place[at] >= 2 * k - 1) & (size[text[at]] >= min_periods * (k + 1))]
        more = more[held[more - k] >= 0]
        block = held[more - k] * len(ids) + held[more]
        held[at] = -1
        at, k = more, 2 * k
    out = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
    order = np.lexsort((out[3], out[1], out[0]))
    return tuple(x[order] for x in out)


def copies(first: np.ndarray, runs: tuple) -> np.ndarray:
    """Which words stand in a run after its first period."""
    text, start, length, period = runs
    step = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(step, first[text] + start + period, 1)
    np.add.at(step, first[text] + start + length, -1)
    return np.cumsum(step[:-1]) > 0


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  edit: Callable[[pa.Array, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Id, ``n_words``, ``runs`` (start, length and period in words, by start and period) and ``collapsed`` (the
    words joined by one space without those that a run repeats) of every whole text.

    ``edit`` may put words in place of others before the search: from the ids and the places of the
    texts' first words it gives for each word the place of the word that stands there. A null text
    has no words; null and repeated ids and repeated rows are kept, one row each, in no order; an
    empty table gives an empty result. Other columns are not read. A batch's words are held as
    Arrow arrays, so a long text takes a few times its size.
    """
    prepared(df.sparkSession)
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, first = split_words(batch.column(1))
            ids = words.dictionary_encode()
            if edit is not None:
                ids = ids.take(pa.array(edit(batch.column(0), first)))
            runs = find_runs(ids.indices.to_numpy().astype(np.int64), first)
            kept = ~copies(first, runs)
            cuts = np.concatenate([[0], np.cumsum(kept)])[first]
            left = ids.filter(pa.array(kept)).dictionary_decode()
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), left), " ")
            of = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in runs[1:]], ["start", "length", "period"])
            ends = np.searchsorted(runs[0], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), of),
                 collapsed], ["id", "n_words", "runs", "collapsed"])

    found = df.select(df[id_col], text_or_empty(text_col)).mapInArrow(
        run, f"id {id_type}, n_words long, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("id", id_col)
