"""Periodic runs of words: an online diagonal DP over sparse active lags.

A run is a stretch of words with smallest period q (words q apart are identical), at least
``max(SHORTEST, REPEATS * q)`` words long, that no neighbouring word extends.  On the diagonal of lag q it is a
row of consecutive matches between a word and the one q before it.  Trying all earlier occurrences of
a word would be quadratic in frequent words, so a lag is active at a word only while the gram of L words that
begins there has its nearest earlier occurrence exactly q before, 2q <= L <= 3q.  That loses nothing: a gram
of two periods has no nearer occurrence (two periods would then divide into a smaller one), and a run of four periods
holds such a gram.  It also leaves out lags that are multiples of the period.  Each further word with the same
lag increments the diagonal's length; a diagonal that ends long enough emits its run at once.

Grams grow along a ladder of lengths, 1.5 times each; equal grams get equal codes by joining the codes of two
overlapping shorter ones, so comparisons are exact.  A gram that occurs once is left out of all longer
ones.  A text of n words costs O(n log n) time at worst and O(n) memory.

Words are runs of other characters than [\\x20\\x09-\\x0D].  Null and empty texts have no words and no runs, and collapse to
an empty text.  Repeated rows are treated each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_slices, ship, texts

ship(__name__)

REPEATS, SHORTEST = 4, 6
RESULT = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words in order, the distinct words, and the offsets of the texts (one more than texts)."""
    parts = pc.ascii_split_whitespace(column)
    words, ends = parts.values, parts.offsets.to_numpy()
    present = pc.greater(pc.binary_length(words), 0)
    held = present.to_numpy(zero_copy_only=False)
    encoded = words.filter(present).dictionary_encode()
    distinct = np.empty(len(encoded.dictionary), dtype=object)
    distinct[:] = encoded.dictionary.to_pylist()
    return encoded.indices.to_numpy().astype(np.int64), distinct, np.concatenate([[0], np.cumsum(held)])[ends].astype(np.int64)


def ladder() -> Iterator[tuple[int, int]]:
    """Gram lengths and the length before: a lag q belongs to the first length of at least 2q, which is at most 3q."""
    before, length = 1, 2
    while True:
        yield length, before
        before, length = length, max(4, length * 3 // 2)


def nearest(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose key occurs more than once, a code of the key, and the distance to its last occurrence before (0: none)."""
    size = int(at[-1]) + 1
    if int(key.max()) < (1 << 62) // size:
        both = np.sort(key * size + at)
        key, at = both // size, both % size
    else:
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    lag = np.where(same, np.diff(at, prepend=0), 0)
    code = np.cumsum(~same) - 1
    often = same | np.append(same[1:], False)
    return at[often], code[often], lag[often]


def diagonals(at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last position and lag of every row of consecutive positions with one active lag."""
    order = np.argsort(at)
    at, lag = at[order], lag[order]
    opens = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(lag) != 0)])
    closes = np.append(opens[1:], True)
    return at[opens], at[closes], lag[opens]


def runs_of(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in ``codes``), length and period of all runs of all texts, by start, then period."""
    found = [np.zeros((3, 0), np.int64)]
    n = len(codes)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    gram, size = np.full(n, -1, np.int64), 0
    if n > 1:
        width = int(codes.max()) + 1
        at = np.flatnonzero(doc[1:] == doc[:-1])
        key = (doc[at] * width + codes[at]) * width + codes[at + 1]
    for length, before in ladder():
        if length > 2:
            # a gram of this length is two overlapping grams of the length before, both of which recur
            step = length - before
            at = np.sort(at[at + step < n])
            at = at[gram[at + step] >= 0]
            key = gram[at] * (size + 1) + gram[at + step]
        if n < 2 or not len(at):
            break
        at, code, lag = nearest(key, at)
        gram.fill(-1)
        gram[at] = code
        size = int(code.max(initial=0)) + 1
        active = (2 * lag <= length) & (2 * lag > before)
        if active.any():
            first, last, period = diagonals(at[active], lag[active])
            total = last - first + length + period
            enough = total >= np.maximum(SHORTEST, REPEATS * period)
            found.append(np.stack([first - period, total, period])[:, enough])
    start, total, period = np.concatenate(found, axis=1)
    order = np.lexsort([period, start])
    return start[order], total[order], period[order]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:n] == 0


def scan(piece: pa.RecordBatch) -> pa.RecordBatch:
    codes, distinct, offsets = word_codes(piece.column("text"))
    start, length, period = runs_of(codes, offsets)
    owner = np.searchsorted(offsets, start, side="right") - 1
    ends = np.searchsorted(owner, np.arange(len(offsets))).astype(np.int32)
    parts = [pa.array(x) for x in (start - offsets[owner], length, period)]
    runs = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, names=["start", "length", "period"]))
    keep = kept_words(len(codes), start, length, period)
    words = distinct[codes[keep]].tolist()
    edges = np.concatenate([[0], np.cumsum(keep)])[offsets].tolist()
    collapsed = [" ".join(words[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([piece.column("doc_id"), runs, pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (by start, then period; starts are word numbers) and the text without the repetitions."""
    return map_slices(texts(docs), scan, RESULT)
