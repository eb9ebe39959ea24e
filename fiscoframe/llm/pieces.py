"""SentencePiece byte-pair encoding and decoding in vectorised merge rounds.

A text becomes one sequence of symbols: a leading mark, then its code points, with spaces as
marks.  No piece of the vocabulary continues over a mark that follows another symbol, and
none holds a code point outside its multi-symbol pieces together with others, so the text
falls into words whose merges do not touch.  Each round takes the smallest pair rank of
every word and merges all its occurrences from the left at once; where a merge would open a pair of
the same or a smaller rank, only the leftmost is merged, which keeps the sequential order.  Symbols
are compacted after every round until no word has a pair.

A null text is an empty one and has no ids.  Repeated rows are encoded each.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_words, in_batches, kept_by_worker, ship, slices, spread, texts

ship(__name__)

MARK = "▁"
#: Words that a task remembers before it starts its table anew.
REMEMBERED = 150_000
#: Bytes of text that are encoded together: words, symbols and ids of a slice weigh up to a hundred times as much.
SLICE_BYTES = 250_000
NONE = np.iinfo(np.int64).max


def proto_fields(data: bytes):
    """(field number, value) of a serialised message; nested messages stay bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


class Vocabulary:
    """Pieces, scores and the tables that merging and decoding use."""

    NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        pieces = []
        for number, value in proto_fields(data):
            if number == 1:
                got = dict(proto_fields(value))
                pieces.append((got[1].decode(), float(np.frombuffer(got[2], "<f4")[0]), got.get(3, self.NORMAL)))
            elif number == 3:
                spec = dict(proto_fields(value))
                if spec.get(2) or spec.get(4, 1) or not spec.get(3, 1) or not spec.get(5, 1):
                    raise ValueError("only identity normalisation with a leading mark is supported")
        self.pieces = [p for p, _, _ in pieces]
        self.kind = np.array([k for _, _, k in pieces])
        self.unknown = int(np.flatnonzero(self.kind == self.UNKNOWN)[0])
        self.id_of = {p: i for i, (p, _, k) in enumerate(pieces) if k == self.NORMAL}
        self.byte_ids = np.zeros(256, np.int64)
        for i, (p, _, k) in enumerate(pieces):
            if k == self.BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        # symbols: ids of the vocabulary, then one number for each other code point
        self.size = len(pieces)
        _, self.rank = np.unique(-np.array([s for _, s, _ in pieces]), return_inverse=True)
        keys, ranks, made = [], [], []
        for piece, i in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    keys.append(self.pair(a, b))
                    ranks.append(int(self.rank[i]))
                    made.append(i)
        order = np.argsort(keys)
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_rank = np.array(ranks, np.int64)[order]
        self.pair_made = np.array(made, np.int64)[order]
        joining = sorted({c for p in self.id_of if len(p) > 1 for c in p} - {MARK})
        inside = "".join(re.escape(c) for c in joining)
        self.words = re.compile(f"{MARK}+[{inside}]*|[{inside}]+|[^{inside}{MARK}]")
        self.crosses = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id_of)
        surface = [self.surface(i) for i in range(self.size)]
        self.surface_bytes, self.surface_start, self.surface_length = packed(surface)
        self.digit_bytes, self.digit_start, self.digit_length = packed([f"{i},".encode() for i in range(self.size)])

    def symbol(self, piece: str) -> int | None:
        if piece in self.id_of:
            return self.id_of[piece]
        return self.size + ord(piece) if len(piece) == 1 else None

    @staticmethod
    def pair(a, b):
        return a * (1 << 22) + b

    def surface(self, i: int) -> bytes:
        if self.kind[i] == self.BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kind[i] == self.CONTROL:
            return b""
        if self.kind[i] == self.UNKNOWN:
            return " ⁇ ".encode()
        return self.pieces[i].replace(MARK, " ").encode()

    def split(self, text: str) -> list[str]:
        """Words of a text; plain splitting where no two marks meet."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if self.crosses:
            return [marked]
        if MARK + MARK in marked or marked[-1] == MARK:
            return self.words.findall(marked)
        return [MARK + w for w in marked.split(MARK)[1:]]


def packed(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, items), np.int64, len(items))
    return np.frombuffer(b"".join(items), np.uint8), np.cumsum(lengths) - lengths, lengths


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pair_ranks(v: Vocabulary, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of (symbol, next symbol) and the symbol it makes; no rank at the end of a word."""
    rank = np.full(len(symbols), NONE)
    made = np.zeros(len(symbols), np.int64)
    inner = np.flatnonzero(word[:-1] == word[1:])
    key = v.pair(symbols[inner], symbols[inner + 1])
    at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
    hit = v.pair_keys[at] == key
    rank[inner[hit]] = v.pair_rank[at[hit]]
    made[inner[hit]] = v.pair_made[at[hit]]
    return rank, made


def starts_of(word: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(word, prepend=-1))


def leftmost_runs(chosen: np.ndarray) -> np.ndarray:
    """Of neighbouring chosen pairs, which overlap, every second from the left of the run."""
    at = np.flatnonzero(chosen)
    if not len(at):
        return at
    run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, at, 0))
    return at[(at - run) % 2 == 0]


def merge_words(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one word after the other, and the number of ids of each word."""
    n = len(words)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(n), np.fromiter(map(len, words), np.int64, n))
    seen, back = np.unique(points, return_inverse=True)
    symbols = np.array([v.symbol(chr(p)) for p in seen], np.int64)[back] if len(seen) else points
    done_symbols, done_word = [], []
    while len(symbols):
        rank, made = pair_ranks(v, symbols, word)
        begin = starts_of(word)
        least = np.minimum.reduceat(rank, begin)
        lengths = np.diff(begin, append=len(word))
        still = np.repeat(least != NONE, lengths)
        if not still.all():
            done_symbols.append(symbols[~still])
            done_word.append(word[~still])
            symbols, word, rank, made = symbols[still], word[still], rank[still], made[still]
            if not len(symbols):
                break
            keep = least != NONE
            lengths, least = lengths[keep], least[keep]
            begin = np.cumsum(lengths) - lengths
        chosen = leftmost_runs(rank == np.repeat(least, lengths))
        merged, left = symbols.copy(), np.ones(len(symbols), bool)
        merged[chosen] = made[chosen]
        left[chosen + 1] = False
        new_symbols, new_word = merged[left], word[left]
        # words in which the merges open a pair that comes before or with this rank go one at a time
        opened, _ = pair_ranks(v, new_symbols, new_word)
        fresh = np.zeros(len(symbols), bool)
        fresh[chosen] = True
        fresh = fresh[left]
        touches = fresh | np.append(fresh[1:], False)
        order = np.cumsum(np.diff(word, prepend=-1) != 0) - 1
        limit = least[order[left]]
        early = np.unique(new_word[touches & (opened <= limit)])
        if len(early):
            late = np.isin(word[chosen], early)
            _, first = np.unique(word[chosen][late], return_index=True)
            chosen = np.sort(np.concatenate([chosen[~late], chosen[late][first]]))
            merged, left = symbols.copy(), np.ones(len(symbols), bool)
            merged[chosen] = made[chosen]
            left[chosen + 1] = False
            new_symbols, new_word = merged[left], word[left]
        symbols, word = new_symbols, new_word
    if not done_symbols:
        return np.zeros(0, np.int64), np.zeros(n, np.int64)
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    symbols, word = symbols[order], word[order]
    # code points without a piece become their UTF-8 bytes
    foreign = symbols >= v.size
    if foreign.any():
        encoded = {p: v.byte_ids[list(chr(p - v.size).encode("utf-8", "replace"))] for p in np.unique(symbols[foreign])}
        sizes = np.ones(len(symbols), np.int64)
        sizes[foreign] = [len(encoded[p]) for p in symbols[foreign]]
        out = np.repeat(symbols, sizes)
        out[np.repeat(foreign, sizes)] = np.concatenate([encoded[p] for p in symbols[foreign]])
        symbols, word = out, np.repeat(word, sizes)
    return symbols, np.bincount(word, minlength=n)


class Encoder:
    """Encodes batches of texts; remembers the words of a task."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = self.lengths = self.ids = np.zeros(0, np.int64)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of ids of each text."""
        codes, distinct, offsets = flat_words([self.v.split(t) for t in batch])
        if len(self.known) + len(distinct) > REMEMBERED:
            self.forget()
        if new := [w for w in distinct if w not in self.known]:
            # a plainly split word may hold code points that stand alone; its parts do not touch
            ids, lengths = merge_words(self.v, new)
            base = len(self.known)
            self.known.update((w, base + i) for i, w in enumerate(new))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
        place = np.fromiter((self.known[w] for w in distinct), np.int64, len(distinct))[codes]
        lengths = self.lengths[place]
        total = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        return self.ids[spread(self.starts[place], lengths)], np.diff(total)


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The byte strings of ids joined per text."""
    sizes = length[ids]
    flat = data[spread(start[ids], sizes)].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def decode(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of runs of ids: surfaces joined, the leading mark dropped, runs of byte pieces read as UTF-8.

    An invalid byte becomes U+FFFD.
    """
    first = np.cumsum(counts) - counts
    lead = np.zeros(len(ids), bool)
    lead[first[counts > 0]] = True
    marked = lead & np.array([p.startswith(MARK) for p in v.pieces])[ids] if len(ids) else lead
    texts = gather(v.surface_bytes, v.surface_start, v.surface_length, ids, counts)
    drop = np.zeros(len(counts), bool)
    drop[counts > 0] = marked[first[counts > 0]]
    return [replaced(t[1:] if d else t) for t, d in zip(texts, drop, strict=True)]


def replaced(data: bytes) -> str:
    """UTF-8 text; each byte that begins no character becomes one U+FFFD."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            try:
                out.append(data[at:].decode())
                break
            except UnicodeDecodeError as e:
                out += [data[at : at + e.start].decode(), "�"]
                at += e.start + 1
        return "".join(out)


def digit_texts(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Decimal ids joined by commas."""
    return [x[:-1] for x in gather(v.digit_bytes, v.digit_start, v.digit_length, ids, counts)]


def encoded(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every whole text."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def run(batches):
        encoder = kept_by_worker(("pieces", model), lambda: Encoder(model))
        for piece in slices(batches, most=SLICE_BYTES):
            ids, counts = encoder.encode(piece.column("text").to_pylist())
            columns = {
                "doc_id": piece.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in digit_texts(encoder.v, ids, counts)], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decode(encoder.v, ids, counts)], pa.string()),
            }
            if with_ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    return in_batches(texts(docs), run, schema)
