"""Token ids in ORC files: integer run-length encoded stripes, row indexes, Bloom filters on document ids.

``write_tokens`` sorts documents by id over files, encodes them and writes one row
(doc_id, n_tokens, ids) per document.  ``read_tokens`` reads whole files stripe by stripe in
parallel, or only the stripes and row groups that can hold given ids.

A null text is an empty one: its row holds the end id only.  Repeated rows are written each,
rows of one id side by side; rows without an id come first.  An empty table gives files
without rows.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage, work_folder
from .common import in_batches, kept_by_worker, partitions, ship, slices, spread, texts

ship(__name__)

END = 0
#: Bytes of encoded chunks that a worker remembers, in two generations, and what an entry takes beside its text.
REMEMBERED, ENTRY = 192 << 20, 150
#: Bytes of text that are encoded at once: the larger, the fewer different chunks are looked up again.
PIECE = 4 << 20
#: Chunks that the library gets as one string.
JOINED = 1000
ORC = {
    "orc.compress": "ZSTD",
    "orc.compression.zstd.level": "1",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
ROW = "doc_id long, n_tokens long, ids array<int>"


class Memory:
    """Ids of chunks by word; arrays grow by doubling."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.taken = self.used = self.held = 0
        self.starts, self.lengths, self.ids = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.int32)

    def room(self, ids: np.ndarray) -> int:
        """Put ids behind those in use, without keeping them; the place of the first."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.used + len(ids), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        return self.used

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        a, b = self.held, self.held + len(words)
        if b > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros(b, np.int64)]) for x in (self.starts, self.lengths))
        self.starts[a:b] = self.room(ids) + np.cumsum(lengths) - lengths
        self.lengths[a:b] = lengths
        self.used += len(ids)
        self.held = b
        self.known.update(zip(words, range(a, b), strict=True))
        self.taken += sum(map(len, words)) + ENTRY * len(words) + 4 * len(ids)

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return self.ids[spread(self.starts[place], self.lengths[place])], self.lengths[place]


class Encoder:
    """The tokenizer with a memory of chunks.

    A byte-level tokenizer never joins a space with what stands before it, so a text falls into its first word and chunks
    that each are a space and a word that begins with no white space; equal chunks have equal ids.  New chunks are
    encoded many in one string; how many bytes each id stands for tells where a chunk ends.
    Other texts (several spaces in a row, an added token such as ``<|endoftext|>``), and all texts of a tokenizer of
    another kind, are encoded whole.

    The memory has two generations: chunks that are met again move to the younger one, and the older one goes when the younger
    one is full, so that frequent chunks stay.
    """

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # every chunk is encoded once, so that the library's own memory of words would only cost time
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        # a piece is written with one character for each byte, an added token as it is
        sizes = {i: len(t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()} | {i: len(t.content.encode()) for i, t in added.items()}
        self.bytes_of = np.zeros(max(sizes, default=0) + 1, np.int64)
        self.bytes_of[list(sizes)] = list(sizes.values())
        split = json.loads(self.tokenizer.to_str())
        first = split["pre_tokenizer"] or {}
        self.by_chunk = split["normalizer"] is None and first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
        self.memory, self.older = Memory(), Memory()

    def whole(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings, one after the other, and the number of each."""
        encoded = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
        ids = [np.array(e.ids, np.int32) for e in encoded]
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))

    def chunk_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each word."""
        chunks = [" " + w for w in words]
        ids, _ = self.whole(["".join(chunks[a : a + JOINED]) for a in range(0, len(chunks), JOINED)])
        ends = np.cumsum(self.bytes_of[ids])
        wanted = np.cumsum(np.fromiter((len(c.encode("utf-8", "replace")) for c in chunks), np.int64, len(chunks)))
        at = np.searchsorted(ends, wanted)
        if len(ends) != (at[-1] + 1 if len(at) else 0) or not np.array_equal(ends[at], wanted):
            return self.whole(chunks)
        return ids, np.diff(at + 1, prepend=0)

    def places(self, words: list[str]) -> np.ndarray:
        """Places of the words in the memory; -1 for those that begin no chunk."""
        if self.memory.taken > REMEMBERED // 2:
            self.memory, self.older = Memory(), self.memory
        known, older = self.memory.known, self.older.known
        if new := [w for w in words if w not in known]:
            again = [w for w in new if older.get(w, -1) >= 0]
            self.memory.add(again, *self.older.ids_of(again))
            fresh = [w for w in new if w not in older and w and not w[0].isspace()]
            self.memory.add(fresh, *self.chunk_ids(fresh))
            known.update((w, -1) for w in new if not w or w[0].isspace())
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by the end id, and the number of ids of each text."""
        n = len(column)
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        parts = pc.split_pattern(column, " ")
        offsets, coded = parts.offsets.to_numpy().astype(np.int64), parts.values.dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = self.places(words)[codes] if self.by_chunk else np.zeros(len(codes), np.int64)
        first, doc = offsets[:-1], np.repeat(np.arange(n), np.diff(offsets))
        place[first] = 0
        odd = np.zeros(n, bool) if self.by_chunk else np.ones(n, bool)
        odd[doc[place < 0]] = True
        for token in self.added:
            odd |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        # a text is its first word (an odd one all of it), its chunks and the end
        head = [words[c] for c in codes[first]]
        for k in np.flatnonzero(odd):
            head[k] = column[k].as_py()
        extra, sizes = self.whole(head)
        memory = self.memory
        base = memory.room(np.append(extra, np.int32(END)))
        starts, lengths = np.full(len(codes) + n, base + len(extra)), np.ones(len(codes) + n, np.int64)
        own = np.arange(len(codes)) + doc
        starts[own], lengths[own] = memory.starts[place], np.where(odd[doc], 0, memory.lengths[place])
        starts[own[first]], lengths[own[first]] = base + np.cumsum(sizes) - sizes, sizes
        counts = np.add.reduceat(lengths, own[first])
        return memory.ids[spread(starts, lengths)], counts


def write_tokens(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Encode every whole text and write the files, doc_id ascending within and between them."""
    spark = docs.sparkSession
    placed = texts(docs).repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id")

    def encode(batches):
        encoder = kept_by_worker(("tokens", tokenizer), lambda: Encoder(tokenizer))
        for piece in slices(batches, most=PIECE):
            ids, counts = encoder.encode(piece.column("text"))
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(ends, pa.array(ids))], names=["doc_id", "n_tokens", "ids"])

    in_batches(placed, encode, ROW).write.options(**ORC).mode("overwrite").orc(folder)


def read_tokens(spark: SparkSession, folder: str, ids: list[int] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids; with ``ids`` the filter reaches the file, stripe and row-group statistics and Bloom filters."""
    rows = spark.read.schema(ROW).orc(folder)
    return rows if ids is None else rows.filter(F.col("doc_id").isin(ids))


def digests(piece: pa.RecordBatch) -> pa.RecordBatch:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    ids = piece.column("ids")
    flat, ends = ids.values.to_numpy().astype("<u4", copy=False), ids.offsets.to_numpy()
    crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return pa.RecordBatch.from_arrays([piece.column("file"), piece.column("doc_id"), piece.column("n_tokens"), pa.array(crc, pa.int64())], names=["file", "doc_id", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored row.

    ``start`` adds the tokens of earlier rows of the same file to those of earlier files; file names
    number the sorted ranges.  Only the totals of the files (one row each) are summed in one place.
    """
    name = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("int")

    def run(batches):
        for batch in batches:
            yield digests(batch)

    rows = read_tokens(spark, folder).select(name.alias("file"), "doc_id", "n_tokens", "ids")
    rows = in_batches(rows, run, "file int, doc_id long, n_tokens long, ids_crc32 long")
    rows = stage(rows)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    bases = files.select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("base"))
    within = Window.partitionBy("file").orderBy("doc_id", "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, 0)
    runs = rows.withColumn("before", F.sum("n_tokens").over(within) - F.col("n_tokens"))
    return runs.join(bases, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the ids of all documents, read the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = folder or f"{work_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, folder, tokenizer)
    return token_index(spark, folder)
