"""Exact duplicates through an extendible-hash index on shared files.

1. Every row gets the 64-bit hash of its normalised text as key; the keys are stored.
2. A directory of 2^depth slots sends key prefixes to buckets.  Buckets with more than
   ``capacity`` different keys split, which doubles the directory until none is overfull.
3. Map tasks fold equal texts of a batch into one entry.  Owner tasks, each with a
   contiguous range of slots, read their entries by (bucket, key), chain entries whose
   keys collide and compare bytes.  The bucket files go to the shared folder.
4. Rows find their chain by key and digest.

Texts are equal when identical after every run of [\\x20\\x09-\\x0D] becomes one space; a
null is an empty text.  Of equal texts the smallest doc_id stays; rows without an id never
displace others.  Repeated rows with one doc_id and text are one document: all of them
carry the same result.  An empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import in_batches, partitions, ship, slices, small_or_joined, texts

ship(__name__)

#: Different keys that a bucket of the index holds before it splits.
CAPACITY = 50_000
#: A directory of at most this depth (12 bytes a slot) is sent to all tasks, a larger one is joined.
BROADCAST_DEPTH = 18
DEEPEST = 40

ENTRY = "slot long, bucket string, key long, keep_id long, group_size long, text string"
RECORD = "bucket string, key long, chain int, keep_id long, group_size long, text_sha256 string"


def normalised(text):
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def slot_of(key, depth: int):
    """The first ``depth`` bits of the key as a number."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Slots of the final directory with their bucket and its local depth; and the global depth.

    ``keys`` (column key) is read once for each doubling; only buckets that are overfull go on.
    """
    spark = keys.sparkSession
    keys = keys.select("key").distinct()
    count = keys.count()
    depth = max(0, (max(1, count) // capacity).bit_length() - 1)
    leaves, pending = None, keys
    while True:
        sizes = pending.groupBy(slot_of(F.col("key"), depth).alias("prefix")).agg(F.count("*").alias("n"))
        sizes = stage(sizes)
        overfull = (F.col("n") > capacity) & F.lit(depth < DEEPEST)
        full = sizes.filter(overfull)
        done = sizes.filter(~overfull).select("prefix", F.lit(depth).alias("local_depth"), "n")
        leaves = done if leaves is None else leaves.unionByName(done)
        if full.isEmpty():
            break
        pending = pending.join(full.select("prefix"), slot_of(F.col("key"), depth) == F.col("prefix"), "left_semi")
        depth += 1
    width = F.expr(f"shiftleft(1L, {depth} - local_depth)")
    slots = leaves.select(
        F.explode(F.sequence(F.col("prefix") * width, F.col("prefix") * width + width - 1)).alias("slot"),
        F.concat_ws("/", F.col("local_depth").cast("string"), F.col("prefix").cast("string")).alias("bucket"),
    )
    return stage(slots), depth


def fold(batches):
    """Map side: equal texts of a slice become one entry with the smallest id and the number of rows."""
    for piece in slices(batches):
        rows = pa.Table.from_batches([piece])
        got = rows.group_by(["slot", "bucket", "key", "text"]).aggregate([("doc_id", "min"), ("n", "sum")])
        got = got.select(["slot", "bucket", "key", "doc_id_min", "n_sum", "text"]).rename_columns(["slot", "bucket", "key", "keep_id", "group_size", "text"])
        yield from got.combine_chunks().to_batches()


def own(batches):
    """Owner side: entries sorted by (bucket, key); those of one key form a chain whose texts are compared byte by byte."""
    import hashlib

    current, chain, out = None, [], []

    def flush():
        return [(*current, i, keep, n, hashlib.sha256(text).hexdigest()) for i, (text, keep, n) in enumerate(chain)]

    def batch(rows):
        names = ["bucket", "key", "chain", "keep_id", "group_size", "text_sha256"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    for piece in batches:
        bucket, key, keep, n = (piece.column(c).to_pylist() for c in ("bucket", "key", "keep_id", "group_size"))
        text = piece.column("text").cast(pa.binary())
        for i in range(piece.num_rows):
            if (bucket[i], key[i]) != current:
                out += flush() if current else []
                current, chain = (bucket[i], key[i]), []
            body = text[i].as_py()
            for k, (other, least, size) in enumerate(chain):
                if other == body:
                    ids = [x for x in (least, keep[i]) if x is not None]
                    chain[k] = (other, min(ids, default=None), size + n[i])
                    break
            else:
                chain.append((body, keep[i], n[i]))
        if len(out) > 5000:
            yield batch(out)
            out = []
    out += flush() if current else []
    yield batch(out)


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The stored bucket files: bucket, key, chain, keep_id, group_size, text_sha256."""
    slots, depth = directory(keys, capacity)
    spark = docs.sparkSession
    owners = partitions(spark)
    body = texts(docs).select("doc_id", normalised(F.col("text")).alias("text"), F.lit(1).cast("long").alias("n"))
    body = body.withColumn("key", F.xxhash64("text")).withColumn("slot", slot_of(F.col("key"), depth))
    placed = body.join(F.broadcast(slots) if depth <= BROADCAST_DEPTH else slots, "slot")
    entries = in_batches(placed.select("slot", "bucket", "key", "doc_id", "n", "text"), fold, ENTRY)
    owner = F.floor(F.col("slot") * owners / F.lit(2.0**depth)).cast("int")
    owned = entries.repartitionById(owners, owner).sortWithinPartitions("bucket", "key")
    return stage(in_batches(owned.select("bucket", "key", "keep_id", "group_size", "text"), own, RECORD))


def exact_groups(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row."""
    body = texts(docs).select("doc_id", normalised(F.col("text")).alias("text"))
    keys = stage(body.select("doc_id", F.xxhash64("text").alias("key"), F.sha2("text", 256).alias("text_sha256")))
    index = build_index(docs, keys, capacity)
    found = keys.join(index.select("key", "text_sha256", "keep_id", "group_size"), ["key", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``.

    Rows are told apart by id and text, so a text whose id also belongs to another text is not lost; of rows
    that agree in both, one stays, whichever it is.
    """
    groups = stage(exact_groups(docs, capacity).groupBy(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).agg(F.first("kept").alias("kept"), F.count("*").alias("rows")))
    gone = small_or_joined(groups.filter(~F.col("kept")).select("__id", "__sha"))
    text = F.sha2(normalised(F.coalesce(docs["text"], F.lit(""))), 256)

    def same(other: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(other["__id"]) & (text == other["__sha"])

    again = groups.filter(F.col("kept") & (F.col("rows") > 1)).select("__id", "__sha")
    if again.isEmpty():
        return docs.join(gone, same(gone), "left_anti")
    again = small_or_joined(again)
    once = docs.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"])
    return docs.join(gone, same(gone), "left_anti").join(again, same(again), "left_anti").unionByName(once)
