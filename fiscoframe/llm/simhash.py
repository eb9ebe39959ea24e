"""Document fingerprints: SimHash with permuted block tables.

The terms of a text are its pairs of neighbouring words (a single word by itself where there is only
one).  Every occurrence of a term votes with its length-damped weight on each of 128 signed bits; a bit
is set where the votes are positive.  ``likeness`` turns a Hamming distance into the cosine
that it estimates.

``within_radius`` finds all fingerprints within a Hamming radius: the bits are cut into
``blocks`` blocks and for every choice of ``blocks - radius`` of them there is one table that
brings these blocks to the front.  Two fingerprints within the radius differ in at most
``radius`` blocks, so they share the front of at least one table.

A null text is an empty one; a text without words has fingerprint 0 and likeness 1 to another
such text and 0 to any other.  Repeated rows are fingerprinted each; rows of one id, and rows
without an id (which come last), are ordered by their text.  The only row of a table is followed by itself.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_words, in_batches, mix, partitions, ship, slices, spread, table, texts, word_hashes

ship(__name__)

BITS = 128
RADIUS = 3
BLOCKS = 5


def votes(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signed sums of each document's terms: one row of 64 columns a document."""
    n = len(offsets) - 1
    out = np.zeros((n, 64), dtype=np.float32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        # whole documents at a time, so that the unpacked bits stay small
        for group in np.array_split(full, max(1, int(len(hashes) // 200_000))):
            if not len(group):
                continue
            a, b = offsets[group[0]], offsets[group[-1] + 1]
            bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            bits *= 2 * weights[a:b, None]
            out[group] = np.add.reduceat(bits, offsets[group] - a, axis=0) - np.add.reduceat(weights[a:b], offsets[group] - a)[:, None]
    return out


def terms(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and weights of the terms of every text, and the offsets of the texts."""
    codes, distinct, offsets = flat_words([t.split() for t in batch])
    base = word_hashes(distinct)
    size = np.log2(1 + np.fromiter(map(len, distinct), np.float32, len(distinct)))
    lengths = np.diff(offsets)
    counts = np.where(lengths >= 2, lengths - 1, lengths)
    first = spread(offsets[:-1], counts)
    second = np.minimum(first + 1, len(codes) - 1) if len(codes) else first
    alone = np.repeat(lengths == 1, counts)
    a, b = codes[first], codes[second]
    hashes = mix(base[a] * np.uint64(0x9E3779B97F4A7C15) + np.where(alone, np.uint64(1), base[b]))
    weights = (size[a] + np.where(alone, 0, size[b])).astype(np.float32)
    return hashes, weights, np.concatenate([[0], np.cumsum(counts)])


def fingerprints(batch: list[str]) -> np.ndarray:
    """Two 64-bit words per text."""
    hashes, weights, offsets = terms(batch)
    words = [votes(h, weights, offsets) > 0 for h in (hashes, mix(hashes + np.uint64(0x632BE59BD9B4E019)))]
    bits = np.concatenate(words, axis=1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(len(batch), 2)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1: the cosine of the angle that the share of differing bits stands for."""
    alike = np.clip(np.cos(np.pi * distance(a, b) / BITS), 0, 1)
    empty_a, empty_b = (a == 0).all(axis=1), (b == 0).all(axis=1)
    return np.where(empty_a ^ empty_b, 0.0, np.where(empty_a & empty_b, 1.0, alike))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


OUT = "doc_id long, n_chars long, edited_sha256 string, high long, low long, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(ids: list, own: list[str], following: list[str]) -> pa.RecordBatch:
    changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
    chained = own + [following[-1]]
    prints = fingerprints(chained)
    mine, after = prints[:-1], prints[1:]
    other = fingerprints(changed)
    text_of = lambda p: [f"{h:016x}{low:016x}" for h, low in p.tolist()]
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(t) for t in own], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
        "high": pa.array(mine[:, 0].view(np.int64)),
        "low": pa.array(mine[:, 1].view(np.int64)),
        "fingerprint": pa.array(text_of(mine)),
        "edited_fingerprint": pa.array(text_of(other)),
        "near_edited": pa.array(likeness(mine, other)),
        "near_next": pa.array(likeness(mine, after)),
    }
    return pa.RecordBatch.from_pydict(columns)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in ranges of descending doc_id; each range also holds the first text of the range after it.

    Ranges are cut at quantiles of the ids.  The ids are numbered by range without moving texts; only
    one text per range is read a second time.  Columns: part, carried (0 own rows, 1 the text after the last one), doc_id, text.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = texts(docs)
    # the grid of quantiles has one number per partition, whatever the table
    cuts = rows.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("q")).collect()[0]["q"]
    cuts = sorted(set(cuts or []))
    below = F.lit(0)
    if cuts:
        below = F.aggregate(F.lit(cuts).cast("array<bigint>"), F.lit(0), lambda n, c: n + (F.col("doc_id") > c).cast("int"))
    # part 0 holds the largest ids; rows without an id come after all others
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.lit(len(cuts)) - below).cast("int"))
    first = rows.groupBy("part").agg(F.max("doc_id").alias("doc_id"))
    order = {r["part"]: r["doc_id"] for r in first.collect()}  # one id per partition
    taken = sorted(order)
    before = {order[p]: taken[i - 1] for i, p in enumerate(taken)}
    edges = spark.createDataFrame([(k, v) for k, v in before.items()], "edge long, part int")
    carried = rows.drop("part").join(F.broadcast(edges), F.col("doc_id").eqNullSafe(F.col("edge")))
    least = carried.groupBy("part", "doc_id").agg(F.min("text").alias("text"))
    columns = ["part", "carried", "doc_id", "text"]
    return rows.withColumn("carried", F.lit(0)).select(columns).unionByName(least.withColumn("carried", F.lit(1)).select(columns))


def simhash(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text: the columns of ``OUT``."""
    spark = docs.sparkSession
    parts = partitions(spark)
    rows = with_next(docs)
    spread_out = rows.repartitionById(parts + 1, F.col("part"))
    ordered = spread_out.sortWithinPartitions("part", "carried", F.col("doc_id").desc_nulls_last(), "text")

    def run(batches):
        held: list[tuple] = []  # the last own row, whose next text is not known yet
        for piece in slices(batches):
            ids, own, carried = (piece.column(c).to_pylist() for c in ("doc_id", "text", "carried"))
            own_ids, own_texts, following = [], [], []
            for i, text, is_carried in zip(ids, own, carried, strict=True):
                if held:
                    own_ids.append(held[0][0])
                    own_texts.append(held[0][1])
                    following.append(text)
                held = [] if is_carried else [(i, text)]
            if own_ids:
                yield compared(own_ids, own_texts, following)

    return in_batches(ordered.select("carried", "doc_id", "text"), run, OUT)


def blocks_of(high, low, blocks: int) -> list:
    """The fingerprint cut into ``blocks`` runs of bits (as text of bits)."""
    bits = F.concat(*[F.lpad(F.bin(x), 64, "0") for x in (high, low)])
    size = -(-BITS // blocks)
    return [F.substring(bits, 1 + i * size, size) for i in range(blocks)]


def block_tables(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """One row per fingerprint and table: number, front (the blocks that the table brings to the front), high, low."""
    cut = blocks_of(F.col("high"), F.col("low"), blocks)
    fronts = [F.struct(F.lit(k).alias("number"), F.xxhash64(F.lit(k), *[cut[i] for i in chosen]).alias("front")) for k, chosen in enumerate(combinations(range(blocks), blocks - radius))]
    return prints.select("high", "low", F.explode(F.array(*fronts)).alias("t")).select("t.number", "t.front", "high", "low")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs of a distinct query fingerprint and a distinct fingerprint at most ``radius`` bits apart, once each.

    Columns high, low, other_high, other_low, apart.  Equal fingerprints are one row on either side, so
    copies make no pairs.  A pair is reported by the first table in which it meets.
    """
    left = block_tables(queries.select("high", "low").distinct(), radius, blocks)
    right = block_tables(prints.select("high", "low").distinct(), radius, blocks)
    right = right.select("number", "front", F.col("high").alias("other_high"), F.col("low").alias("other_low"))
    apart = (F.bit_count(F.col("high").bitwiseXOR(F.col("other_high"))) + F.bit_count(F.col("low").bitwiseXOR(F.col("other_low")))).cast("int")
    mine, theirs = (blocks_of(F.col(p + "high"), F.col(p + "low"), blocks) for p in ("", "other_"))
    same = F.array(*[a == b for a, b in zip(mine, theirs, strict=True)])
    meets = [F.forall(F.array(*[same[i] for i in chosen]), lambda x: x) for chosen in combinations(range(blocks), blocks - radius)]
    earliest = F.array_position(F.array(*meets), F.lit(True)).cast("int") - 1
    joined = left.hint("shuffle_merge").join(right, (left["number"] == right["number"]) & (left["front"] == right["front"]) & (apart <= radius) & (earliest == left["number"]))
    return joined.select("high", "low", "other_high", "other_low", apart.alias("apart"))


def simhash_report(docs: DataFrame, every: int = 100, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of all rows; for ids divisible by ``every`` also the number of other rows within the radius."""
    from ..session import stage

    prints = stage(simhash(docs))
    asked = prints.filter(F.col("doc_id") % every == 0)
    sizes = prints.groupBy("high", "low").agg(F.count("*").alias("rows")).select(F.col("high").alias("other_high"), F.col("low").alias("other_low"), "rows")
    found = within_radius(asked, prints, radius).join(sizes, ["other_high", "other_low"])
    totals = found.groupBy("high", "low").agg((F.sum("rows") - 1).alias("total"))
    joined = prints.join(totals, ["high", "low"], "left")
    near = F.when(F.col("doc_id") % every == 0, F.col("total"))
    return joined.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", near.alias("n_within_radius"))


__all__ = ["simhash", "simhash_report", "within_radius", "block_tables", "table"]
