"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

A document is a weighted set of its runs of five words (all its words, if fewer).  The weight of a shingle is its number
of occurrences times a damped inverse document frequency between ``FLOOR`` and 1: shingles
that few documents hold weigh 1, one that every document holds weighs ``FLOOR``.
Document frequencies are counted over all documents in a table of ``1 << TABLE_BITS`` counters
less their mean load; only shares of documents above ``RARE`` matter, which the table resolves at any size.

1. One pass counts, one pass draws ``SAMPLES`` samples of each document.
2. Documents with the same sequence of words become one node with the smallest id.
3. Bands of ``ROWS`` samples give buckets.  Each node is compared with the first node of each of its
   buckets; then with the next nodes of the bucket, in the order of another band, unless they are linked
   already.  Nodes of larger buckets that still hold several classes are then joined on rare shingles by an
   exact prefix filter.  Nothing lists all pairs of a bucket.
4. Pairs whose samples agree in fewer than ``PROMISING`` cases are no candidates (a pair at the
   threshold fails this about once in ten million); the others are verified by weighted Jaccard
   similarity of the whole texts, at least ``THRESHOLD``.
5. Linked nodes form classes: labels are lowered along links and shortcut until none changes.

A null text is an empty one; a document without words, and a row without an id, is in a class of its own.  Repeated
rows of one id are one document.  The class id is the smallest id of the class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from ..session import stage
from .common import flat_words, in_batches, map_slices, mix, ship, shingle_hashes, slices, small_or_joined, texts, word_hashes

ship(__name__)

SHINGLE = 5
SAMPLES, ROWS = 64, 4
THRESHOLD = 0.8
PROMISING = 0.5
TABLE_BITS = 20
TABLE_CHUNK = 4096
RARE = 0.002
FLOOR = 0.75
#: Standard errors by which a frequency counts as less than measured.
SURE = 4.5
#: Following nodes of a bucket that a node is compared with.
FOLLOWING = 3
#: Nodes of a bucket that are put in order together.
RUN = 20_000
#: Relative room for rounding in bounds of sums of weights.
SLACK = 1e-6


def gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at the middles of ``n`` equal steps."""
    u = (np.arange(n) + 0.5) / n
    x = np.sqrt(2 * u) + u
    for _ in range(60):
        x = np.maximum(1e-9, x - np.clip((1 - (1 + x) * np.exp(-x) - u) / (x * np.exp(-x)), -1, 1))
    return x.astype(np.float32)


def shingle_counts(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Distinct shingles of each text, their occurrences, the offsets of the texts, and a digest of each word sequence."""
    codes, distinct, offsets = flat_words([t.split() for t in batch])
    hashes = word_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    shingles, docs = shingle_hashes(hashes, offsets, SHINGLE)
    ends = np.searchsorted(docs, np.arange(len(batch) + 1))
    found, counts, out = [], [], [0]
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        s, n = np.unique(shingles[a:b], return_counts=True)
        found.append(s)
        counts.append(n)
        out.append(out[-1] + len(s))
    digests = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *found]), np.concatenate([none, *counts]).astype(np.int64), np.array(out, np.int64), digests


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Counters of documents by shingle hash, and the number of documents; a table of fixed size."""
    size = 1 << TABLE_BITS

    def count(batches):
        table, n = np.zeros(size, np.int64), 0
        for piece in slices(batches):
            shingles, _, offsets, _ = shingle_counts(piece.column("text").to_pylist())
            table += np.bincount((shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64), minlength=size)
            n += int((np.diff(offsets) > 0).sum())
        parts = table.reshape(-1, TABLE_CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([-1, *used], pa.int32()), "counts": pa.array([np.array([n], "<i8").tobytes(), *(parts[i].astype("<i8").tobytes() for i in used)], pa.binary())})

    def add(batches):
        totals: dict[int, np.ndarray] = {}  # at most the chunks of the table
        for batch in batches:
            for k, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                totals[k] = totals.get(k, 0) + np.frombuffer(raw, "<i8")
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(totals), pa.int32()), "counts": pa.array([x.astype("<i8").tobytes() for x in totals.values()], pa.binary())})

    schema = "chunk int, counts binary"
    summed = in_batches(in_batches(texts(docs).select("text"), count, schema).repartition("chunk"), add, schema)
    table, n = np.zeros(size, np.int64), 0
    for r in summed.collect():  # the table, 8 MB
        values = np.frombuffer(bytes(r["counts"]), "<i8")
        if r["chunk"] < 0:
            n += int(values[0])
        else:
            table[r["chunk"] * TABLE_CHUNK : (r["chunk"] + 1) * TABLE_CHUNK] += values
    return table, n


def damped_idf(table: np.ndarray, n: int) -> np.ndarray:
    """Weight by counter: 1 up to the share RARE of documents, FLOOR for all documents, logarithmic between.

    The share is a lower bound of what the count stands for, by the same formula at every size.
    """
    count = np.maximum(table - table.mean(), 0)
    # the share that the count proves at SURE standard errors: near nothing for few documents, the share itself for many
    least = count + SURE**2 / 2 - SURE * np.sqrt(count + SURE**2 / 4)
    share = np.clip(least / max(1, n), 1e-12, 1)
    return (FLOOR + (1 - FLOOR) * np.clip(np.log(share) / np.log(RARE), 0, 1)).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling: r and c from Gamma(2, 1), beta uniform, all by hash of (sample, shingle).

    The smallest ln a = ln c - r (t - beta + 1) with t = floor(ln w / r + beta) names the sample; its bits stand for (shingle, t).
    """

    def __init__(self):
        self.gamma = gamma_quantiles()
        self.ln = -np.log((np.arange(1 << 16, dtype=np.float64) + 0.5) / (1 << 16)).astype(np.float32)

    def samples(self, shingles: np.ndarray, weights: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        out = np.full((n, SAMPLES), np.inf, np.float32)
        full = np.flatnonzero(np.diff(offsets))
        for group in np.array_split(full, max(1, len(shingles) // 30_000)):
            if not len(group):
                continue
            a, b = offsets[group[0]], offsets[group[-1] + 1]
            base, ln_w, starts = shingles[a:b], np.log(weights[a:b]), offsets[group] - a
            for k in range(SAMPLES):
                bits = mix(base + np.uint64((k * 0x9E3779B97F4A7C15 + 1) % (1 << 64))).view(np.uint16).reshape(-1, 4)
                r = self.gamma[bits[:, 0]]
                beta = bits[:, 1] * np.float32(1 / 65536)
                c = self.ln[bits[:, 2]] + self.ln[bits[:, 3]]
                t = np.floor(ln_w / r + beta)
                t -= beta
                t += 1
                t *= r
                np.log(c, out=c)
                c -= t
                out[group, k] = np.minimum.reduceat(c, starts)
        return out


SIGNATURE = "doc_id long, sequence binary, n_shingles long, samples array<int>"


def signatures(docs: DataFrame, idf) -> DataFrame:
    """The samples of every whole text."""

    def run(batches):
        sampler, weight = Sampler(), idf.value
        for piece in slices(batches):
            shingles, counts, offsets, digests = shingle_counts(piece.column("text").to_pylist())
            weights = counts.astype(np.float32) * weight[(shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
            drawn = sampler.samples(shingles, weights, offsets).view(np.int32)
            ends = pa.array(np.arange(len(drawn) + 1, dtype=np.int32) * SAMPLES)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": piece.column("doc_id"), "sequence": pa.array(digests, pa.binary()), "n_shingles": pa.array(np.diff(offsets)), "samples": pa.ListArray.from_arrays(ends, pa.array(drawn.reshape(-1)))}
            )

    return in_batches(texts(docs), run, SIGNATURE)


def entries(nodes: DataFrame) -> DataFrame:
    """node, band, key and the key of another band, which orders the bucket."""
    bands = SAMPLES // ROWS
    keys = F.array(*[F.xxhash64(*[F.col("samples")[b * ROWS + j] for j in range(ROWS)]) for b in range(bands)])
    rows = nodes.select("node", keys.alias("keys")).select("node", "keys", F.posexplode("keys").alias("band", "key"))
    return rows.select("node", "band", "key", F.element_at("keys", ((F.col("band") + 1) % bands + 1).cast("int")).alias("order"))


def agree(left, right):
    same = F.zip_with(left, right, lambda a, b: (a == b).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / SAMPLES


def promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose samples agree often enough to be worth a look at the texts."""
    a = nodes.select(F.col("node").alias("a"), F.col("samples").alias("samples_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("samples").alias("samples_b"))
    return pairs.join(a, "a").join(b, "b").filter(agree(F.col("samples_a"), F.col("samples_b")) >= PROMISING).select("a", "b")


def weighted_jaccard(x: tuple, y: tuple) -> float:
    """Sum of the smaller weights over the sum of the larger ones, of two (sorted shingles, weights)."""
    both, at_x, at_y = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(x[1][at_x], y[1][at_y]).sum())
    total = float(x[1].sum() + y[1].sum()) - least
    return least / total if total > 0 else 0.0


def verified(pairs: DataFrame, docs: DataFrame, idf) -> DataFrame:
    """Pairs (a, b) whose whole texts reach the threshold, with their similarity."""
    bodies = texts(docs)
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    bodies = bodies.join(small_or_joined(wanted), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    left = bodies.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = bodies.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(right, "b").join(left, "a")

    def sets(batch: list[str], weight) -> list[tuple]:
        shingles, counts, offsets, _ = shingle_counts(batch)
        weights = counts * weight[(shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)].astype(np.float64)
        return [(shingles[a:b], weights[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        weight = idf.value
        ids = piece.column("a").to_pylist()
        first: dict[int, int] = {}
        bodies = []
        for i, t in zip(ids, piece.column("text_a").to_pylist(), strict=True):
            if i not in first:
                first[i] = len(bodies)
                bodies.append(t)
        mine, theirs = sets(bodies, weight), sets(piece.column("text_b").to_pylist(), weight)
        alike = [weighted_jaccard(mine[first[i]], y) for i, y in zip(ids, theirs, strict=True)]
        return pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b"), pa.array(alike, pa.float64())], names=["a", "b", "similarity"])

    return map_slices(rows.select("a", "b", "text_a", "text_b"), work, "a long, b long, similarity double", column="text_b").filter(F.col("similarity") >= THRESHOLD)


def rare_shingles(bodies: DataFrame, idf) -> DataFrame:
    """node, shingle, total, rest: the shingles among which a text shares its first one with any partner at the threshold.

    Shingles stand in one order for all texts, those of few texts of ``bodies`` first.  What two texts share lies within
    ``rest``, the weight from their first common shingle on, in both; so only shingles that
    leave at least ``THRESHOLD`` of the ``total`` weight are needed.
    """
    held, _ = document_frequencies(bodies)
    held = bodies.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for piece in slices(batches):
            shingles, counts, offsets, _ = shingle_counts(piece.column("text").to_pylist())
            slot = (shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            weights, often = counts * idf.value[slot].astype(np.float64), held.value[slot]
            rows = [(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), np.zeros(0, np.int64))]
            for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                order = a + np.lexsort((shingles[a:b], often[a:b]))
                total = weights[a:b].sum()
                rest = total - np.cumsum(weights[order]) + weights[order]
                n = int((rest >= THRESHOLD * total * (1 - SLACK)).sum())
                rows.append((shingles[order[:n]], np.full(n, total), rest[:n], np.full(n, k)))
            token, total, rest, row = (np.concatenate(c) for c in zip(*rows, strict=True))
            yield pa.RecordBatch.from_pydict({"node": piece.column("doc_id").take(pa.array(row)), "shingle": pa.array(token.view(np.int64)), "total": pa.array(total), "rest": pa.array(rest)})

    return in_batches(bodies.select("doc_id", "text"), run, "node long, shingle long, total double, rest double")


def left_over(held: DataFrame, links: DataFrame, nodes: DataFrame, docs: DataFrame, idf) -> DataFrame | None:
    """Verified links between classes that share a bucket in which not all pairs were compared; None if there is no such bucket."""
    labels = classes(links)
    large = held.filter(F.col("held") > FOLLOWING + 1).join(labels, "node", "left").select("node", "band", "key", F.coalesce("label", "node").alias("label"))
    mixed = large.groupBy("band", "key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most")
    some = stage(large.join(mixed.select("band", "key"), ["band", "key"]).select("node", "label").distinct())
    if some.isEmpty():
        return None
    bodies = texts(docs).join(small_or_joined(some.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    rows = stage(rare_shingles(stage(bodies.dropDuplicates(["doc_id"])), idf).join(some, "node"))
    several = rows.groupBy("shingle").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("shingle")
    rows = stage(rows.join(several, "shingle"))
    of = lambda c: rows.select("shingle", F.col("node").alias(c), F.col("label").alias(f"label_{c}"), F.col("total").alias(f"total_{c}"), F.col("rest").alias(f"rest_{c}"))
    shared = F.lit(THRESHOLD / (1 + THRESHOLD) * (1 - SLACK)) * (F.col("total_a") + F.col("total_b"))
    reach = (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & (F.least("rest_a", "rest_b") >= shared)
    pairs = of("a").join(of("b"), "shingle").filter(reach).select("a", "b").distinct()
    return stage(verified(stage(promising(pairs, nodes)), docs, idf))


def classes(links: DataFrame) -> DataFrame:
    """node, label for every node of a link: the smallest node that links lead to.

    Each round lowers labels along links and then replaces every label by its own label; the labels are
    stored, so that a lost executor costs one round.
    """
    both = stage(links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct())
    labels = stage(both.groupBy("node").agg(F.least(F.min("other"), F.min("node")).alias("label")))
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        lowest = both.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("lowest"))
        lowered = labels.join(lowest, "node").select("node", "label", F.least("label", "lowest").alias("new"))
        hop = labels.select(F.col("node").alias("new"), F.col("label").alias("next"))
        new = stage(lowered.join(hop, "new", "left").select("node", F.least("new", F.coalesce("next", "new")).alias("label"), (F.least("new", F.coalesce("next", "new")) != F.col("label")).alias("changed")))
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return labels


def near_links(nodes: DataFrame, docs: DataFrame, idf) -> DataFrame:
    """Verified links between nodes."""
    rows = stage(entries(nodes))
    buckets = rows.groupBy("band", "key").agg(F.min("node").alias("first"), F.count("*").alias("held")).filter(F.col("held") > 1)
    held = rows.join(buckets, ["band", "key"])
    stars = held.filter(F.col("node") != F.col("first")).select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = stage(verified(stage(promising(stars, nodes)), docs, idf))
    labels = classes(links)

    run = F.pmod(F.xxhash64(F.lit(3), F.col("node")), F.ceil(F.col("held") / RUN))
    along = Window.partitionBy("band", "key", "run").orderBy("order", "node")
    others = F.array(*[F.lead("node", k).over(along) for k in range(1, FOLLOWING + 1)])
    chained = held.filter(F.col("held") > 2).withColumn("run", run).select("node", others.alias("others")).select("node", F.explode("others").alias("other")).filter("other IS NOT NULL")
    pairs = chained.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    apart = F.coalesce("label_a", "a") != F.coalesce("label_b", "b")
    pairs = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").filter(apart).select("a", "b")
    more = stage(verified(stage(promising(pairs, nodes)), docs, idf))
    links = links.unionByName(more)
    rest = left_over(held, links, nodes, docs, idf)
    return links if rest is None else links.unionByName(rest)


def distinct_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``__key``, a number that no two texts share; and the ids of keys that are no ids, if there are any.

    The key is the id, but for ids that several texts have: those texts get numbers above all ids.
    """
    keyed = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    seen = keyed.filter("__id IS NOT NULL").groupBy("__id").agg(F.min("__hash").alias("least"), F.max("__hash").alias("most"))
    several = seen.filter("least < most").select(F.col("__id").alias("__of"))
    if several.isEmpty():
        return keyed.withColumnRenamed("__id", "__key").drop("__hash"), None
    texts_of = keyed.join(several, F.col("__id") == F.col("__of"), "left_semi").select(F.col("__id").alias("of"), F.col("__hash").alias("hash")).distinct()
    above = seen.agg(F.max("__id")).first()[0]
    numbered = stage(number_rows(stage(texts_of), [], [F.col("of"), F.col("hash")]).select("of", "hash", (F.col("seq") + above).alias("number")))
    joined = keyed.join(numbered, (F.col("__id") == F.col("of")) & (F.col("__hash") == F.col("hash")), "left")
    return joined.withColumn("__key", F.coalesce("number", "__id")).drop("__id", "__hash", "of", "hash", "number"), numbered.select("number", "of")


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept for every row.

    ``n_links`` counts the verified links of the row's node; copies of one word sequence share a node.  Texts that share an id
    are treated each; such a class without other ids is named by their common id.
    """
    rows, renamed = distinct_ids(docs)
    found = keyed_classes(rows.select(F.col("__key").alias("doc_id"), "text"))
    if renamed is None:
        return found
    own, of_class = (renamed.select(F.col("number").alias(f"n_{c}"), F.col("of").alias(f"of_{c}")) for c in ("doc", "class"))
    found = found.join(own, F.col("doc_id") == F.col("n_doc"), "left").join(of_class, F.col("class_id") == F.col("n_class"), "left")
    return found.select(F.coalesce("of_doc", "doc_id").alias("doc_id"), F.coalesce("of_class", "class_id").alias("class_id"), "class_size", "n_links", "kept")


def keyed_classes(docs: DataFrame) -> DataFrame:
    """The same of documents whose ids belong to one text each."""
    spark = docs.sparkSession
    table, n = document_frequencies(docs)
    idf = spark.sparkContext.broadcast(damped_idf(table, n))
    drawn = stage(signatures(docs, idf))
    some = drawn.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = stage(some.groupBy("sequence").agg(F.min("doc_id").alias("node"), F.count("*").alias("rows"), F.first("samples").alias("samples")))
    links = near_links(nodes.select("node", "samples").dropDuplicates(["node"]), docs, idf)
    labels = classes(links)
    counts = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("n_links"))
    known = nodes.select("sequence", "node", "rows").join(labels, "node", "left").join(counts, "node", "left")
    known = stage(known.select("sequence", "rows", F.coalesce("label", "node").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    sizes = known.groupBy("class_id").agg(F.sum("rows").alias("class_size"))
    placed = known.join(sizes, "class_id").select("sequence", "class_id", "class_size", "n_links")
    single = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    rows = drawn.select("doc_id", "n_shingles", F.when(~single, F.col("sequence")).alias("sequence")).join(placed, "sequence", "left")
    own = F.coalesce("class_id", "doc_id")
    return rows.select(
        "doc_id", own.alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("doc_id").eqNullSafe(own).alias("kept")
    )


def drop_near(docs: DataFrame) -> DataFrame:
    """One document of each class, with the columns of ``docs``; rows without an id stay, and repeated rows stay together."""
    rows, _ = distinct_ids(docs)
    gone = keyed_classes(rows.select(F.col("__key").alias("doc_id"), "text")).filter(~F.col("kept"))
    gone = small_or_joined(gone.select(F.col("doc_id").alias("__gone")).distinct())
    return rows.join(gone, F.col("__key") == F.col("__gone"), "left_anti").select(*docs.columns)
