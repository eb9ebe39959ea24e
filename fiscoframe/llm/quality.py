"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document with features x is sigmoid(w0 + sum w_i x_i + pairs), where the
sum over all pairs <v_i, v_j> x_i x_j is computed in linear time as
0.5 * sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

Nulls and empty texts count as an empty document and get a score.  Repeated rows are
scored each.  Without labels of both kinds every score is the share of label 1 (0.5 if
there is none).  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_by, flat_words, map_slices, ship, texts

ship(__name__)

BUCKETS = 1 << 16
FACTORS = 8
#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE_PER_CLASS = 2000
THRESHOLD = 0.7

UPPER, LOWER, DIGIT, SPACE, NEWLINE, STOP, SYMBOL, HIGH = range(8)
N_CLASSES = 8
#: Steps of the length, word count and line count that are inputs of their own.
LEVELS = 16
DENSE = 17


def byte_classes() -> np.ndarray:
    kinds = np.full(256, SYMBOL, dtype=np.uint8)
    kinds[ord("A") : ord("Z") + 1] = UPPER
    kinds[ord("a") : ord("z") + 1] = LOWER
    kinds[ord("0") : ord("9") + 1] = DIGIT
    kinds[[9, 11, 12, 13, 32]] = SPACE
    kinds[10] = NEWLINE
    kinds[[ord(c) for c in ".,;:'\"()-?"]] = STOP
    kinds[128:] = HIGH
    return kinds


CLASSES = byte_classes()


@dataclass
class Features:
    """Sparse rows: ``index``/``value`` of document d are those from offsets[d] to offsets[d + 1]."""

    index: np.ndarray
    value: np.ndarray
    offsets: np.ndarray


def statistics(text: str, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Structure of one text as numbers of about unit size."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kinds = np.bincount(CLASSES[raw], minlength=N_CLASSES)
    n, n_words = max(1, len(raw)), max(1, len(words))
    letters = max(1, kinds[UPPER] + kinds[LOWER] + kinds[HIGH])
    lines = text.split("\n")
    longest = max(map(len, lines))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return np.array(
        [
            kinds[UPPER] / letters,
            kinds[HIGH] / letters,
            kinds[DIGIT] / n,
            kinds[SPACE] / n,
            kinds[STOP] / n,
            kinds[SYMBOL] / n,
            np.sqrt(kinds[SYMBOL] / n),
            len(counts) / n_words,
            (counts.max() if len(counts) else 0) / n_words,
            float(np.square(counts / n_words).sum()) if len(counts) else 0.0,
            repeats / n_words,
            1 - len(set(lines)) / len(lines),
            np.log1p(len(raw)) / 10,
            np.log1p(len(words)) / 10,
            np.log1p(len(lines)) / 10,
            np.log1p(len(raw) / n_words) / 4,
            np.log1p(longest) / 10,
        ],
        dtype=np.float32,
    )


def features(batch: list[str]) -> Features:
    """Features of whole texts: words by hash, then statistics, then the steps of the sizes."""
    words = [t.lower().split() for t in batch]
    codes, distinct, offsets = flat_words(words)
    buckets = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS for w in distinct), np.int64, len(distinct))
    index, value, ends = [], [], [0]
    for d, text in enumerate(batch):
        found, counts = np.unique(codes[offsets[d] : offsets[d + 1]], return_counts=True)
        dense = statistics(text, words[d], counts)
        steps = np.minimum(LEVELS - 1, (dense[[12, 13, 14]] * 15).astype(np.int64)) + LEVELS * np.arange(3)
        weights = np.sqrt(counts)
        weights /= max(1e-9, np.sqrt(np.square(weights).sum()))
        index.append(np.concatenate([buckets[found], BUCKETS + np.arange(DENSE), BUCKETS + DENSE + steps]))
        value.append(np.concatenate([weights, dense, np.full(3, 0.5)]).astype(np.float32))
        ends.append(ends[-1] + len(index[-1]))
    if not batch:
        return Features(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(1, np.int64))
    return Features(np.concatenate(index), np.concatenate(value), np.array(ends, dtype=np.int64))


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def scaled(self, x: Features) -> np.ndarray:
        value = x.value.copy()
        own = (x.index >= BUCKETS) & (x.index < BUCKETS + DENSE)
        at = x.index[own] - BUCKETS
        value[own] = np.clip((value[own] - self.centre[at]) / self.scale[at], -4, 4) * 0.3
        return value

    def logits(self, x: Features) -> np.ndarray:
        """Linear-time form; each document has at least the statistics, so no run is empty."""
        if len(x.offsets) == 1:
            return np.zeros(0, np.float32)
        value = self.scaled(x)[:, None]
        rows = self.factors[x.index] * value
        starts = x.offsets[:-1]
        sums = np.add.reduceat(rows, starts, axis=0)
        squares = np.add.reduceat(np.square(rows).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.linear[x.index] * value[:, 0], starts) + 0.5 * (np.square(sums).sum(axis=1) - squares)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: Features, label: np.ndarray, weight: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 0.02, penalty: float = 2e-5, seed: int = 7) -> Machine:
    """Adam on weighted log loss; the weights restore the shares of the classes."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + DENSE + 3 * LEVELS
    own = (x.index >= BUCKETS) & (x.index < BUCKETS + DENSE)
    dense = x.value[own].reshape(-1, DENSE)
    model = Machine(0.0, np.zeros(size, np.float32), rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32), dense.mean(axis=0), dense.std(axis=0) + 1e-3)
    value = model.scaled(x)
    theta = np.concatenate([model.linear[:, None], model.factors], axis=1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    b, mb, vb, step = 0.0, 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for chosen in np.array_split(order, max(1, len(order) // batch)):
            step += 1
            lengths = x.offsets[chosen + 1] - x.offsets[chosen]
            at = np.repeat(x.offsets[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            rows, doc = x.index[at], np.repeat(np.arange(len(chosen)), lengths)
            v = value[at][:, None]
            part = theta[rows]
            vx = part[:, 1:] * v
            sums = add_by(doc, vx, len(chosen))
            z = b + add_by(doc, part[:, 0] * v[:, 0], len(chosen)) + 0.5 * (np.square(sums).sum(axis=1) - add_by(doc, np.square(vx).sum(axis=1), len(chosen)))
            error = (sigmoid(z) - label[chosen]) * weight[chosen] / len(chosen)
            each = error[doc][:, None]
            grad = np.concatenate([each * v, each * v * (sums[doc] - vx)], axis=1)
            touched, back = np.unique(rows, return_inverse=True)
            g = add_by(back, grad, len(touched)) + penalty * theta[touched]
            first[touched] = 0.9 * first[touched] + 0.1 * g
            second[touched] = 0.999 * second[touched] + 0.001 * g * g
            theta[touched] -= rate * (first[touched] / (1 - 0.9**step)) / (np.sqrt(second[touched] / (1 - 0.999**step)) + 1e-6)
            gb = float(error.sum())
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            b -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-6)
    return Machine(b, theta[:, 0].astype(np.float32), theta[:, 1:].astype(np.float32), model.centre, model.scale)


def held_out(mod: int, rest: int):
    """Rows that are not learned from: crc32 of the id as text has this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def labelled(labels: DataFrame, column: str, mod: int, rest: int) -> DataFrame:
    """One row (doc_id, label) per learnable document; of contradicting labels the larger counts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(~held_out(mod, rest))
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def bounded_sample(known: DataFrame, per_class: dict[int, int]) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """At most ``per_class`` ids of each class, in the order of a hash of the id; and the true counts."""
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = []
    for label, most in per_class.items():
        chosen = known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        rows += [(r["doc_id"], label) for r in chosen.collect()]
    return rows, totals


FEATURE_SCHEMA = "doc_id long, index array<int>, value array<float>"


def feature_rows(piece: pa.RecordBatch) -> pa.RecordBatch:
    x = features(piece.column("text").to_pylist())
    ends = pa.array(x.offsets.astype(np.int32))
    arrays = [piece.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(x.index.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(x.value))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "index", "value"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Machine | float:
    """Fit on a bounded sample of labelled documents; a number if there are not both labels to learn from."""
    spark = docs.sparkSession
    rows, totals = bounded_sample(labelled(labels, "quality", 4, 2), {0: per_class, 1: per_class})
    if len(totals) < 2:
        return float(next(iter(totals), 0.5))
    chosen = spark.createDataFrame(rows, "doc_id long, label int")
    found = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text")
    got = map_slices(found, feature_rows, FEATURE_SCHEMA).toArrow().sort_by("doc_id")
    label_of = dict(rows)
    label = np.array([label_of[i] for i in got["doc_id"].to_pylist()], dtype=np.float64)
    if len(set(label)) < 2:
        return float(label.mean()) if len(label) else 0.5
    share = {k: totals[k] / sum(totals.values()) for k in (0, 1)}
    weight = np.where(label == 1, share[1] / (label == 1).mean(), share[0] / (label == 0).mean())
    lengths = np.array([len(x) for x in got["index"]])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    index = got["index"].combine_chunks().flatten().to_numpy().astype(np.int64)
    return fit(Features(index, got["value"].combine_chunks().flatten().to_numpy(), offsets), label, weight)


def scored(docs: DataFrame, model: Machine | float) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``; every whole text is read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        if isinstance(model, float):
            score = np.full(piece.num_rows, model)
        else:
            score = sigmoid(model.logits(features([t or "" for t in piece.column("text").to_pylist()]))).astype(np.float64)
        return pa.RecordBatch.from_arrays([*piece.columns, pa.array(score, pa.float64())], names=[*piece.schema.names, "quality_score"])

    base = docs.drop("quality_score")
    schema = T.StructType([*base.schema.fields, T.StructField("quality_score", T.DoubleType())])
    return map_slices(base, work, schema)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    result = scored(texts(docs), train(docs, labels))
    return result.select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with the columns of ``docs``."""
    return scored(docs, train(docs, labels)).filter(F.col("quality_score") >= threshold).select(*docs.columns)
