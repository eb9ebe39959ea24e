"""Language identification: a byte convolutional network with several filter widths, in numpy.

Bytes get small vectors; filters of two, three and four bytes slide over a window; each filter's largest
response in the window, cut at zero, is an input of a softmax over languages.  Windows have ``WINDOW`` bytes; a text is
cut into windows without gaps, the last one ending with the text, a shorter text is padded with zero bytes.  The
probability of a language is its mean over all windows of the whole text.

At scoring, what a byte pair adds to a filter is looked up in a table made of embedding and filter once, so a
response is the sum of one or two rows.

A null text, or one without any letter (Unicode class L), is ``und`` with score 0, as is every text where no language
can be learned.  Repeated rows are predicted each, ties go to the language that is first in
code-point order, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_slices, ship, spread, texts
from .quality import held_out

ship(__name__)

WIDTHS, FILTERS, EMBEDDED, WINDOW = (2, 3, 4), 8, 8, 96
#: Documents that the network is fitted on: at most so many of each language and in all; the most frequent
#: languages are learned where there are more than LANGUAGES; windows of each document.
SAMPLE_PER_LANGUAGE, SAMPLE, LANGUAGES, SAMPLE_WINDOWS = 800, 40_000, 500, 4
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Windows that are scored at once.
BLOCK = 4096
UNKNOWN = "und"


@dataclass
class Network:
    """``bytes``: a vector for each byte; ``filters``: (width, vector, filter) for each width; softmax weights."""

    languages: list[str]
    p: dict[str, np.ndarray]

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width what the pair of bytes (256 * first + second) at an offset adds to the filters."""
        found = []
        for width in WIDTHS:
            single = [self.p["bytes"] @ self.p[f"w{width}"][j] for j in range(width)]
            pairs = [(j, single[j][:, None] + single[j + 1][None, :]) for j in range(0, width - 1, 2)]
            if width % 2:
                pairs.append((width - 2, np.broadcast_to(single[-1][None, :], (256, 256, FILTERS))))
            found.append([(j, np.ascontiguousarray(t.reshape(1 << 16, FILTERS), np.float32)) for j, t in pairs])
        return found

    def pooled(self, windows: np.ndarray, tables: list) -> np.ndarray:
        """Largest response of every filter in every window (rows of bytes), cut at zero."""
        pairs = windows[:, :-1].astype(np.uint16) << 8 | windows[:, 1:]
        out = []
        for width, parts in zip(WIDTHS, tables, strict=True):
            places = WINDOW - width + 1
            total = None
            for j, table in parts:
                part = table.take(pairs[:, j : j + places], axis=0)
                total = part if total is None else np.add(total, part, out=total)
            out.append(total.max(axis=1) + self.p[f"b{width}"])
        return np.maximum(np.concatenate(out, axis=1), 0)

    def probabilities(self, windows: np.ndarray, tables: list) -> np.ndarray:
        parts = [softmax(self.pooled(windows[a : a + BLOCK], tables) @ self.p["v"] + self.p["c"]) for a in range(0, len(windows), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def window_starts(n: int) -> list[int]:
    """Windows without gaps; the last one ends with the text."""
    return [*range(0, n - WINDOW, WINDOW), max(0, n - WINDOW)]


def cut(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts (rows of bytes) and the number of each text's; at least one."""
    texts = column.cast(pa.binary()).to_pylist()
    starts = [window_starts(len(t)) for t in texts]
    counts = np.array([len(s) for s in starts], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    data = np.frombuffer(b"".join(texts) + b"\0" * WINDOW, np.uint8)
    first = np.repeat(base, counts) + np.array([x for s in starts for x in s], np.int64)
    rows = data[first[:, None] + np.arange(WINDOW)]
    short = np.flatnonzero(np.repeat(sizes, counts) < WINDOW)
    rows[short] *= np.arange(WINDOW) < np.repeat(sizes, counts)[short, None]
    return rows, counts


def fit(windows: np.ndarray, label: np.ndarray, languages: list[str], seed: int = 5) -> Network:
    """Adam on log loss; the sample holds the languages in about equal parts."""
    rng = np.random.default_rng(seed)
    p = {"bytes": rng.normal(0, 0.5, (256, EMBEDDED)), "v": rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))), "c": np.zeros(len(languages))}
    p["bytes"][0] = 0
    for width in WIDTHS:
        p[f"w{width}"] = rng.normal(0, 1 / np.sqrt(width * EMBEDDED), (width, EMBEDDED, FILTERS))
        p[f"b{width}"] = np.zeros(FILTERS)
    net = Network(languages, {k: v.astype(np.float32) for k, v in p.items()})
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        speed = RATE if epoch < EPOCHS * 2 // 3 else RATE / 4
        for chosen in np.array_split(order, max(1, len(order) // BATCH)):
            step += 1
            for k, g in gradient(net, windows[chosen], label[chosen]).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.p[k] -= (speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def gradient(net: Network, windows: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean log loss; only the place of a filter's largest response passes it on."""
    p, n = net.p, len(windows)
    embedded = p["bytes"][windows]
    best, tops = {}, []
    for width in WIDTHS:
        places = WINDOW - width + 1
        spans = np.stack([embedded[:, j : j + places] for j in range(width)], axis=2).reshape(n, places, width * EMBEDDED)
        response = spans @ p[f"w{width}"].reshape(width * EMBEDDED, FILTERS)
        best[width] = response.argmax(axis=1)
        tops.append(np.take_along_axis(response, best[width][:, None], axis=1)[:, 0] + p[f"b{width}"])
    top = np.concatenate(tops, axis=1)
    pooled = np.maximum(top, 0)
    d = softmax(pooled @ p["v"] + p["c"])
    d[np.arange(n), label] -= 1
    d /= n
    g = {"v": pooled.T @ d, "c": d.sum(axis=0), "bytes": np.zeros_like(p["bytes"])}
    back = (d @ p["v"].T) * (top > 0)
    for k, width in enumerate(WIDTHS):
        own = back[:, k * FILTERS : (k + 1) * FILTERS]
        at = best[width][:, :, None] + np.arange(width)
        held = np.take_along_axis(windows, at.reshape(n, -1), axis=1).reshape(at.shape)
        g[f"b{width}"] = own.sum(axis=0)
        g[f"w{width}"] = np.einsum("nf,nfje->jef", own, p["bytes"][held])
        to_bytes = np.einsum("nf,jef->nfje", own, p[f"w{width}"]).reshape(-1, EMBEDDED)
        np.add.at(g["bytes"], held.ravel(), to_bytes)
    return g


def sample_windows(piece: pa.RecordBatch) -> pa.RecordBatch:
    """At most SAMPLE_WINDOWS windows of each text, evenly spread."""
    rows, counts = cut(piece.column("text"))
    kept = np.minimum(counts, SAMPLE_WINDOWS)
    nth = spread(np.zeros(len(kept), np.int64), kept)
    step = np.repeat((counts - 1) / np.maximum(1, kept - 1), kept)
    at = np.repeat(np.cumsum(counts) - counts, kept) + (nth * step).astype(np.int64)
    owner = pa.array(np.repeat(np.arange(len(kept)), kept))
    chosen = pa.array([rows[i].tobytes() for i in at], pa.binary())
    return pa.RecordBatch.from_arrays([piece.column("doc_id").take(owner), piece.column("lang").take(owner), chosen], names=["doc_id", "lang", "window"])


def train(docs: DataFrame) -> Network | None:
    """Fit on a bounded sample of documents with a language and a letter; none if there is no such document."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text"))
    named = named.filter(~held_out(4, 2) & F.col("lang").isNotNull() & has_letter())
    counts = named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return None
    each = min(SAMPLE_PER_LANGUAGE, SAMPLE // len(languages))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # twice as many ids as wanted have a hash below the bound of their language, so that ranking them takes few rows
    bounds = [(r["lang"], min(2**64 - 1, 2 * each * 2**64 // r["count"]) - 2**63) for r in counts]
    bounds = docs.sparkSession.createDataFrame(bounds, "of string, bound long")
    near = named.join(F.broadcast(bounds), (F.col("lang") == F.col("of")) & (F.xxhash64("doc_id") <= F.col("bound")))
    ids = near.filter("doc_id IS NOT NULL").select("doc_id", "lang").distinct()
    ids = ids.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= each).select("doc_id", "lang")
    # at most SAMPLE ids; of different texts with one id and language the least in code-point order is taken
    chosen = named.join(F.broadcast(ids), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    got = map_slices(chosen, sample_windows, "doc_id long, lang string, window binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("window", "ascending")])
    windows = np.frombuffer(b"".join(got["window"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    number = {name: i for i, name in enumerate(languages)}
    return fit(windows, np.array([number[x] for x in got["lang"].to_pylist()]), languages)


def has_letter():
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predicted(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score and the number of bytes of every row; the languages are guesses also for texts without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(net and (net.languages, net.p))
    ready = []

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        net = shared.value and Network(*shared.value)
        if net is None:
            names, score = [UNKNOWN] * piece.num_rows, np.zeros(piece.num_rows)
        else:
            if not ready:
                ready.append(net.tables())
            windows, counts = cut(piece.column("text"))
            total = np.add.reduceat(net.probabilities(windows, ready[0]), np.cumsum(counts) - counts, axis=0)
            mean = total / counts[:, None]
            best = mean.argmax(axis=1)
            names, score = [net.languages[i] for i in best], np.clip(mean[np.arange(len(best)), best], 0, 1).astype(np.float64)
        arrays = [piece.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.compute.binary_length(piece.column("text")).cast(pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "n_bytes"])

    return map_slices(docs, work, "doc_id long, lang_pred string, score double, n_bytes long")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    net = train(docs)
    # a text without letters is sent as an empty one and named afterwards
    lettered = docs.select("doc_id", F.when(has_letter(), F.col("text")).alias("text"))
    found = predicted(texts(lettered), net)
    named = F.col("n_bytes") > 0
    return found.select(
        "doc_id",
        held_out(4, 2).alias("held_out"),
        F.when(named, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(named, F.col("score")).otherwise(0.0).alias("score"),
    )
