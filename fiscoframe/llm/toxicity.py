"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is read in overlapping windows of ``SPAN`` words, ``STRIDE`` apart, the last one ending with the
text.  The input of a word is its own embedding (words that the sample holds often enough) and the mean
embedding of its character groups.  Two gated recurrent layers read a window in either direction,
attention pools their states, and a logistic output gives the window's logit.  A text is as
toxic as its worst window; that logit is calibrated on labelled documents that were not fitted on.

Nulls and empty texts count as an empty document and get the score of one without toxic windows.
Repeated rows are scored each.  Without labels of both kinds every score is the share of label 1
(0.5 if there is none).  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_words, in_batches, mix, ship, slices, spread, texts
from .quality import THRESHOLD, bounded_sample, held_out, labelled, sigmoid

ship(__name__)

SPAN, STRIDE = 24, 12
HIDDEN, WORD_SIZE, CHAR_SIZE, ATTENTION = 8, 8, 12, 8
GROUPS = 1 << 14
#: A word has an embedding of its own if so many sample documents hold it.
LEAST_DOCUMENTS = 6
#: Labelled documents of each class that the network is fitted on, at most, and their longest text.
SAMPLE_PER_CLASS = {1: 1500, 0: 2500}
SAMPLE_CHARS = 20_000
#: Passes over the sample; a small sample gets more of them, so that there are LEAST_STEPS steps.
EPOCHS, LEAST_STEPS, BATCH = 8, 500, 64
#: Windows that are run at once, words whose gates are computed at once, and words that a task remembers.
BLOCK, WORDS, REMEMBERED = 1024, 50_000, 300_000


def char_groups(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed groups of three and four bytes of each word with its edges; and their number for each word."""
    data = np.frombuffer(("\x01" + "\x01".join(words) + "\x01").encode("utf-8", "replace") + b"\0\0\0", np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w.encode("utf-8", "replace")) for w in words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1  # the edge before each word
    found = []
    for length in (3, 4):
        counts = np.maximum(0, sizes + 3 - length)
        at = spread(starts, counts)
        code = np.zeros(len(at), np.uint64)
        for j in range(length):
            code |= data[at + j] << np.uint64(8 * j)
        found.append(((mix(code + np.uint64(length << 40)) % np.uint64(GROUPS)).astype(np.int64), np.repeat(np.arange(len(words)), counts)))
    groups, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(owner, kind="stable")
    return groups[order], np.bincount(owner, minlength=len(words))


def bare(word: str) -> str:
    return word.strip(".,;:!?\"'()*#$%&|[]-") or word


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows of a text of ``n`` words; at least one."""
    last = max(0, n - SPAN)
    return [*range(0, last, STRIDE), last]


def window_table(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the words of every window (-1: none) and the text of each window."""
    starts, owner, ends = [], [], []
    for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = windows(b - a)
        starts += [a + s for s in own]
        owner += [d] * len(own)
        ends += [b] * len(own)
    at = np.array(starts, np.int64)[:, None] + np.arange(SPAN)
    at[at >= np.array(ends, np.int64)[:, None]] = -1
    return at, np.array(owner, np.int64)


def soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place: the bounded activation of all layers; gates are (1 + soft(x)) / 2."""
    x /= 1 + np.abs(x)
    return x


@dataclass
class Network:
    """Parameters by name; words with an embedding by text."""

    p: dict[str, np.ndarray]
    known: dict[str, int]
    scale: tuple[float, float, float] = (1.0, 0.0, 0.0)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of distinct words; what they are made of."""
        plain = [bare(w) for w in words]
        ids = np.fromiter((self.known.get(w, 0) for w in plain), np.int64, len(plain))
        groups, counts = char_groups(plain)
        chars = np.zeros((len(plain), CHAR_SIZE), np.float32)
        full = np.flatnonzero(counts)
        ends = np.cumsum(counts)
        for part in np.array_split(full, max(1, len(groups) // 50_000)):
            if len(part):
                a, b = ends[part[0]] - counts[part[0]], ends[part[-1]]
                chars[part] = np.add.reduceat(self.p["chars"][groups[a:b]], ends[part] - counts[part] - a, axis=0)
        chars /= np.sqrt(np.maximum(1, counts))[:, None]
        return np.concatenate([self.p["words"][ids], chars], axis=1), ids, groups, counts

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What the words add to the gates of both directions: one row of 6 * HIDDEN numbers a word."""
        return x @ np.concatenate([self.p["Wf"], self.p["Wb"]]).T + np.concatenate([self.p["bf"], self.p["bb"]])

    def run(self, codes: np.ndarray, gates: np.ndarray, empty: int, keep: bool = False):
        """Logits of windows (rows of codes); with ``keep`` also what the gradient needs.

        Arrays hold a feature a row and a window a column, so that slices by feature stay contiguous.
        """
        n, h = len(codes), HIDDEN
        states = np.empty((SPAN, 2 * h, n), np.float32)
        kept = {}
        steps = np.ascontiguousarray(codes.T)
        for side, name in enumerate("fb"):
            u, g = self.p["U" + name], gates[:, 3 * h * side : 3 * h * (side + 1)]
            state = np.zeros((h, n), np.float32)
            for t in range(SPAN) if side == 0 else range(SPAN - 1, -1, -1):
                into = np.ascontiguousarray(g[steps[t]].T)
                back = u @ state
                zr = into[: 2 * h]
                zr += back[: 2 * h]
                soft(zr)
                zr *= 0.5
                zr += 0.5
                z, r = zr[:h], zr[h:]
                new = r * back[2 * h :]
                new += into[2 * h :]
                soft(new)
                if keep:
                    kept[name, t] = (state, z, r, new, back[2 * h :])
                state = state - new
                state *= z
                state += new
                states[t, side * h : (side + 1) * h] = state
        u = self.p["Wa"] @ states
        u += self.p["ba"][:, None]
        soft(u)
        score = np.einsum("a,tan->tn", self.p["va"], u)
        absent = steps == empty
        score[absent] = -1e9
        score[0, absent.all(axis=0)] = 0
        score -= score.max(axis=0)
        np.exp(score, out=score)
        score /= score.sum(axis=0)
        pooled = np.einsum("tn,thn->hn", score, states)
        logit = self.p["wo"] @ pooled + self.p["bo"][0]
        return (logit, states, kept, u, score, pooled) if keep else logit

    def logits(self, codes: np.ndarray, gates: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Logits of all windows; ``at`` are positions in ``codes``, the last row of ``gates`` is the empty word's."""
        empty = len(gates) - 1
        padded = np.append(codes, empty)
        return np.concatenate([self.run(padded[at[a : a + BLOCK]], gates, empty) for a in range(0, len(at), BLOCK)])

    def of_words(self, distinct: np.ndarray, memory: dict) -> np.ndarray:
        """Gates of distinct words and of the empty word; ``memory`` holds those of words met before."""
        if len(memory.get("rows", ())) + len(distinct) > REMEMBERED:
            memory.clear()
        places, rows = memory.setdefault("places", {}), memory.get("rows")
        if new := [w for w in [*distinct, ""] if w not in places]:
            made = np.concatenate([self.gates(self.inputs(new[a : a + WORDS])[0]) for a in range(0, len(new), WORDS)])
            base = len(places)
            places.update((w, base + i) for i, w in enumerate(new))
            memory["rows"] = rows = made if rows is None else np.concatenate([rows, made])
        return rows[np.fromiter((places[w] for w in [*distinct, ""]), np.int64, len(distinct) + 1)]

    def worst(self, batch: list[str], memory: dict) -> tuple[np.ndarray, np.ndarray]:
        """Largest window logit and number of windows of every text."""
        codes, distinct, offsets = flat_words([t.lower().split() for t in batch])
        at, owner = window_table(offsets)
        logit = self.logits(codes, self.of_words(distinct, memory), at)
        return np.maximum.reduceat(logit, np.flatnonzero(np.diff(owner, prepend=-1))), np.bincount(owner)

    def scores(self, batch: list[str], memory: dict | None = None) -> np.ndarray:
        logit, n = self.worst(batch, {} if memory is None else memory)
        a, b, c = self.scale
        return sigmoid(a * logit.astype(np.float64) + b + c * np.log(n))


def fresh(known: dict[str, int], seed: int) -> Network:
    rng = np.random.default_rng(seed)
    d, h = WORD_SIZE + CHAR_SIZE, HIDDEN

    def normal(*shape, scale=None):
        return rng.normal(0, scale or 1 / np.sqrt(shape[-1]), shape).astype(np.float32)

    p = {"words": normal(len(known) + 1, WORD_SIZE, scale=0.1), "chars": normal(GROUPS, CHAR_SIZE, scale=0.1)}
    for s in "fb":
        p |= {"W" + s: normal(3 * h, d), "U" + s: normal(3 * h, h), "b" + s: np.zeros(3 * h, np.float32)}
    p |= {"Wa": normal(ATTENTION, 2 * h), "ba": np.zeros(ATTENTION, np.float32), "va": normal(ATTENTION), "wo": normal(2 * h), "bo": np.zeros(1, np.float32)}
    p["words"][0] = 0
    return Network(p, known)


def gradient(net: Network, codes: np.ndarray, words: list[str], label: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the log loss over windows; ``codes`` index ``words``, the last one is the empty word."""
    h, p = HIDDEN, net.p
    x, ids, groups, counts = net.inputs(words)
    logit, states, kept, u, score, pooled = net.run(codes, net.gates(x), len(words) - 1, keep=True)
    d = ((sigmoid(logit) - label) / len(label)).astype(np.float32)
    g = {"wo": pooled @ d, "bo": np.array([d.sum()], np.float32)}
    dpooled = p["wo"][:, None] * d
    dscore = np.einsum("hn,thn->tn", dpooled, states)
    ds = score * (dscore - (score * dscore).sum(axis=0))
    du = ds[:, None, :] * p["va"][:, None] * (1 - np.abs(u)) ** 2
    g["va"] = np.einsum("tn,tan->a", ds, u)
    g["Wa"], g["ba"] = np.einsum("tan,thn->ah", du, states), du.sum(axis=(0, 2))
    dstates = score[:, None, :] * dpooled + p["Wa"].T @ du
    into = np.zeros((len(words), 6 * h), np.float32)
    for side, name in enumerate("fb"):
        dU = np.zeros_like(p["U" + name])
        carry = np.zeros((h, len(codes)), np.float32)
        for t in range(SPAN - 1, -1, -1) if side == 0 else range(SPAN):
            before, z, r, new, back = kept[name, t]
            dh = dstates[t, side * h : (side + 1) * h] + carry
            dz = dh * (before - new) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dn = dh * (1 - z) * (1 - np.abs(new)) ** 2
            dr = dn * back * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            da = np.concatenate([dz, dr, dn * r])
            np.add.at(into[:, 3 * h * side : 3 * h * (side + 1)], codes[:, t], np.concatenate([dz, dr, dn]).T)
            dU += da @ before.T
            carry = dh * z + p["U" + name].T @ da
        g["U" + name] = dU
    weights = into.T @ x
    g["Wf"], g["Wb"], bias = weights[: 3 * h], weights[3 * h :], into.sum(axis=0)
    g["bf"], g["bb"] = bias[: 3 * h], bias[3 * h :]
    dx = into @ np.concatenate([p["Wf"], p["Wb"]])
    g["words"] = np.zeros_like(p["words"])
    np.add.at(g["words"], ids, dx[:, :WORD_SIZE])
    g["words"][0] = 0
    per_group = dx[:, WORD_SIZE:] / np.sqrt(np.maximum(1, counts))[:, None]
    g["chars"] = np.stack([np.bincount(groups, np.repeat(per_group[:, j], counts), minlength=GROUPS) for j in range(CHAR_SIZE)], axis=1).astype(np.float32)
    return g


def log_odds(groups_of: list[np.ndarray], label: np.ndarray, size: int) -> np.ndarray:
    """How much more often documents of label 1 hold each item."""
    held = np.zeros((2, size))
    for items, y in zip(groups_of, label, strict=True):
        held[int(y), np.unique(items)] += 1
    n = np.array([(label == 0).sum(), (label == 1).sum()])
    return np.log((held[1] + 1) / (n[1] + 2)) - np.log((held[0] + 1) / (n[0] + 2))


def fit(batch: list[str], label: np.ndarray, weight: np.ndarray, seed: int = 11, rate: float = 0.01) -> Network:
    """Fit on three quarters of the documents, calibrate on the others.

    Only documents are labelled, not windows: a positive document teaches by the window that looks worst
    (at first by the frequencies of its words and character groups, then to the network), a
    negative one by its worst window and one drawn at random.
    """
    rng = np.random.default_rng(seed)
    parts = [t.lower().split() for t in batch]
    codes, distinct, offsets = flat_words(parts)
    plain = [bare(w) for w in distinct]
    checked = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 4 == 0 for t in batch])
    if checked.all() or len(set(label[~checked])) < 2 or len(set(label[checked])) < 2:
        checked = np.arange(len(batch)) % 4 == 0
    fitted = np.flatnonzero(~checked)
    per_doc = [np.unique(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    in_docs = np.zeros(len(distinct), np.int64)
    for i in fitted:
        in_docs[per_doc[i]] += 1
    names: dict[str, int] = {}
    for w, n in zip(plain, in_docs, strict=True):
        names[w] = names.get(w, 0) + int(n)
    known = {w: i + 1 for i, w in enumerate(sorted(w for w, n in names.items() if n >= LEAST_DOCUMENTS))}
    net = fresh(known, seed)

    groups, counts = char_groups(plain)
    ends = np.cumsum(counts)
    odds = log_odds([groups[spread((ends - counts)[per_doc[i]], counts[per_doc[i]])] for i in fitted], label[fitted], GROUPS)
    word_odds = log_odds([per_doc[i] for i in fitted], label[fitted], len(distinct))
    totals = np.add.reduceat(np.append(odds[groups], 0), np.minimum(ends - counts, len(groups))) if len(counts) else odds[:0]
    looks = np.append(totals / np.maximum(1, counts) + np.where(in_docs >= LEAST_DOCUMENTS, word_odds, 0), -9.0)
    net.p["chars"][:, 0] += 0.3 * odds.astype(np.float32)

    at, owner = window_table(offsets)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    last = np.append(first[1:], len(owner))
    padded = np.append(codes, len(distinct))
    look = looks[padded[at]].max(axis=1)
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    logit = look
    epochs = min(80, max(EPOCHS, LEAST_STEPS * BATCH // max(1, len(fitted))))
    for epoch in range(epochs):
        if epoch >= epochs // 3 and epoch % max(2, epochs // 4) == 0:
            logit = net.logits(codes, net.of_words(distinct, {}), at)
        chosen, owner_of = [], []
        for i in fitted:
            a, b = first[i], last[i]
            chosen.append(a + int(np.argmax(logit[a:b])))
            owner_of.append(i)
            if not label[i] and b - a > 1:
                chosen.append(int(rng.integers(a, b)))
                owner_of.append(i)
        chosen, owner_of = np.array(chosen), np.array(owner_of)
        order = rng.permutation(len(chosen))
        for piece in np.array_split(order, max(1, len(order) // BATCH)):
            step += 1
            rows = padded[at[chosen[piece]]]
            used, back = np.unique(rows, return_inverse=True)
            back = back.reshape(rows.shape)
            if used[-1] == len(distinct):
                used = used[:-1]
            own = np.where(rows == len(distinct), len(used), back)
            words = [*distinct[used], ""]
            y = label[owner_of[piece]].astype(np.float32)
            grads = gradient(net, own, words, y)
            speed = rate * (1 if epoch < epochs * 2 // 3 else 0.3)
            for k, g in grads.items():
                g = g + (1e-4 * net.p[k] if k in ("words", "chars") else 0)
                m, v = adam[k]
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                net.p[k] -= (speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    logit = net.logits(codes, net.of_words(distinct, {}), at)
    worst = np.maximum.reduceat(logit, first)
    net.scale = calibrated(worst[checked], np.log(last - first)[checked], label[checked], weight[checked])
    return net


def calibrated(worst: np.ndarray, length: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """Logistic fit of the labels by the worst logit and the number of windows (ridge, Newton steps)."""
    x = np.stack([worst, np.ones_like(worst), length], axis=1).astype(np.float64)
    theta = np.array([1.0, 0.0, 0.0])
    prior = np.array([1.0, 0.0, 0.0])
    ridge = np.diag([0.5, 0.05, 2.0])
    def loss(theta):
        z = x @ theta
        return (weight * (np.logaddexp(0, z) - label * z)).sum() + (theta - prior) @ ridge @ (theta - prior) / 2

    for _ in range(25):
        q = sigmoid(x @ theta)
        slope = x.T @ (weight * (q - label)) + ridge @ (theta - prior)
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + ridge, slope)
        while loss(theta - step) > loss(theta) and np.abs(step).max() > 1e-9:
            step /= 2
        theta -= step
    return max(float(theta[0]), 0.05), float(theta[1]), float(theta[2])


def train(docs: DataFrame, labels: DataFrame) -> Network | float:
    """Fit on a bounded sample of labelled documents; a number if there are not both labels to learn from."""
    spark = docs.sparkSession
    short = texts(docs).filter(F.length("text") <= SAMPLE_CHARS)
    rows, totals = bounded_sample(labelled(labels, "toxic", 3, 1), SAMPLE_PER_CLASS)
    if len(totals) < 2:
        return float(next(iter(totals), 0.5))
    chosen = spark.createDataFrame(rows, "doc_id long, label int")
    got = short.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    label = got["label"].to_numpy().astype(np.float64)
    if len(set(label)) < 2:
        return float(label.mean()) if len(label) else 0.5
    share = {k: totals[k] / sum(totals.values()) for k in (0, 1)}
    weight = np.where(label == 1, share[1] / (label == 1).mean(), share[0] / (label == 0).mean())
    return fit(got["text"].to_pylist(), label, weight)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        net, memory = shared.value, {}
        for piece in slices(batches, most=2_000_000):
            score = np.full(piece.num_rows, net) if isinstance(net, float) else net.scores(piece.column("text").to_pylist(), memory)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    result = in_batches(texts(docs), run, "doc_id long, score double")
    return result.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

