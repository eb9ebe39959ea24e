"""Language identification: the network against a plain one, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from fiscoframe.llm import langid, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def network():
    rng = np.random.default_rng(3)
    windows = rng.integers(97, 105, (200, langid.WINDOW)).astype(np.uint8)
    label = rng.integers(0, 3, 200)
    windows[label == 1, 10:40] = 200
    return langid.fit(windows, label, ["a", "b", "c"]), windows, label


def plain_logits(net, window):
    inputs = []
    for width in langid.WIDTHS:
        best = np.full(langid.FILTERS, -np.inf)
        for at in range(langid.WINDOW - width + 1):
            best = np.maximum(best, sum(net.p["bytes"][window[at + j]] @ net.p[f"w{width}"][j] for j in range(width)))
        inputs.append(np.maximum(best + net.p[f"b{width}"], 0))
    return np.concatenate(inputs) @ net.p["v"] + net.p["c"]


def test_lookup_tables_give_the_network(network):
    net, windows, _ = network
    got = net.probabilities(windows[:9], net.tables())
    expected = langid.softmax(np.stack([plain_logits(net, w) for w in windows[:9]]))
    assert np.allclose(got, expected, atol=1e-4)


def test_gradient_against_differences(network):
    net, windows, label = network
    net = langid.Network(net.languages, {k: v.astype(np.float64) for k, v in net.p.items()})

    def loss():
        z = np.stack([plain_logits(net, w) for w in windows[:6]])
        return -np.log(langid.softmax(z)[np.arange(6), label[:6]]).mean()

    grads = langid.gradient(net, windows[:6], label[:6])
    for name, at in (("v", (3, 1)), ("c", (2,)), ("w2", (1, 2, 3)), ("w4", (0, 5, 1)), ("b3", (2,)), ("bytes", (200, 4))):
        kept = net.p[name][at]
        net.p[name][at] = kept + 1e-5
        up = loss()
        net.p[name][at] = kept - 1e-5
        down = loss()
        net.p[name][at] = kept
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_windows_cover_whole_texts():
    texts = ["", "short", "x" * 96, "y" * 97, "é" * 500]
    rows, counts = langid.cut(pa.array(texts))
    assert counts.tolist() == [1, 1, 1, 2, 11] and not rows[0].any() and bytes(rows[1][:6]) == b"short\0"
    end = np.cumsum(counts)
    for text, b, n in zip(texts, end, counts, strict=True):
        starts = langid.window_starts(len(text.encode()))
        assert b"".join(bytes(r[: s2 - s1]) for r, s1, s2 in zip(rows[b - n : b], starts, [*starts[1:], len(text.encode())], strict=True)) == text.encode()


def test_op13_held_out_accuracy(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet").set_index("doc_id")
    got = queries.op13_language(spark, FOLDER).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index) and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()
    both = got.join(docs[["lang"]])
    assert (both["lang"] == both["lang_pred"])[both["held_out"]].mean() > 0.97
    assert both["score"].mean() > 0.9


ROWS = [
    (1, "the cat and the dog", "en"),
    (1, "the cat and the dog", "en"),
    (3, "der Hund und die Katze " * 400, "de"),
    (None, "the end of it all", "en"),
    (4, None, "de"),
    (5, "", "en"),
    (6, "12 34 --- 56 \U0001f600", "de"),
    (7, "der", None),
    (8, "漢字", "en"),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*r, 0.5, "x", 1) for r in ROWS], "doc_id long, text string, lang string, score double, lang_pred string, n_bytes int")
    got = langid.languages(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    named = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert all(named[i] == ("und", 0.0) for i in (4, 5, 6)) and all(named[i][0] in ("en", "de") for i in (1, 3, None, 7, 8))
    assert langid.languages(docs.limit(0)).collect() == []
    unnamed = langid.languages(docs.withColumn("lang", docs["lang"].substr(9, 1)).selectExpr("doc_id", "text", "nullif(lang, '') AS lang")).collect()
    assert {(r["lang_pred"], r["score"]) for r in unnamed} == {("und", 0.0)}
