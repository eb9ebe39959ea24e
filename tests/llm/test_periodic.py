"""Periodic runs against a plain search over all lags."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fiscoframe.llm import periodic, queries

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            end = i
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            start, length = i - q, end - i + q
            smaller = any(all(words[k] == words[k - p] for k in range(start + p, end)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                found.append((start, length, q))
            i = end
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 5, 30])) for _ in range(rng.randrange(90))]
    if words and rng.random() < 0.6:
        a = rng.randrange(len(words))
        p = rng.randrange(1, len(words) - a + 1)
        words[a:] = [words[a + i % p] for i in range(len(words) - a)]
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = 0
    return words


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(800):
        docs = [random_text(rng) for _ in range(rng.randrange(1, 5))]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = periodic.runs_of(np.array([w for d in docs for w in d], np.int64), offsets)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == [(s + offsets[i], n, q) for i, d in enumerate(docs) for s, n, q in plain_runs(d)]


def test_a_million_words_in_one_text():
    began = time.time()
    start, length, period = periodic.runs_of(np.arange(1_000_000) % 1000, np.array([0, 1_000_000]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [1_000_000], [1000]) and time.time() - began < 30


def test_op12_whole_documents(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet").set_index("doc_id")["text"].fillna("")
    got = queries.op12_periodic(spark, FOLDER).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index)
    for i, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = plain_runs(words)
        row = got.loc[i]
        assert row["n_runs"] == len(runs)
        if runs:
            s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
            assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == (s, n, q, 1000 * n // q)
        else:
            assert row[["start", "length", "period", "exponent_milli"]].isna().all()
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, 0), (1, None, 0), (2, "", 0), (None, "a a a a a a", 0), (3, " \t\n", 0), (4, "x\x00 x\x00\nx\x00\tx\x00 x\x00 x\x00 y", 0), (5, "é é " * 7 + "end", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumn("collapsed", F.lit(1))
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, [], ""), (1, [], ""), (2, [], ""), (None, [(0, 6, 1)], "a"), (3, [], ""), (4, [(0, 6, 1)], "x\x00 y"), (5, [(0, 7, 1)], "é é end")], key=str
    )
    assert periodic.periodic_runs(docs.limit(0)).collect() == []
    assert queries.with_repeats(docs).count() == len(rows)
