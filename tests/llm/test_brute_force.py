"""Every operator against a plain version over whole tables."""

from __future__ import annotations

import collections
import hashlib
import html
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from fiscoframe.llm import queries

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    rows = pd.read_parquet(f"{FOLDER}/documents.parquet").set_index("doc_id")
    rows["text"] = rows["text"].fillna("")
    return rows


def result(spark, name, key="doc_id"):
    return queries.QUERIES[name](spark, FOLDER).toPandas().set_index(key).sort_index()


def test_op1_scores_all_documents(spark, documents):
    got = result(spark, "op1_quality")
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet").set_index("doc_id")
    assert set(got.index) == set(documents.index) and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    both = got.join(labels, how="inner")
    assert (both["predicted"] == both["quality"]).mean() > 0.9


def test_factorisation_machine_identity():
    """The linear-time form equals the sum over all pairs."""
    from fiscoframe.llm.quality import BUCKETS, DENSE, FACTORS, LEVELS, Machine, features

    rng = np.random.default_rng(1)
    size = BUCKETS + DENSE + 3 * LEVELS
    machine = Machine(0.3, rng.normal(0, 1, size), rng.normal(0, 1, (size, FACTORS)), np.zeros(DENSE), np.ones(DENSE))
    x = features(["One two TWO three!!\nfour", ""])
    value = machine.scaled(x)
    for d in range(2):
        own = slice(x.offsets[d], x.offsets[d + 1])
        index, v = x.index[own], value[own]
        pairs = sum(machine.factors[index[i]] @ machine.factors[index[j]] * v[i] * v[j] for i in range(len(v)) for j in range(i))
        assert machine.logits(x)[d] == pytest.approx(0.3 + machine.linear[index] @ v + pairs, rel=1e-5, abs=1e-5)


def test_op2_groups(spark, documents):
    got = result(spark, "op2_exact_dedup")
    groups = collections.defaultdict(list)
    for i, t in documents["text"].items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    assert len(got) == len(documents)
    for text, ids in groups.items():
        for i in ids:
            row = got.loc[i]
            assert (row["keep_id"], row["group_size"], row["kept"]) == (min(ids), len(ids), i == min(ids))
            assert row["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op3_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = result(spark, "op3_token_files"), 0
    assert len(got) == len(documents)
    for i in sorted(documents.index):
        ids = [*tokenizer.encode(documents["text"][i], add_special_tokens=False).ids, 0]
        assert tuple(got.loc[i][["start", "n_tokens", "ids_crc32"]]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op4_edits_and_likeness(spark, documents):
    got = result(spark, "op4_fingerprints")
    ids = sorted(documents.index, reverse=True)
    assert len(got) == len(documents)
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        text, third = documents["text"][a], len(documents["text"][a]) // 3
        edited = text[: len(text) - third] + documents["text"][b][:third]
        assert got.loc[a]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got.loc[a]["n_chars"] == len(text)
    assert got.groupby(documents["text"])["fingerprint"].nunique().max() == 1
    assert got["near_edited"].mean() > 0.5 > got["near_next"].mean()
    assert got["n_within_radius"].notna().sum() == sum(i % 100 == 0 for i in ids)


def test_block_tables_find_all_within_radius(spark):
    """Pairs at most three bits apart, against all pairs; copies make no pairs of their own."""
    from fiscoframe.llm.simhash import within_radius

    rng = np.random.default_rng(3)
    base = [int.from_bytes(rng.bytes(16), "big") for _ in range(12)]
    values = list(base)
    for b in base:
        for flips in (1, 2, 3, 4, 6):
            x = b
            for bit in rng.choice(128, flips, replace=False):
                x ^= 1 << int(bit)
            values.append(x)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    split = lambda x: (signed(x >> 64), signed(x & (1 << 64) - 1))
    rows = spark.createDataFrame([split(v) for v in values + values[:5]], "high long, low long")
    got = within_radius(rows, rows).collect()
    expected = {(split(a), split(b)) for a in values for b in values if (a ^ b).bit_count() <= 3}
    assert len(got) == len(expected)
    assert {((r[0], r[1]), (r[2], r[3])) for r in got} == expected


def test_op5_equals_the_library(spark, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = result(spark, "op5_pieces")
    assert len(got) == len(documents)
    for i, text in documents["text"].items():
        ids = library.encode(text)
        expected = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert tuple(got.loc[i][["n_tokens", "ids_sha256", "decoded_sha256"]]) == expected


def test_op6_keeps_the_article(spark):
    got = result(spark, "op6_html_text", "page_id")
    pages = pd.read_parquet(f"{FOLDER}/pages.parquet").set_index("page_id")
    assert len(got) == len(pages)
    for i, page in pages["html"].items():
        body = page.split("<article>")[1].split("</article>")[0] if "<article>" in page else ""
        blocks = re.split(r"</?(?:p|h1|h2|li|div|article)[^>]*>", body)
        clean = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
        assert got["text"][i] == "\n".join(b for b in clean if b)
        assert got["n_chars"][i] == len(got["text"][i])


def test_op7_meets_its_targets(spark, documents):
    got = result(spark, "op7_mixing").join(documents[["text", "source"]])
    assert len(got) == len(documents)
    assert (got["size"] == [len(WORD.findall(t)) for t in got["text"]]).all()
    assert (got["taken"] <= 2 * got["size"]).all()
    assert (got["taken"] % got["size"].clip(lower=1) == 0).all()
    sums = got.groupby("source").agg(size=("size", "sum"), stated=("source_size", "first"), target=("target", "first"), taken=("taken", "sum")).sort_index()
    assert (sums["size"] == sums["stated"]).all()
    target, left, open_ = {}, 1.5 * sums["size"].sum(), {s: (5, 2, 1)[k % 3] for k, s in enumerate(sums.index)}
    while True:
        over = [s for s, w in open_.items() if left * w / sum(open_.values()) > 2 * sums["size"][s]]
        if not over:
            target |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        for s in over:
            target[s] = 2.0 * sums["size"][s]
            left -= target[s]
            del open_[s]
    assert np.allclose(sums["target"], [target[s] for s in sums.index])
    assert ((sums["taken"] - sums["target"]).abs() <= np.maximum(60, 0.02 * sums["target"])).all()
    again = result(spark, "op7_mixing")
    assert (again.sort_index()["taken"] == got.sort_index()["taken"]).all()


def test_op8_gradient_is_right():
    """Back-propagation against differences of the loss."""
    from fiscoframe.llm import toxicity

    net = toxicity.fresh({"bad": 1, "word": 2}, 5)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = ["a", "bad", "word", "other", ""]
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 4, (3, toxicity.SPAN))
    codes[1, 10:] = 4
    label = np.array([1.0, 0.0, 1.0])

    def loss():
        z = net.run(codes, net.gates(net.inputs(words)[0]), 4).astype(np.float64)
        return float((np.logaddexp(0, z) - label * z).mean())

    slopes = toxicity.gradient(net, codes, words, label)
    for name, place in (("Uf", (3, 2)), ("Ub", (20, 1)), ("Wf", (9, 4)), ("Wb", (17, 13)), ("bf", (5,)), ("Wa", (2, 9)), ("va", (3,)), ("wo", (4,)), ("words", (1, 3))):
        old = net.p[name][place]
        values = []
        for change in (2e-2, -2e-2):
            net.p[name][place] = old + change
            values.append(loss())
        net.p[name][place] = old
        assert slopes[name][place] == pytest.approx((values[0] - values[1]) / 4e-2, rel=0.08, abs=3e-5), name


def test_op8_scores_all_documents(spark, documents):
    got = result(spark, "op8_toxicity")
    assert set(got.index) == set(documents.index) and got["score"].between(0, 1).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index]).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()


def test_op8_learns_words_and_word_parts():
    """Held-out documents with unseen forms of toxic words are found, clean ones left alone."""
    from fiscoframe.llm import toxicity

    rng = np.random.default_rng(0)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmno"), rng.integers(2, 7))) for _ in range(400)]

    def text(toxic):
        words = list(rng.choice(vocabulary, rng.integers(5, 120)))
        if toxic:
            for _ in range(2):
                words.insert(int(rng.integers(0, len(words))), "zxqv" + str(rng.choice(vocabulary)))
        return " ".join(words)

    label = np.array([i % 4 == 0 for i in range(600)], dtype=float)
    batch = [text(y) for y in label]
    net = toxicity.fit(batch[:450], label[:450], np.ones(450))
    score = net.scores(batch[450:])
    assert ((score >= 0.7) == (label[450:] == 1)).mean() > 0.95


def shingles(text):
    words = text.split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(texts, weights=None):
    """Classes by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_op9_classes(spark, documents):
    got = result(spark, "op9_near_dedup")
    assert len(got) == len(documents)
    expected = brute_classes(documents["text"].to_dict())
    assert got["class_id"].to_dict() == expected
    assert (got["kept"] == (got.index == got["class_id"])).all()
    assert (got["class_size"] == got["class_id"].map(got["class_id"].value_counts())).all()


def test_weighted_samples_agree_like_weighted_jaccard():
    from fiscoframe.llm.near_dedup import Sampler, weighted_jaccard

    rng = np.random.default_rng(4)
    keys = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = np.sort(keys[:2000]), np.sort(keys[400:2400])
    weight = {int(k): 1 + int(k) % 3 for k in keys}
    w_a, w_b = (np.array([weight[int(k)] for k in x], np.float32) for x in (a, b))
    w_b = w_b * np.where(np.arange(len(b)) % 5 == 0, 2, 1).astype(np.float32)
    drawn = [Sampler().samples(x, w, np.array([0, len(x)]))[0] for x, w in ((a, w_a), (b, w_b))]
    assert (drawn[0] == drawn[1]).mean() == pytest.approx(weighted_jaccard((a, w_a), (b, w_b)), abs=0.17)
    assert (Sampler().samples(a, w_a, np.array([0, len(a)]))[0] == drawn[0]).all()


def test_op10_base_and_labels(spark, documents):
    got = result(spark, "op10_licenses")
    assert len(got) == len(documents)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in documents["text"].items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(lower))
        places, labels = [], set()
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            p = phrase.split()
            found = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        row = got.loc[i]
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(words), len(places), ",".join(sorted(labels)))
        if places:
            assert (row["first_word"], row["last_word"]) == (min(places), max(places))
        assert labels <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_license_rules_against_python(spark):
    """All detections and their suppression, by Python's regular expressions."""
    from fiscoframe.llm.license_rules import rules
    from fiscoframe.llm.licenses import license_scan

    texts = [
        "SPDX-License-Identifier: Apache-2.0 and more",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This is released under the terms of the GNU Lesser General Public License version 2.1. MIT License; MIT license.",
        "Creative Commons Attribution 4.0 International License, all rights reserved. The Unlicense! CC0 1.0 Universal",
        "no terms at all", "",
        "GNU General Public License version 3, or (at your option) any later version. See the Mozilla Public License 2.0",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan(frame).collect()}
    assert len(rules()) > 200
    for i, text in enumerate(texts):
        words = " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())) + " "
        found = [(m.start(), m.end(), r.priority, r.name, r.label) for r in rules() if r.keyword in words for m in re.finditer(f" {r.pattern}(?= )", words)]
        stays = [
            d
            for d in found
            if not any(e[0] <= d[0] and e[1] >= d[1] and (e[2] > d[2] or e[2] == d[2] and (e[1] - e[0] > d[1] - d[0] or e[:2] == d[:2] and e[3] < d[3])) for e in found)
        ]
        base = set(filter(None, got[i]["base_labels"].split(",")))
        assert got[i]["labels"] == ",".join(sorted(base | {d[4] for d in stays}))
        assert got[i]["n_detections"] == len(stays)


def test_pipeline_stages(spark, tmp_path):
    """Each stage against a plain version of its decision."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.toPandas()
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        after = docs.toPandas()
        assert name == "encoding" or docs.columns == columns
        if name == "quality":
            labels = pd.read_parquet(f"{FOLDER}/labels.parquet").set_index("doc_id")["quality"]
            kept = before["doc_id"].isin(after["doc_id"])
            known = before["doc_id"].map(labels)
            assert kept[known == 1].mean() > 0.97 and kept[known == 0].mean() < 0.3
        elif name == "exact_dedup":
            plain = before["text"].map(lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t))
            assert set(after["doc_id"]) == set(before.groupby(plain)["doc_id"].min())
        elif name == "near_dedup":
            classes = brute_classes(before.set_index("doc_id")["text"].to_dict())
            assert set(after["doc_id"]) == set(classes.values())
        elif name == "mixing":
            times = after["doc_id"].value_counts()
            assert times.max() <= 2 and set(after["doc_id"]) <= set(before["doc_id"])
            words = lambda frame: frame["text"].map(lambda t: len(WORD.findall(t))).sum()
            assert words(after) == pytest.approx(1.5 * words(before), rel=0.02)
        else:
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            assert len(after) == len(before)
            text = before.drop_duplicates("doc_id").set_index("doc_id")["text"]
            for row in after.itertuples():
                assert list(row.ids) == library.encode(text[row.doc_id])
