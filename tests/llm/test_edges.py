"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fiscoframe.llm import exact_dedup, html_text, licenses, mixing, near_dedup, pieces, quality, simhash, token_files, toxicity

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "word " * 30_000 + "end"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, slot long, size long, part int, `key` long, node long"
ROWS = [
    (5, None, None, None, None),
    (3, "", "en", "a", 0),
    (1, "one two three four five six", "en", "a", 27),
    (1, "one two three four five six", "en", "a", 27),
    (2, "one two  three four\tfive six", "en", None, 27),
    (None, "one two three four five six", "en", "b", 27),
    (None, None, None, None, None),
    (7, LONG, "en", "b", len(LONG)),
    (8, "   \n\t ", "en", "c", 6),
    (100, "MIT License. Ünï cödé 漢字 \U0001f600 \x00 mit license", "fr", "c", 40),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3, 4, 5) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (1, 1, 0), (8, 0, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "quality": lambda d, labels: quality.quality(d, labels),
    "exact": lambda d, labels: exact_dedup.exact_groups(d),
    "tokens": lambda d, labels: token_files.token_files(d, BYTES),
    "simhash": lambda d, labels: simhash.simhash_report(d),
    "pieces": lambda d, labels: pieces.encoded(d, PIECES),
    "mixing": lambda d, labels: mixing.mixture(d),
    "toxicity": lambda d, labels: toxicity.toxicity(d, labels),
    "near": lambda d, labels: near_dedup.near_classes(d),
    "licenses": lambda d, labels: licenses.license_scan(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(name, odd, labels):
    got = OPERATORS[name](odd, labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, none, labels):
    assert OPERATORS[name](none, labels).collect() == []


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_no_labels(name, odd, labels):
    assert {r["score"] for r in OPERATORS[name](odd, labels.limit(0)).collect()} == {0.5}


def test_exact_groups_of_odd_rows(odd):
    got = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.exact_groups(odd).collect()}
    digest = hashlib.sha256(b"one two three four five six").hexdigest()
    assert (got[1, digest]["keep_id"], got[1, digest]["group_size"], got[1, digest]["kept"]) == (1, 4, True)
    assert got[2, digest]["keep_id"] == 1 and not got[2, digest]["kept"]
    empty = hashlib.sha256(b"").hexdigest()
    assert got[5, empty]["keep_id"] == 3 and got[5, empty]["group_size"] == 3


def test_directory_splits_until_no_bucket_is_overfull(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key")
    slots, depth = exact_dedup.directory(keys, capacity=100)
    placed = keys.withColumn("slot", exact_dedup.slot_of(keys["key"], depth)).join(slots, "slot")
    assert slots.count() == 2**depth and placed.count() == 3000
    assert max(r["count"] for r in placed.groupBy("bucket").count().collect()) <= 100


def test_small_buckets_change_nothing(odd):
    wide, narrow = (sorted(map(str, exact_dedup.exact_groups(odd, c).collect())) for c in (50_000, 1))
    assert wide == narrow


def test_colliding_keys_are_told_apart_by_their_bytes():
    import pyarrow as pa

    rows = pa.RecordBatch.from_pydict({"bucket": ["0/0"] * 4, "key": [7, 7, 7, 9], "keep_id": [4, 2, 3, 1], "group_size": [1, 2, 1, 1], "text": ["x", "y", "x", "z"]})
    got = [r for b in exact_dedup.own(iter([rows])) for r in b.to_pylist()]
    assert [(r["key"], r["chain"], r["keep_id"], r["group_size"]) for r in got] == [(7, 0, 3, 2), (7, 1, 2, 2), (9, 0, 1, 1)]


def test_token_files_can_be_read_by_id(spark, odd, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(odd, folder, BYTES)
    got = token_files.read_tokens(spark, folder, [7])
    assert [r["n_tokens"] for r in got.collect()] == [len(got.collect()[0]["ids"])]
    assert "PushedFilters: [In(doc_id, [7])]" in got._jdf.queryExecution().executedPlan().toString() or "EqualTo(doc_id,7)" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a\n b\r\n\t c ", "x" * 500 + " y", "it's  \n\n 'll 12 3", " \n", "a  b", "<|endoftext|> end"])
def test_chunks_encode_like_the_whole_text(text):
    encoder = token_files.Encoder(BYTES)
    ids, counts = encoder.encode(pa.array([text, "again " + text]))
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids[: counts[0]].tolist() == [*whole, 0]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>\n\n<|endoftext|><|endoftext|> y.", "< |endoftext|> <|endoftext| >", "plain <| text |>."])
def test_added_tokens_encode_like_an_untouched_library(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    batch = ["first one", text, "", "then " + text, "last one."]
    ids, counts = token_files.Encoder(BYTES).encode(pa.array(batch))
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)] == [[*library.encode(t, add_special_tokens=False).ids, 0] for t in batch]


@pytest.mark.parametrize(
    "text",
    ["", " ", "   ", " " * 37 + "x", "a▁b ▁ c", "​z", "ab" * 300, "aaaaaaaaaaaaaaaa", "héllo wörld ﬁ①　", "1234567 89", "\U0001f600\U0001f601 á", "\x00\x01", "the  the   thethethe\n\n the", "don't...!!!---===", "\r\n\t x"],
)
def test_pieces_equal_the_library(text):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = pieces.Encoder(PIECES)
    ids, counts = encoder.encode([text, text + " " + text])
    assert ids[: counts[0]].tolist() == library.encode(text)
    assert ids[counts[0] :].tolist() == library.encode(text + " " + text)
    assert pieces.decode(encoder.v, ids, counts) == [library.decode(library.encode(t)) for t in (text, text + " " + text)]


def test_pieces_of_random_texts():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = np.random.default_rng(9)
    letters = list("aabcdeehinorst  '.,▁éß漢0")
    batch = ["".join(rng.choice(letters, rng.integers(0, 80))) for _ in range(300)]
    ids, counts = pieces.Encoder(PIECES).encode(batch)
    ends = np.cumsum(counts)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts, strict=True)] == [library.encode(t) for t in batch]


def test_decoding_any_ids():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    v = pieces.vocabulary(PIECES)
    for ids in ([3 + 0xE2, 3 + 0x91], [3 + 0xFF, 3 + 0x41, 3 + 0xC3, 3 + 0xA9], [28705, 28705, 264], [264, 3 + 0xE6, 3 + 0xBC, 3 + 0xA2]):
        assert pieces.decode(v, np.array(ids), np.array([len(ids)])) == [library.decode(ids)]


def expansions(pattern: str, rng) -> str:
    """A random text that a rule's expression matches."""
    from re import _parser

    def of(parsed) -> str:
        out = ""
        for op, value in parsed:
            kind = str(op)
            if kind == "LITERAL":
                out += chr(value)
            elif kind == "SUBPATTERN":
                out += of(value[-1])
            elif kind == "BRANCH":
                out += of(value[1][rng.integers(len(value[1]))])
            elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
                out += "".join(of(value[2]) for _ in range(rng.integers(value[0], min(int(value[1]), value[0] + 2) + 1)))
            elif kind == "IN":
                first = value[rng.integers(len(value))]
                out += {"LITERAL": lambda v: chr(v), "RANGE": lambda v: chr(v[0]), "CATEGORY": lambda v: "7"}[str(first[0])](first[1])
            else:
                raise AssertionError(kind)
        return out

    return of(_parser.parse(pattern))


def test_no_match_is_stopped_by_a_gate():
    from fiscoframe.llm.license_rules import rules

    rng = np.random.default_rng(5)
    for rule in rules():
        for _ in range(150):
            words = expansions(rule.pattern, rng)
            assert rule.keyword in words, (rule.name, words)
            assert any(g in words.replace(" ", "\n") for g in licenses.GATES), (rule.name, words)


def test_notices_over_line_ends(spark):
    texts = ["All rights\nreserved", "ALL RIGHTS  RESERVED.", "released into the public\n * domain", "Licence: MIT", "Expat License", "under PSF-2.0 licence"]
    got = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["labels"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["all-rights-reserved"] * 2 + ["public-domain", "mit", "mit", "psf-2.0"]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Home</li></ul></nav>
<div class="cookie-notice">We use cookies</div><main><article><h1>A &amp; B</h1><p>First  paragraph<br>goes on &lt;here&gt;.
<div class="ad-banner">Buy</div><p>Second <b>one</b><p hidden>secret</p><ul><li>item 1<li>item 2</ul><form>Name<input></form>
<script>var x = "</p><p>no</p>";</script><!-- <p>no</p> --></article><section id="comments"><p>Nice post</p></section></main><aside>Side</aside><footer>&copy; me</footer>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == "A & B\nFirst paragraph goes on <here>.\nSecond one\nitem 1\nitem 2"


def test_page_without_a_marked_article():
    body = "".join(f"<p>{'text ' * 40}{i}</p>" for i in range(5))
    page = f"<div class=menu>Menu</div><div>{body}</div><div>.</div><div></div><div></div><div></div><div></div><p>x</p><footer>end</footer>"
    assert html_text.main_text(page).count("\n") >= 4 and "Menu" not in html_text.main_text(page)


def test_short_parts_of_a_pretty_printed_page_stay():
    body = "\n".join(f"<p>\n{'text ' * 40}{i}\n</p>" for i in range(5))
    page = f"<body>\n<div>\n<h1>\nTitle\n</h1>\n</div>\n<div>\n<div class=body>\n<p>Lead</p>\n</div>\n</div>\n<div>\n<div>\n{body}\n</div>\n</div>\n<ul class=menu>\n<li>a\n<li>b\n<li>c\n</ul>\n<div>\n<p>\nEnd\n</p>\n</div>\n</body>"
    got = html_text.main_text(page).split("\n")
    assert (got[:2], got[-1], len(got)) == (["Title", "Lead"], "End", 8)
    assert html_text.main_text(page.replace("\n", "")).split("\n") == got


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div class='no-sidebar'", "div class='header-fixed'", "div class='page social-policy'", "div class='comments-open'", "div id=sidebar-left", "form action=x"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_wrappers_named_like_boilerplate(wrapper, inner):
    text = "<p>One long paragraph of the page.</p><p>Another long paragraph of the page.</p>"
    page = f"<nav>Home</nav><{wrapper}><div class=sidebar>Side</div><{inner}><h1>T</h1>{text}<div class='share-buttons'>Share</div></{inner}><div id=comments>Nice</div></{wrapper.split()[0]}><div class=site-footer>Me</div>"
    assert html_text.main_text(page) == "T\nOne long paragraph of the page.\nAnother long paragraph of the page."


@pytest.mark.parametrize("tag", ["div", "li", "span"])
def test_windows_decide_on_unmarked_pages(tag):
    body = [f"Paragraph {i} says {'one thing and another ' * 6}at length." for i in range(8)]
    shown = "".join(f"<div><h2>Part {i}</h2></div><div>{t}</div>" for i, t in enumerate(body))
    page = f"<{tag}>Home</{tag}><br><div>News</div><div><a href=x>Some linked story with a rather long title that goes on and on and on</a></div>{shown}<div>Copyright 2020</div><div>Terms</div>"
    assert html_text.main_text(page).split("\n") == [x for i, t in enumerate(body) for x in (f"Part {i}", t)]


@pytest.mark.parametrize(
    "page",
    ["<x " * 350_000, '<a "' * 260_000, "<a ' >" * 200_000, "<div>" * 200_000, "<div>" * 90_000 + "</p>" * 120_000, "<div class=ad>" * 70_000 + "<p>a" * 2000, "<!" * 500_000, "<" * 1_000_000, "<article>" * 100_000 + "x"],
)
def test_a_million_characters_of_markup(page):
    began = time.process_time()
    assert isinstance(html_text.main_text(page), str) and time.process_time() - began < 10


@pytest.mark.parametrize("page", ["", "no markup at all", "<", "<p", "<p>a<", "<!--", "<script>", "</p></div>", "<a href='>'>x</a>", "<p>" * 2000])
def test_odd_pages_do_not_crash(page):
    assert isinstance(html_text.main_text(page), str)


def test_odd_rows_of_pages(spark):
    rows = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>" + "long text " * 50_000), (2, None, "")], "page_id long, url string, html string")
    got = html_text.extract(rows).collect()
    assert len(got) == 4 and sorted(r["n_chars"] for r in got) == [0, 0, 0, 10 * 50_000 - 1]
    assert html_text.extract(rows.limit(0)).collect() == []


def test_targets_reshare_the_excess():
    got = mixing.targets([10, 100, 100], [5.0, 2.0, 1.0])
    assert got == pytest.approx([20, 295 / 3 * 2, 295 / 3]) and sum(got) == pytest.approx(315)
    assert mixing.targets([0, 0], [5.0, 2.0]) == [0, 0] and mixing.targets([], []) == []


def test_large_classes_are_ranked_in_chunks(spark, monkeypatch):
    rows = [(i, "one two three four", "abc"[min(2, i % 5)]) for i in range(400)] + [(1000 + i, "w " * (i % 37 + 1), "abc"[i % 3]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 25)
    got = mixing.mixture(docs).toPandas()
    assert len(got) == 700
    source = {r[0]: r[2] for r in rows}
    sums = got.assign(source=got["doc_id"].map(source)).groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((sums["target"] - sums["taken"]).abs() <= 40).all()


def test_large_groups_of_near_copies_are_one_class(spark):
    """Copies with one or two changed words, and a group that shares half of its words only."""
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(4000)]
    base = list(rng.choice(words, 200))
    rows = []
    for i in range(300):
        text = list(base)
        for at in rng.choice(200, 2, replace=False):
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text)))
    for i in range(300, 400):
        rows.append((i, " ".join([*base[:100], *rng.choice(words, 100)])))
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id").sort_index()
    assert (got.loc[:299, "class_id"] == 0).all()
    assert (got.loc[300:, "class_id"] == got.loc[300:].index).all()


def test_pairs_inside_a_family_just_below_the_threshold(spark, monkeypatch):
    """Most pairs of the family share buckets at about 0.72; forty pairs hold two changes together and reach 0.8."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(344)]
    places = rng.integers(4, 64, (400, 5))
    rows = []
    for i in range(400):
        text = list(base)
        for k in range(5):
            own = i % 40 if k < 2 and i < 80 else i
            text[68 * k + places[own, k]] = f"x{own}_{k}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"v{i}_{j}" for j in range(50))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    idf = near_dedup.damped_idf(*near_dedup.document_frequencies(docs))
    found, counts, offsets, _ = near_dedup.shingle_counts([t for _, t in rows[:400]])
    names, column = np.unique(found, return_inverse=True)
    weight = idf[(names >> np.uint64(64 - near_dedup.TABLE_BITS)).astype(np.int64)].astype(float)
    x = np.zeros((400, len(names)))
    x[np.repeat(np.arange(400), np.diff(offsets)), column] = counts
    both = (x * weight) @ x.T
    total = np.diag(both)
    alike = both / (total[:, None] + total - both)
    true = [(a, b) for a, b in zip(*np.nonzero(np.triu(alike >= near_dedup.THRESHOLD, 1)), strict=True)]
    assert 40 <= len(true) < 60 and np.median(alike) > 0.7
    label = {i: i for i in range(400)}
    for a, b in true:
        low, high = sorted((label[a], label[b]))
        label = {i: low if c == high else c for i, c in label.items()}
    monkeypatch.setattr(near_dedup, "RUN", 50)
    got = near_dedup.near_classes(docs).toPandas().set_index("doc_id")["class_id"]
    assert {i: got[i] for i in range(400)} == label


def test_texts_of_a_shared_id_are_not_lost(spark):
    rows = [(1, "x y z"), (2, "x y z"), (2, "unique text"), (3, "other"), (3, "other"), (None, "unique text"), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, exact_dedup.drop_exact(docs).collect())) == sorted(f"Row(doc_id={i}, text='{t}')" for i, t in [(1, "x y z"), (2, "unique text"), (3, "other"), (None, "alone")])
    near = sorted(map(tuple, near_dedup.drop_near(docs.filter("doc_id IS NOT NULL")).collect()))
    assert near == [(1, "x y z"), (2, "unique text"), (3, "other"), (3, "other")]
    got = near_dedup.near_classes(docs).filter("doc_id = 2").collect()
    assert sorted((r["class_id"], r["kept"]) for r in got) == [(1, False), (2, True)]


@pytest.mark.parametrize("n", [100, 1000, 10_000, 10**7])
def test_weights_have_no_step(n):
    table = np.zeros(1 << 12, np.int64)
    table[:200] = np.arange(200)
    weight = near_dedup.damped_idf(table, n)[1:200]
    assert weight[0] > 0.999 and (np.diff(weight) <= 0).all() and np.diff(weight).min() > -0.03


def test_encoder_memory_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5000)
    encoder, rng = token_files.Encoder(BYTES), np.random.default_rng(1)
    for _ in range(20):
        batch = [" ".join(f"w{i}{'x' * int(i % 30)}" for i in rng.integers(0, 500, 40)) for _ in range(5)]
        ids, counts = encoder.encode(pa.array(batch))
        expected = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in batch]
        assert ids.tolist() == [i for x in expected for i in x] and counts.tolist() == [len(x) for x in expected]
        assert encoder.memory.taken < 2500 + 200 * (token_files.ENTRY + 100)


def test_stages_keep_odd_rows_and_columns(odd, labels):
    near, exact = near_dedup.drop_near(odd), exact_dedup.drop_exact(odd)
    assert near.columns == exact.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in exact.collect()) == ["1", "100", "3", "7", "8"]
    assert "2" not in [str(r["doc_id"]) for r in near.collect()]
    assert mixing.mixed(odd).columns == quality.keep_good(odd, labels).columns == odd.columns
