from __future__ import annotations

import hashlib
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fiscoframe.functions import text
from fiscoframe.functions.keys import is_valid_cnpj, item_key, sanitize_cnpj, set_key
from fiscoframe.schemas import ITEM_KEY_FIELDS


def fold(value, form, drop):
    return "".join(c for c in unicodedata.normalize(form, value) if not drop(c))


def expected_normal(value):
    return fold(value, "NFD", lambda c: unicodedata.category(c) == "Mn").upper().strip()


def expected_search(value):
    plain = fold(value, "NFKD", unicodedata.combining).upper()
    words = re.sub(r"[^A-Z0-9\s]", " ", plain).split()
    return " ".join(w for w in words if w not in text.STOP_WORDS)


SAMPLES = [
    "  Açúcar  cristal\t1kg ",
    "CERVEJA Pilsen Nº 1 ½ litro ™",
    "ﬁletão de peixe",
    "A AS O OS CASA DE A O",
    "",
    " água tônica\u0085",
    "straße 12",
    "Ａｂｃ ㎏",
]


def column(spark, values, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *expressions).orderBy("i").collect()]


def test_normalize_matches_definition(spark):
    got = column(spark, SAMPLES, text.normalize(F.col("t")), text.normalize_description(F.col("t"), False))
    assert [g[0] for g in got] == [expected_normal(v) for v in SAMPLES]
    assert [g[1] for g in got] == [" ".join(expected_normal(v).split()) for v in SAMPLES]


def test_search_text_matches_definition(spark):
    got = column(spark, SAMPLES, text.search_text(F.col("t")))
    assert [g[0] for g in got] == [expected_search(v) for v in SAMPLES]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=50, max_size=80))
def test_text_properties(spark, values):
    exact = text.normalize(F.col("t"))
    got = column(spark, values, exact, text.search_text(F.col("t")))
    assert [g[0] for g in got] == [expected_normal(v) for v in values]
    assert [g[1] for g in got] == [expected_search(v) for v in values]


def test_codes(spark):
    values = ["000", "00.12", " 0ç7", None, "", "A0"]
    got = column(spark, values, text.normalize_code(F.col("t")), text.remove_dots(F.col("t")))
    assert [g[0] for g in got] == ["0", ".12", "C7", None, "0", "A0"]
    assert [g[1] for g in got] == ["000", "0012", "0C7", None, "", "A0"]


def test_natural_order(spark):
    values = ["B1", "a10", "-x", "9", "a9", "10", "007", "7", "9" * 44]
    df = spark.createDataFrame([(v,) for v in values], "t string").orderBy(text.natural_key(F.col("t")), "t")
    assert [r.t for r in df.collect()] == ["007", "7", "9", "10", "9" * 44, "-x", "a9", "a10", "B1"]


def test_item_key_and_set_key(spark):
    row = {"codigo": " a1 ", "descricao": "Café", "ncm": None}
    df = spark.createDataFrame(
        [(row["codigo"], row["descricao"], None, None, None, None, None, ["b", "a"])],
        ", ".join(f"{f} string" for f in ITEM_KEY_FIELDS) + ", l array<string>",
    )
    key, joined = df.select(item_key(), set_key(F.col("l"))).first()
    assert key == hashlib.md5("A1|CAFÉ|||||".encode()).hexdigest()
    assert joined == hashlib.md5(b"ab").hexdigest()


def test_taxpayer_ids(spark):
    values = ["11.222.333/0001-81", "11222333000180", "11111111111111", "123", None, "37671507000187"]
    got = column(spark, values, is_valid_cnpj(F.col("t")), sanitize_cnpj(F.col("t")))
    assert [g[0] for g in got] == [True, False, False, False, False, True]
    assert [g[1] for g in got] == ["11222333000181", "11222333000180", "11111111111111", None, None, "37671507000187"]
