"""Large amounts, plans that reach the scan, and the layout of stored tables."""

from __future__ import annotations

import unicodedata

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from fiscoframe.functions import labels as lb
from fiscoframe.functions import text
from fiscoframe.functions.xml import invoice_items
from fiscoframe.operators.aggregates import conditional_sum
from fiscoframe.operators.paging import page_total
from fiscoframe.operators.predicates import Condition, apply_filters
from fiscoframe.operators.sets import union_widened
from fiscoframe.operators.versioning import all_versions
from fiscoframe.plans import units
from fiscoframe.plans.catalogue import CATALOGUE
from fiscoframe.plans.parameters import Params
from fiscoframe.schemas import MEASURE, conform, measure
from fiscoframe.sources import sinks

PARAMS = Params(cut_off="2000-06-30", start="1996-01-01", end="1999-12-31", today="2001-12-31")


def test_amounts_are_neither_cut_nor_lost(spark):
    rows = spark.createDataFrame([("2500000000000",), ("7.1234567",), ("x",), (None,), ("NaN",)], "v string")
    got = [float(r[0]) for r in rows.select(measure(F.col("v"))).collect()]
    assert got == [2.5e12, 7.1234567, 0, 0, 0]
    total = rows.select(F.sum(measure(F.col("v")) * F.lit(1)).alias("s")).first()["s"]
    assert float(total) == 2500000000007.1234567
    assert [r[0] for r in conform(rows, {"v": MEASURE}).collect()][2:] == [None, None, None]
    mixed = rows.select(F.lit("1102").alias("code"), F.lit(2.5e12).alias("v"))
    assert float(mixed.agg(conditional_sum(F.col("code"), ["1102"], F.col("v")).alias("s")).first()["s"]) == 12.5e12


@pytest.mark.parametrize("value", ["1e30", 1e30])
def test_an_amount_out_of_range_raises(spark, value):
    rows = spark.createDataFrame([(value,)], f"v {'string' if isinstance(value, str) else 'double'}")
    for column in (rows.select(measure(F.col("v"))), conform(rows, {"v": MEASURE})):
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range"):
            column.collect()


TYPES = "s string, i int, b bigint, d decimal(9,2), f double"
VALUES = [("15", 15, 15, "15.00", 15.0), ("015", 16, -3, "15.01", 14.5), (None, None, None, None, None), ("", 0, 1 << 40, "-0.50", -2.0), ("a", 7, 0, "0.00", 1e300)]


@pytest.mark.parametrize("operator", ["igual", ">", ">=", "<", "<="])
@pytest.mark.parametrize("value", ["15", "15.00", "15,005", "-0.50", "015", "1e2", "a", "99999999999999", "nan", "-3", "0", "1099511627776", "+15"])
def test_typed_conditions_equal_the_text_form(spark, operator, value):
    rows = spark.createDataFrame(VALUES, TYPES.replace("decimal(9,2)", "string")).withColumn("d", F.col("d").cast("decimal(9,2)"))
    for name in "sibdf":
        cell = F.col(name)
        try:
            number = float(value.replace(",", "."))
        except ValueError:
            number = None
        if operator == "igual" or number is None:
            expected = F.coalesce(cell.cast("string"), F.lit("")) == value
        else:
            other = cell.try_cast("double")
            expected = {">": other > number, ">=": other >= number, "<": other < number, "<=": other <= number}[operator]
        assert apply_filters(rows, [Condition(name, operator, value)]).exceptAll(rows.where(expected)).count() == 0
        assert rows.where(expected).exceptAll(apply_filters(rows, [Condition(name, operator, value)])).count() == 0


@pytest.mark.parametrize(
    ("column", "operator", "value", "pushed"),
    [
        ("p_name", "igual", "x", "EqualTo(p_name,x)"),
        ("p_size", "igual", "15", "EqualTo(p_size,15)"),
        ("p_size", ">", "10,5", "GreaterThan(p_size,10)"),
        ("amount", "<=", "10.5", "LessThanOrEqual(amount,10.50)"),
    ],
)
def test_conditions_reach_the_scan(spark, tmp_path, column, operator, value, pushed):
    path = str(tmp_path / "part")
    part = spark.read.parquet(f"{SMALL}/part.parquet")
    part.withColumn("amount", F.col("p_size").cast("decimal(9,2)")).write.parquet(path)
    assert pushed in plan_of(apply_filters(spark.read.parquet(path), [Condition(column, operator, value)]))


def test_page_total_is_a_frame(spark):
    rows = spark.range(10).toDF("x")
    assert page_total(rows, [Condition("x", ">", "100")]).collect() == [(0,)]
    assert page_total(rows, [Condition("x", ">=", "4")]).collect() == [(6,)]


def test_widening_keeps_numbers_and_moments(spark):
    a = spark.sql("SELECT CAST(1.25 AS DECIMAL(9,2)) AS x, DATE '2024-01-02' AS d, 1 AS n, 'a' AS t, CAST(1 AS DECIMAL(5,1)) AS q")
    b = spark.sql("SELECT 2.5D AS x, TIMESTAMP '2024-01-02 03:04:05' AS d, 3L AS n, 7 AS t, CAST(2.123 AS DECIMAL(9,3)) AS q")
    out = union_widened([a, b])
    assert dict(out.dtypes) == {"x": "double", "d": "timestamp", "n": "bigint", "t": "string", "q": "decimal(9,3)"}
    assert sorted(r["x"] for r in out.collect()) == [1.25, 2.5]


def test_versions_need_one_shuffle(spark):
    files = spark.createDataFrame([("1", "2024-01-01", "2024-02-01 10:00:00", 5)], "cnpj string, dt_ini string, data_entrega string, reg_0000_id int")
    files = files.withColumns({"dt_ini": F.col("dt_ini").cast("date"), "data_entrega": F.col("data_entrega").cast("timestamp")})
    assert plan_of(all_versions(files, "2024-12-31")).count("Exchange hashpartitioning") == 1


def test_omitted_documents_plan_one_anti_join(tables):
    plan = plan_of(CATALOGUE["omissao_saidas"].run(tables, PARAMS))
    assert plan.count("LeftAnti") == 1


def test_conversion_factors_read_their_base_once(spark):
    base = spark.range(3).select(
        F.lit("1").alias("cnpj"), F.lit("p").alias("chave_produto"), F.concat(F.lit("u"), "id").alias("unidade"), F.lit("u1").alias("unid_padrao"),
        F.col("id").cast("double").alias("preco_medio_entrada"), F.lit(1.0).alias("preco_medio_saida"), F.col("id").cast("double").alias("volume_total"), F.lit("d").alias("descricao_longa"),
    )
    found = units.with_reference(base)
    assert plan_of(found).count("Range (") == 1 and plan_of(found).count("Exchange") == 1
    assert {r["unid_ref"] for r in found.collect()} == {"u1"} and {r["__units"] for r in found.collect()} == {3}


def test_ten_thousand_taxpayers_make_few_files(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(40_000).select((F.col("id") % 10_000).cast("string").alias("cnpj"), "id")
    sinks.write_table(rows, path)
    files = [f for f in (tmp_path / "table").rglob("*.parquet")]
    assert len(files) <= 4 * sinks.table_layout(spark, path)["buckets"]
    one = sinks.read_table(spark, path, "77")
    assert sorted(r["id"] for r in one.collect()) == [77, 10_077, 20_077, 30_077] and one.columns == ["cnpj", "id"]
    assert "PartitionFilters: [isnotnull(key_bucket" in plan_of(one)
    sinks.write_table(rows.where("cnpj = '77'").withColumn("id", -F.col("id")), path)
    assert sinks.read_table(spark, path).count() == 40_000
    assert sinks.read_table(spark, path, "77").agg(F.max("id")).first()[0] == -77


def test_expanding_characters_fold_natively(spark):
    samples = ["한국어 각 가", "ﬁn ½ ㎏ ǆ", "ﷺ", "Ǆ ĳ", "ẛ̣", "각" * 50, "à la ﬀ", "plain"]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, t string")
    for form, marks in (("NFD", lambda c: unicodedata.category(c) == "Mn"), ("NFKD", unicodedata.combining)):
        got = rows.select("i", text.strip_accents(F.col("t"), form).alias("v")).orderBy("i").collect()
        assert [r["v"] for r in got] == ["".join(c for c in unicodedata.normalize(form, s) if not marks(c)) for s in samples]
        assert "Python" not in plan_of(rows.select(text.strip_accents(F.col("t"), form)))


def test_all_hangul_syllables(spark):
    rows = spark.range(0xAC00, 0xD7A4).select("id", F.decode(F.encode(F.lit(""), "UTF-8"), "UTF-8").alias("t"))
    syllables = spark.createDataFrame([(i, chr(i)) for i in range(0xAC00, 0xD7A4, 7)], "id long, t string")
    assert rows.count() == 11172
    for r in syllables.select("id", text.strip_accents(F.col("t")).alias("v")).collect():
        assert r["v"] == unicodedata.normalize("NFD", chr(r["id"]))


def test_code_page_is_read_like_a_conversion(spark):
    samples = ["Situação “€”", "plain", "ÿ"]
    rows = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in rows.select(text.read_as_windows_1252(F.col("t"))).collect()]
    assert got == [s.encode().decode("cp1252", "replace") for s in samples]


def test_prefixed_items_are_found(spark):
    xml = '<n:nfe xmlns:n="u"><n:det nItem="2"><n:prod><n:cProd>A</n:cProd></n:prod><n:imposto><n:ICMS><n:ICMS60><n:vBCST>5.5</n:vBCST></n:ICMS60></n:ICMS></n:imposto></n:det></n:nfe>'
    rows = spark.createDataFrame([("k", xml)], "k string, xml string")
    got = invoice_items(rows, "xml", "k").collect()
    assert [(r["k"], r["prod_nitem"], r["prod_cprod"], r["icms_vbcst"]) for r in got] == [("k", 2, "A", 5.5)]


def test_merge_takes_a_normalised_description(spark):
    from fiscoframe.plans.merge import apply_merge

    rows = spark.createDataFrame(
        [("1", f"p{i}", f"Item {i}", [f"k{i}"], [f"c{i}"], ["1"], 1e12, 2.0) for i in range(3)],
        "cnpj string, chave_produto string, descricao string, lista_chave_item_individualizado array<string>, lista_codigos array<string>, lista_ncm array<string>, total_entradas double, total_saidas double",
    ).withColumn("descricao_normalizada", F.upper("descricao"))
    chosen = spark.createDataFrame([("1", "g", "p0", "New", "NEW NAME "), ("1", "g", "p1", None, None)], "cnpj string, grupo string, chave_produto string, descricao_resultante string, descricao_normalizada_resultante string")
    changed, _ = apply_merge(rows, chosen)
    merged = {r["descricao"]: r for r in changed.collect()}
    assert merged["New"]["descricao_normalizada"] == "NEW NAME" and merged["New"]["total_entradas"] == 2e12
    assert set(merged) == {"New", "Item 2"}


def test_pendency_labels_as_literals():
    """Written out from the description of the codes, not taken from the library."""
    assert lb.PENDENCY_STATUS["0"] == "0 - pendente"
    assert lb.PENDENCY_STATUS["2"] == "2 - resolvido"
    assert lb.PENDENCY_STATUS["4"] == "4 - pendente indeferido"
    assert lb.PENDENCY_STATUS["7"] == "7 - deferido automaticamente"
