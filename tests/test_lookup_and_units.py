from __future__ import annotations

from datetime import date

import pytest

from fiscoframe.functions import tax
from fiscoframe.operators.lookup import ClassificationTables, classify, classify_goods
from fiscoframe.plans import units
from fiscoframe.sources.readers import import_factors, read_manual_factors
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def references(spark):
    frame = spark.createDataFrame
    both = frame(
        [("12345678", "1234567", "sefin_cest_ncm_1"), ("87654321", "7654321", "sefin_cest_ncm_2")],
        "it_nu_ncm string, it_nu_cest string, it_co_sefin string",
    )
    cest = frame([("1234567", "sefin_cest_1"), ("9999999", "sefin_cest_2")], "cest string, `co-sefin` string")
    ncm = frame([("12345678", "sefin_ncm_1"), ("88888888", "sefin_ncm_2")], "ncm string, `co-sefin` string")
    names = frame(
        [
            ("sefin_cest_ncm_1", "Produto CEST NCM 1"),
            ("sefin_cest_2", "Produto CEST 2"),
            ("sefin_ncm_2", "Produto NCM 2"),
            ("sefin_adicional_1", "Produto Adicional 1"),
        ],
        "it_co_sefin string, it_no_produto string",
    )
    dated = frame(
        [
            ("sefin_cest_ncm_1", "20230101", "", 18.0, "S", 40.0),
            ("sefin_adicional_1", "20220101", "20230531", 17.0, "S", 50.0),
            ("sefin_adicional_1", "20230601", " ", 17.0, "S", 60.0),
        ],
        "it_co_sefin string, it_da_inicio string, it_da_final string, it_pc_interna double, it_in_st string, it_pc_mva double",
    )
    return ClassificationTables(both, cest, ncm, names, dated)


def test_fallback_order(spark, references):
    items = spark.createDataFrame(
        [(1, "12345678", "1234567"), (2, "00000000", "9999999"), (3, "88888888", "0000000"), (4, "00000000", "0000000")],
        "i int, ncm string, cest string",
    )
    out = classify_goods(items, references).orderBy("i").collect()
    assert [r.co_sefin_inferido for r in out] == ["sefin_cest_ncm_1", "sefin_cest_2", "sefin_ncm_2", None]
    assert [r.descr_co_sefin_inferido for r in out] == ["Produto CEST NCM 1", "Produto CEST 2", "Produto NCM 2", None]


def test_extra_code_and_intervals(spark, references):
    items = spark.createDataFrame(
        [
            (1, "12345678", "1234567", "sefin_adicional_1", date(2023, 2, 1), date(2023, 1, 1)),
            (2, "12345678", "1234567", "sefin_adicional_1", date(2023, 8, 1), date(2023, 7, 1)),
            (3, "12345678", "1234567", "sefin_adicional_1", date(2023, 6, 15), None),
            (4, "12345678", "1234567", "sefin_adicional_1", None, None),
        ],
        "i int, ncm string, cest string, sefin_fronteira string, dhemi date, dhsaient date",
    )
    out = classify_goods(items, references, extra_code="sefin_fronteira", issue_date="dhemi", movement_date="dhsaient")
    rows = out.orderBy("i").collect()
    assert [r.descr_sefin_fronteira for r in rows] == ["Produto Adicional 1"] * 4
    assert [r.it_pc_mva_fronteira for r in rows] == [50.0, 60.0, 60.0, None]
    assert [r.it_pc_interna_inferido for r in rows] == [18.0, 18.0, 18.0, None]


def test_missing_reference_is_an_error(spark, references):
    items = spark.createDataFrame([("1", "2")], "ncm string, cest string")
    partial = ClassificationTables(references.by_cest_and_ncm, references.by_cest, references.by_ncm)
    with pytest.raises(FileNotFoundError):
        classify_goods(items, partial)


def test_duplicated_references_do_not_multiply(spark):
    frame = spark.createDataFrame
    tables = ClassificationTables(
        frame([("111", "123", "001"), ("1.11", "123 ", "000"), ("222", "456", "002")], "it_nu_ncm string, it_nu_cest string, it_co_sefin string"),
        frame([("789", "003")], "cest string, `co-sefin` string"),
        frame([("333", "004")], "ncm string, `co-sefin` string"),
    )
    items = frame([("1.1.1", "123"), ("333", "999")], "ncm string, cest string")
    out = {r.ncm: r.co_sefin_inferido for r in classify(items, tables).collect()}
    assert out == {"1.1.1": "000", "333": "004"}


def test_manual_factors(spark):
    edited = spark.createDataFrame(
        [("123", "UN", "2023", 1.5, "teste 1"), ("456", "KG", "2023", 2.0, "teste 2"), ("789", None, "2023", 1.0, "")],
        "codigo_produto_ajustado string, unid string, ano string, fator double, justificativa string",
    )
    out = read_manual_factors(edited)
    assert set(out.columns) == {"chave_produto", "unidade", "fator_conversao_manual"}
    assert sorted(r.fator_conversao_manual for r in out.collect()) == [1.5, 2.0]
    assert read_manual_factors(edited.drop("fator")) is None
    with pytest.raises(ValueError):
        import_factors(edited.drop("ano"))


def test_manual_override(spark):
    factors = spark.createDataFrame(
        [("A", "UN", 1.0), ("B", "KG", 2.5), ("C", "L", 3.0)], "chave_produto string, unidade string, auto double"
    )
    manual = spark.createDataFrame(
        [("A", "UN", 1.2), ("B", "KG", 5.0)], "chave_produto string, unidade string, fator_conversao_manual double"
    )
    rows = units.with_manual_factors(factors, manual, "auto", "automático").orderBy("chave_produto").collect()
    assert [r.fator_de_conversao for r in rows] == [1.2, 5.0, 3.0]
    assert [r.fonte_fator for r in rows] == ["manual", "manual", "automático"]


def base_rows(spark, rows):
    schema = (
        "cnpj string, chave_produto string, unidade string, unid_padrao string, v_entr_total decimal(18,6), q_entr_total decimal(18,6), "
        "v_saida_total decimal(18,6), q_saida_total decimal(18,6), score_confianca_produto double, descricao string, descricao_longa string"
    )
    from decimal import Decimal as D

    full = [("1", p, u, ref, D(ve), D(qe), D(vs), D(qs), 0.5, p, p) for p, u, ref, ve, qe, vs, qs in rows]
    return units.with_prices(spark.createDataFrame(full, schema))


def test_reference_unit_and_factors(spark):
    base = base_rows(
        spark,
        [
            ("P", "UN", None, 100, 10, 0, 0),
            ("P", "CX", None, 120, 1, 0, 0),
            ("Q", "UN", "CX", 0, 0, 50, 5),
            ("Q", "CX", "CX", 0, 0, 240, 2),
            ("R", "UN", "FD", 10, 1, 0, 0),
            ("S", "UN", None, 10, 1, 0, 0),
        ],
    )
    v1 = {(r.chave_produto, r.unidade): r for r in units.conversion_factors(base).collect()}
    assert {k: round(r.fator_de_conversao, 6) for k, r in v1.items()} == {
        ("P", "UN"): 1.0,
        ("P", "CX"): round(10 / 120, 6),
        ("Q", "UN"): 12.0,
        ("Q", "CX"): 1.0,
    }
    v2 = {(r.chave_produto, r.unidade): r for r in units.conversion_factors_v2(base).collect()}
    assert v2[("R", "UN")].fator_de_conversao == 0.0 and v2[("R", "UN")].status_validacao == "erro"
    assert v2[("S", "UN")].fator_de_conversao == 1.0
    assert v2[("S", "UN")].score_confianca == pytest.approx(1 / 2 * 0.6 + 0.5 * 0.4)
    queued = {(r.chave_produto, r.unidade) for r in units.review_queue(units.conversion_factors_v2(base)).collect()}
    assert ("R", "UN") in queued


def test_conversion_keeps_the_value(spark):
    factors = spark.createDataFrame(
        [("1", "P", "CX", 12.0, "UN")], "cnpj string, chave_produto string, unidade string, fator_de_conversao double, unid_padrao string"
    )
    movements = spark.createDataFrame(
        [("1", "P", "CX", 1.0, 120.0), ("1", "P", "UN", 3.0, 30.0)],
        "cnpj string, chave_produto string, unidade string, quantidade double, valor double",
    )
    rows = {r.unidade: r for r in units.apply_conversion(movements, factors).collect()}
    assert (rows["CX"].quantidade_convertida, rows["CX"].preco_convertido, rows["CX"].unidade_convertida) == (12.0, 10.0, "UN")
    assert (rows["UN"].quantidade_convertida, rows["UN"].preco_convertido) == (3.0, 10.0)


def test_tax_formulas(spark):
    df = spark.createDataFrame(
        [(1, "S ", 40.0, 17.5, 12.0, "SP", "RO"), (2, "N", 40.0, 17.5, 12.0, "SP", "RO"), (3, "S", 40.0, 17.5, 12.0, "RO", "RO"), (4, "S", 40.0, 100.0, 12.0, "SP", "RO")],
        "i int, flag string, mva double, interna double, inter double, emit string, dest string",
    )
    adjusted = tax.adjusted_mva(*[F.col(c) for c in ("flag", "mva", "interna", "inter", "emit", "dest")])
    none = F.lit(None).cast("double")
    base = tax.st_base(F.lit(100.0), F.lit(10.0), none, none, F.lit(5.0), none, F.col("mva"), F.col("a"))
    rows = df.withColumn("a", adjusted).withColumn("b", base).orderBy("i").collect()
    assert rows[0].a == pytest.approx(1.4 * 0.88 / 0.825 - 1)
    assert [r.a for r in rows[1:]] == [None, None, None]
    assert rows[0].b == pytest.approx(105 * (1 + rows[0].a)) and rows[1].b == pytest.approx(105 * 1.4)
