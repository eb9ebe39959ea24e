from __future__ import annotations

import hashlib
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fiscoframe.operators import aggregates as ag
from fiscoframe.operators.flags import Rule, with_flags
from fiscoframe.operators.predicates import Condition, apply_filters
from fiscoframe.plans import merge as mg
from fiscoframe.plans.catalogue import CATALOGUE, extract
from fiscoframe.plans.parameters import Params
from fiscoframe.sources import sinks
from fiscoframe.sources.readers import read_invoice_items, read_ledger_items
from fiscoframe.sources.tables import by_precedence, resolve_name

WHISKY = [
    ("WHISKY JW BLUE 6/750ML SC", "d7377c4e759947b38a9b4899d6fc1657", ["item_9"], ["10", "11"], ["05000267114545", "SEM GTIN"], ["CX"]),
    ("WHISKY JW BLUE LABEL 6/750ML", "db8edbbfd1d4bc60c747b0efa4c007ef", ["item_10"], ["9"], ["05000267114545"], ["UN", "CX"]),
    ("WHISKY JW BLUE LABEL 6/750ML SC", "8c9122d6ecbe38bfeb47c7aa144319f3", ["item_11"], ["[10; 3]"], ["05000267195018"], ["CX"]),
    ("GIN", "k4", ["item_12"], ["1"], [], ["UN"]),
]


@pytest.fixture(scope="module")
def editable(spark):
    rows = [
        ("1", d, k, items, codes, ["22083020"], ["0201600"], gtin, ["00"], units, ["2290"], 10.0, 1.5, "old")
        for d, k, items, codes, gtin, units in WHISKY
    ]
    df = spark.createDataFrame(
        rows,
        "cnpj string, descricao string, chave_produto string, lista_chave_item_individualizado array<string>, lista_codigos array<string>, lista_ncm array<string>, "
        "lista_cest array<string>, lista_gtin array<string>, lista_tipo_item array<string>, lista_unids array<string>, lista_co_sefin_inferido array<string>, "
        "total_entradas double, total_saidas double, ncm_padrao string",
    )
    return mg.editable_table(df)


def test_merge_of_three_products(spark, editable):
    chosen = {"g": [k for _, k, *_ in WHISKY[:3]], "alone": ["k4"]}
    assignment = mg.merge_groups_of(chosen, spark, "1")
    changed, merged = mg.apply_merge(editable, assignment)
    (row,) = merged.collect()
    keys = sorted(chosen["g"])
    assert row.chave_id == row.chave_produto == hashlib.md5("".join(keys).encode()).hexdigest()
    assert row.descricao == "WHISKY JW BLUE 6/750ML SC"
    assert row.descricao_padrao == "WHISKY JW BLUE LABEL 6/750ML SC"
    assert row.codigo_padrao == "10" and row.lista_codigos == ["[9; 1]", "[10; 3]", "[11; 1]"]
    assert (row.ncm_padrao, row.cest_padrao, row.gtin_padrao) == ("22083020", "0201600", "05000267114545")
    assert (row.unid_padrao, row.tipo_item_padrao, row.co_sefin_agr) == ("CX", "00", "2290")
    assert row.co_sefin_agr_divergente is False and row.verificado is True
    assert row.lista_gtin == ["05000267114545", "05000267195018", "SEM GTIN"]
    assert row.lista_chave_item_individualizado == ["item_10", "item_11", "item_9"]
    assert (row.total_entradas, row.total_saidas, row.itens_unificados) == (30.0, 4.5, 3)
    assert changed.count() == 2
    sums = changed.agg(F.sum("total_entradas")).first()[0]
    assert sums == editable.agg(F.sum("total_entradas")).first()[0]


def test_merging_again_changes_nothing(spark, editable):
    assignment = mg.merge_groups_of({"g": [k for _, k, *_ in WHISKY[:3]]}, spark, "1")
    once, _ = mg.apply_merge(editable, assignment)
    twice, merged = mg.apply_merge(once, assignment)
    assert merged.isEmpty() and once.count() == twice.count()


def test_given_description_wins(spark, editable):
    assignment = mg.merge_groups_of({"g": [WHISKY[0][1], WHISKY[1][1]]}, spark, "1").withColumn(
        "descricao_resultante", F.lit("Uísque de Luxo")
    )
    (row,) = mg.merged_rows(mg.selected_rows(editable, assignment)).collect()
    assert (row.descricao, row.descricao_normalizada) == ("Uísque de Luxo", "UISQUE LUXO")


def test_ledger_amounts_come_from_the_original_columns(spark):
    rows = spark.createDataFrame(
        [("1", "0", 10.0, 2.0), ("1", "1", 7.0, 3.0), ("1", "9", 5.0, 1.0)], "cnpj string, ind_oper string, vl_item double, qtd double"
    )
    out = [tuple(map(float, r)) for r in read_ledger_items(rows).select("valor_entrada", "valor_saida", "quantidade_entrada", "quantidade_saida").collect()]
    assert out == [(10.0, 0.0, 2.0, 0.0), (0.0, 7.0, 0.0, 3.0), (0.0, 0.0, 0.0, 0.0)]


def test_invoice_reader_accepts_labelled_kind(spark):
    rows = spark.createDataFrame(
        [("1", "1 - SAIDA", "A", 10.0, None, "7891"), ("1", "0 - ENTRADA", "B", 5.0, "", "7892"), ("1", "1 - SAIDA", "C", 5.0, "", "7893")],
        "co_emitente string, tipo_operacao string, prod_cprod string, prod_vprod double, prod_ceantrib string, prod_cean string",
    ).withColumn("prod_qcom", F.lit(2.0))
    out = read_invoice_items(rows, "NFe").orderBy("codigo").collect()
    assert [(r.codigo, r.gtin, float(r.valor_saida)) for r in out] == [("A", "7891", 10.0), ("C", "7893", 5.0)]


def test_versions_and_log(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.write_version(spark.range(3).toDF("x"), root, "0001")
    sinks.write_version(sinks.read_current(spark, root).withColumn("y", F.lit(1)), root, "0002")
    assert sinks.read_current(spark, root).columns == ["x", "y"]
    with pytest.raises(Exception):
        sinks.write_version(spark.range(1).toDF("x"), root, "0002")


def test_partition_overwrite_keeps_other_taxpayers(spark, tmp_path):
    path = str(tmp_path / "p")
    first = spark.createDataFrame([("1", 1), ("2", 2)], "cnpj string, v int")
    sinks.write_table(first, path)
    sinks.write_table(spark.createDataFrame([("2", 9)], "cnpj string, v int"), path)
    assert sorted((str(r.cnpj), r.v) for r in spark.read.parquet(path).collect()) == [("1", 1), ("2", 9)]


def test_extraction_reports_and_goes_on(tables, tmp_path):
    broken = {k: v for k, v in tables.items() if k != "reg_e111"}
    done = extract(
        broken, Params(cut_off="2000-06-30"), sinks.table_writer(str(tmp_path)), ["e111", "verif_cnpjs", "reg_0005"]
    )
    assert [o.status for o in done] == ["failed", "skipped", "written"]


def test_precedence_and_names(spark):
    a = spark.createDataFrame([("1", "a")], "cnpj string, v string")
    b = spark.createDataFrame([("1", "b"), ("2", "b")], "cnpj string, v string")
    assert sorted((r.cnpj, r.v) for r in by_precedence([a, b]).collect()) == [("1", "a"), ("2", "b")]
    names = ["nfe_agrupado", "nfe", "c170_simplificada_x"]
    assert resolve_name(names, "NFe") == "nfe_agrupado"
    assert resolve_name(names, "c170_simplificada") == "c170_simplificada_x"
    assert resolve_name(names, "cte") is None


def test_flags_and_filters_on_nulls(spark):
    df = spark.createDataFrame([(1, None, True), (2, 0.0, False), (3, 5.0, None)], "i int, v double, b boolean")
    rules = [Rule("not_equal_zero", "v"), Rule("boolean_true", "b"), Rule("greater_than", "missing", 1)]
    out = {r.i: r.alertas for r in with_flags(df, rules).collect()}
    assert out == {1: ["boolean_true:b"], 2: [], 3: ["not_equal_zero:v"]}
    kept = apply_filters(df, [Condition("v", "é nulo"), Condition("", "igual", "x")])
    assert [r.i for r in kept.collect()] == [1]


def test_ordered_run(tables):
    rows = CATALOGUE["bloco_h"].run(tables, Params(cut_off="2000-06-30"), ordered=True).select("dt_inv").collect()
    days = [r.dt_inv for r in rows]
    assert days == sorted(days, reverse=True) and days


def test_writing_again_replaces_null_keys_too(spark, tmp_path):
    path = str(tmp_path / "nulls")
    rows = spark.createDataFrame([(None, 1), (None, 2), ("", 3), ("a", 4)], "cnpj string, v int")
    for _ in range(3):
        sinks.write_table(rows, path)
    assert sorted(r["v"] for r in sinks.read_table(spark, path).collect()) == [1, 2, 3, 4]
    sinks.write_table(spark.createDataFrame([(None, 9)], "cnpj string, v int"), path)
    assert sorted(r["v"] for r in sinks.read_table(spark, path).collect()) == [3, 4, 9]


@pytest.mark.parametrize("buckets", [1, 16, 64, 128])
def test_the_layout_is_kept_with_the_table(spark, tmp_path, buckets):
    path = str(tmp_path / "layout")
    rows = spark.range(3000).select(F.col("id").cast("string").alias("cnpj"), "id")
    sinks.write_table(rows, path, buckets=buckets)
    assert sinks.table_layout(spark, path) == {"key": "cnpj", "buckets": buckets}
    assert len(list((tmp_path / "layout").glob("key_bucket=*"))) == buckets
    for key in ("0", "77", "2999"):
        found = sinks.read_table(spark, path, key)
        assert [r["id"] for r in found.collect()] == [int(key)]
    with pytest.raises(ValueError, match="stored by cnpj"):
        sinks.write_table(rows, path, partition="id")


def test_a_grown_table_gets_more_buckets(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "grown")
    monkeypatch.setattr(sinks, "LEAST_BUCKETS", 2)
    rows = spark.range(20_000).select((F.col("id") % 500).cast("string").alias("cnpj"), "id")
    sinks.write_table(rows, path, buckets=2)
    monkeypatch.setattr(sinks, "BUCKET_BYTES", sinks.folder_bytes(spark, path) // 6)
    sinks.write_table(rows.where("cnpj = '7'").withColumn("id", -F.col("id")), path)
    assert sinks.table_layout(spark, path)["buckets"] == 8
    assert sinks.read_table(spark, path).count() == 20_000
    assert sinks.read_table(spark, path, "7").agg(F.max("id")).first()[0] == -7
    assert sinks.read_table(spark, path, "8").agg(F.min("id")).first()[0] == 8


def test_a_plain_table_is_read_by_key(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.createDataFrame([("1", 1), ("2", 2)], "cnpj string, v int").write.parquet(path)
    assert sinks.table_layout(spark, path) is None and sinks.read_table(spark, path, "2").collect() == [("2", 2)]


def test_modes_and_codes_of_a_group_in_one_pass(spark):
    """The aggregates that need no move of their own give what the counted rows give."""
    rng = random.Random(11)
    entries = ["[10; 3]", "10", "9", "[9;2]", "[b; x]", " 7", "[; 4]", "", None]
    cell = lambda values: rng.choice([None, [rng.choice(values) for _ in range(rng.randrange(5))]])
    texts = ["a10", " a9", "a9 ", "", "b", None, "bb"]
    rows = [(rng.randrange(40), cell(entries), cell(entries), cell(texts), rng.choice(texts)) for _ in range(400)]
    df = spark.createDataFrame(rows, "g int, own array<string>, spare array<string>, l array<string>, s string").repartition("g").localCheckpoint()
    filled = [F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda v: v != "") for c in ("own", "spare")]
    default, codes = ag.code_summary(*filled)
    for tie in (ag.ALPHABETICAL, ag.NATURAL, ag.LONGEST):
        counted = df.select("g").distinct().join(ag.modes(df, ["g"], {"m": "l", "n": "s"}, tie), "g", "left")
        at_once = df.groupBy("g").agg(*[ag.mode_of_values(ag.values_of(df, c), tie).alias(n) for n, c in (("m", "l"), ("n", "s"))])
        assert sorted(counted.collect()) == sorted(at_once.collect())
    listed = df.select("g", *[c.alias(n) for n, c in zip(("own", "spare"), filled, strict=True)])
    expected = {r.g: r for r in ag.code_frequencies(listed, ["g"], "own", "spare").collect()}
    for r in df.groupBy("g").agg(default.alias("d"), codes.alias("l")).collect():
        want = expected.get(r.g)
        assert (r.d, r.l) == ((want.codigo_padrao, want.lista_codigos) if want else (None, []))


def test_merged_rows_move_by_product_and_by_group(spark, editable):
    chosen = [("1", "g", k) for _, k, *_ in WHISKY[:3]] + [("1", None, "k4"), ("1", None, WHISKY[0][1])]
    assignment = spark.createDataFrame(chosen, "cnpj string, grupo string, chave_produto string").localCheckpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = mg.merged_rows(mg.selected_rows(editable.localCheckpoint(), assignment))
        plan = plan_of(merged)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") <= 3
    (row,) = merged.collect()
    assert row.itens_unificados == 3 and row.lista_chave_item_individualizado == ["item_10", "item_11", "item_9"]
