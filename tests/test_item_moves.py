"""Work and moves that grow no faster than the rows."""

from __future__ import annotations

import random
import sys
import time

from conftest import plan_of
from pyspark.sql import functions as F

from fiscoframe.checks.jobs import _assignment, _stored_items, _stored_products
from fiscoframe.functions import text
from fiscoframe.functions.keys import packed_key, unpacked_key
from fiscoframe.operators import aggregates as ag
from fiscoframe.operators.sets import union_conformed
from fiscoframe.plans import descriptions as ds
from fiscoframe.plans import items as it
from fiscoframe.plans import merge as mg
from fiscoframe.plans import products as pr
from fiscoframe.plans import units
from fiscoframe.schemas import MOVEMENT, TRANSACTION


def test_mode_of_a_long_list_sorts_once(spark):
    rng = random.Random(5)
    values = [rng.choice([" a", "a", "b ", "c10", "c9", "", "dd"]) for _ in range(20_000)]
    df = spark.createDataFrame([(values,)], "l array<string>").localCheckpoint()
    start = time.monotonic()
    plain = [v.strip() for v in values if v.strip()]
    for tie in (ag.ALPHABETICAL, ag.NATURAL, ag.LONGEST):
        most = max(plain.count(v) for v in set(plain))
        assert plain.count(df.select(ag.mode_of_list(F.col("l"), tie)).first()[0]) == most
    # sorting again for every element takes minutes
    assert time.monotonic() - start < 60


def test_item_lines_move_once(spark, tables):
    rows = spark.createDataFrame([("1", "7", "caneta", "un", "C170")], "cnpj string, codigo string, descricao string, unidade string, fonte string")
    rows = union_conformed([rows], TRANSACTION).localCheckpoint()
    files = tables["reg_0000"].select("cnpj", "dt_ini").localCheckpoint()
    plan = plan_of(it.aggregate_items(rows, files))
    # the lines once, the files once by taxpayer; the years only once more, where they are not sent to all tasks
    assert plan.count("Exchange hashpartitioning") <= 3 and plan.count("REPARTITION_BY_COL") == 1


def test_items_are_grouped_by_the_whole_key(spark):
    """A bar inside a field and another case lead to one key; a hot taxpayer fills several parts."""
    lines = [("1", " a|b", "c", 1), ("1", "A", "b|C ", 2), ("1", "a", "b", 4)] + [("2", f"i{i % 40}", "x", 1) for i in range(400)]
    rows = spark.createDataFrame(lines, "cnpj string, codigo string, descricao string, valor_saida int").withColumn("fonte", F.lit("NFe"))
    rows = union_conformed([rows], TRANSACTION)
    files = spark.createDataFrame([("1", "1999-01-01"), ("3", "1998-01-01")], "cnpj string, dt_ini string")
    items = it.aggregate_items(rows, files)
    got = {(r.cnpj, r.codigo, r.descricao): (r.total_saidas, r.ano) for r in items.where("cnpj = '1'").collect()}
    assert got == {("1", " a|b", "b|C "): (3.0, "1999"), ("1", "a", "b"): (4.0, "1999")}
    assert items.where("cnpj = '2' AND total_saidas = 10 AND ano = ''").count() == 40
    parts = it.by_item_part(rows).where("cnpj = '2'").select("__part").distinct().count()
    assert parts > 8


def test_numbering_reads_a_stored_table(spark, tables):
    """Three passes over the item and product tables must not run their joins and groupings three times."""
    items = it.item_characteristics(it.transactions(tables), tables["reg_0000"])
    made = pr.products(pr.unit_movements(tables))
    for table in (items, made):
        plan = plan_of(table)
        assert "stage-" in plan and "lineitem" not in plan


def test_descriptions_move_plain_items(tables):
    """Sets collected before the move weigh several times the rows, as few items share a description."""
    items = it.normalize_items(it.aggregate_items(it.transactions(tables), tables["reg_0000"]))
    for table in (ds.descriptions(items), ds.descriptions_v2(items)):
        last_move = plan_of(table).split("Exchange")[0]
        assert last_move.count("collect_set") > last_move.count("partial_collect_set") > 0


def test_parts_of_descriptions_hold_whole_items(spark):
    """Upper case and normalisation of any character keep its bare letters."""
    every = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in every], "c string")
    bare = text.bare_letters(F.col("c"))
    others = [F.upper(text.strip(F.col("c"))), text.normalize(F.col("c")), text.normalize_description(F.col("c"), False)]
    for other in others:
        assert df.where(bare != text.bare_letters(other)).isEmpty()


def test_located_items_need_no_move_for_their_descriptions(spark, tables):
    lines = [("1", " a|b", "c", 1), ("1", "A", "b|C ", 2), ("1", "q", "b|c", 4), ("1", "q", " B|C", 8), ("1", "z", "c", 16), ("1", "z", None, 32)]
    rows = spark.createDataFrame(lines, "cnpj string, codigo string, descricao string, valor_saida int").withColumn("fonte", F.lit("NFe"))
    rows = union_conformed([rows], TRANSACTION)
    kept, located = (it.aggregate_items(rows, tables["reg_0000"], located=flag) for flag in (False, True))
    assert located.drop(it.PART).exceptAll(kept).isEmpty() and kept.count() == located.count() == 4
    for table in (ds.descriptions, ds.descriptions_v2):
        for over in ("distinct", "rows"):
            one, other = (table(it.normalize_items(items), over) for items in (kept, located))
            assert one.exceptAll(other).isEmpty() and other.count() == one.count() == 3
    made = ds.descriptions(it.normalize_items(it.aggregate_items(it.transactions(tables), located=True)))
    last_move = plan_of(made).split("Exchange")[0]
    assert last_move.count("Union") == 1


def test_stored_items_keep_their_place(tables):
    """Descriptions of the stored item table, and modes over its rows, move nothing but the last join."""
    items = it.normalize_items(_stored_items(tables))
    assert "Exchange hashpartitioning" not in plan_of(ds.descriptions(items))
    modes = ds.descriptions(items, mode_over="rows").select("cnpj", "descricao", "ncm_padrao")
    assert plan_of(modes).count("Exchange hashpartitioning") <= 2


def test_keys_travel_packed(spark):
    values = ["0f" * 16, "0F" * 16, "item_12", "exactly16letters", "", "é" * 8, "\0" * 17, None]
    df = spark.createDataFrame([(v,) for v in values], "k string").withColumn("p", packed_key(F.col("k")))
    assert [r[0] for r in df.select(unpacked_key(F.col("p"))).collect()] == values
    assert df.select("p").distinct().count() == len(values)


def test_totals_and_factors_move_few_times(spark, tables):
    """Lines, items and products move by the key of their next join, and stay there for all groups by it."""
    items = _stored_items(tables)
    rows = it.transactions(tables, inventory=False).localCheckpoint()
    described = ds.descriptions_v2(it.normalize_items(items)).localCheckpoint()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = plan_of(mg.with_value_totals(mg.editable_table(described), rows, items))
        factors = plan_of(units.conversion_factors_v2(units.conversion_base(rows, ds.consolidated_products(described), items)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert totals.count("Exchange hashpartitioning") <= 6
    assert factors.count("Exchange hashpartitioning") <= 5


def test_recomputed_defaults_count_where_rows_are(spark, tables):
    """Attribute values move as columns of their item, not as one row each."""
    items = it.normalize_items(_stored_items(tables))
    editable = mg.editable_table(ds.descriptions(items)).localCheckpoint()
    plan = plan_of(mg.recompute_defaults(editable, items))
    assert "partial_min_by" in plan and plan.split("Generate inline")[0].count("Exchange hashpartitioning") <= 1


def test_stored_products_keep_their_place(tables):
    """Assignments and bridges of the stored product table join it by product without a move."""
    products = _stored_products(tables)
    joined = products.join(_assignment(products), ["cnpj", "chave_produto"])
    assert "Exchange hashpartitioning" not in plan_of(joined)


def test_legacy_factors_move_by_description(spark, tables):
    """Prices, units and products of a description meet in one place."""
    lines = [("1", " Caneta", "CX", 20, 0), ("1", "CANETA ", "UN", 2, 6), ("1", "caneta", "UN", 4, 0), ("1", "lápis", "UN", 1, 1), ("1", None, "UN", 1, 1), ("2", "caneta", "UN", 9, 0)]
    movements = spark.createDataFrame(lines, "cnpj string, descricao string, unid string, compras int, vendas int")
    movements = union_conformed([movements], MOVEMENT).localCheckpoint()
    made = pr.products(movements)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        factors = units.legacy_factors(made.localCheckpoint(), movements)
        assert plan_of(factors).count("Exchange hashpartitioning") <= 2
        got = sorted((r.cnpj, r.unid, r.unid_ref, r.fator) for r in factors.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == [("1", "CX", "UN", 20 / 3), ("1", "UN", "UN", 1.0)]
