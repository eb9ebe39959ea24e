"""Shuffles sized by their input, codes filtered where they are read, and steps that meet in the parts of descriptions."""

from __future__ import annotations

import hashlib
import threading

import pytest
from conftest import SMALL, plan_of
from pyspark.sql import functions as F

from fiscoframe import session
from fiscoframe.checks.jobs import _merge_input, _stored_items
from fiscoframe.operators.sets import union_conformed
from fiscoframe.plans import descriptions as ds
from fiscoframe.plans import items as it
from fiscoframe.plans import merge as mg
from fiscoframe.plans import replay, units
from fiscoframe.plans.catalogue import extract
from fiscoframe.plans.parameters import Params
from fiscoframe.plans.replay import replay_merges
from fiscoframe.schemas import TRANSACTION
from fiscoframe.sources.reference import marked_cfop

MOVE = "Exchange hashpartitioning"


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_shuffles_start_with_the_size_of_the_input(spark, monkeypatch):
    path, named = f"{SMALL}/lineitem.parquet", int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.sized(spark, path, "/no/such/table") == session.shuffle_partitions(spark) == named
    monkeypatch.setattr(session, "PARTITION_BYTES", session.folder_bytes(spark, path) // 50)
    try:
        number = session.sized(spark, path)
        assert 50 <= number <= 52 and session.shuffle_partitions(spark) == number
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
        lines = spark.read.parquet(path)
        assert f", {number}), REPARTITION_BY_COL" in plan_of(lines.repartition("l_orderkey"))
        stored = session.stage_by(lines.repartition("l_orderkey"), "l_orderkey")
        assert MOVE not in plan_of(stored.groupBy("l_orderkey").count())
        assert stored.count() == lines.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
        monkeypatch.undo()
        session.sized(spark)
    assert session.shuffle_partitions(spark) == named


def test_operation_codes_filter_lines_before_they_are_joined(tables):
    rows = it.transactions(tables, marked_cfop(tables["dm_cfop"]), inventory=False)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 3
    for below in plan.split("Join LeftSemi")[1:]:
        assert "Join Inner" not in below.split("Relation")[0]


LINES = [
    ("1", "7", " Caneta", "CX", 20, 0, 2, 0), ("1", "7", "CANETA ", "UN", 2, 6, 1, 3), ("1", "8", "caneta", "UN", 4, 0, 2, 0),
    ("1", "9", "lápis", "UN", 1, 1, 1, 1), ("1", "9", "LAPIS", "CX", 5, 0, 1, 0), ("1", "3", None, "UN", 1, 1, 1, 1), ("1", "5", "Caixa", "UN", 6, 2, 1, 1), ("2", "7", "caneta", "UN", 9, 0, 3, 0),
]
# one key of two descriptions, and one whose smallest fields hold no bar
BARRED = [("1", " a|b", "c", "UN", 3, 0, 1, 0), ("1", "A", "b|C ", "CX", 5, 0, 1, 0), ("1", "Z|b", "a", "UN", 7, 1, 1, 1), ("1", "z", "b|a", "CX", 8, 0, 1, 0)]


def item_rows(spark, lines):
    schema = "cnpj string, codigo string, descricao string, unidade string, valor_entrada int, valor_saida int, quantidade_entrada int, quantidade_saida int"
    return union_conformed([spark.createDataFrame(lines, schema).withColumn("fonte", F.lit("C170"))], TRANSACTION).localCheckpoint()


@pytest.mark.parametrize("lines", [LINES, LINES + BARRED])
def test_parts_give_the_same_rows(spark, lines):
    rows = item_rows(spark, lines)
    items = session.stage_by(it.aggregate_items(rows, located=True), "cnpj", it.PART)
    normal = it.normalize_items(items)
    by_text, by_name = ds.descriptions(normal, located=True), ds.consolidated_products(ds.descriptions_v2(normal, located=True))
    assert it.in_parts(items, by_text) == (lines is LINES)
    away, editable = items.drop(it.PART), mg.editable_table(by_text)
    groups = editable.select("cnpj", it.PART, F.substring("descricao", 1, 1).alias("grupo"), "chave_produto")
    pairs = [
        (mg.with_value_totals(editable.drop(it.PART), rows, items), mg.with_value_totals(editable.drop(it.PART), rows, away)),
        (mg.with_value_totals(editable, rows, items), mg.with_value_totals(editable.drop(it.PART), rows, away)),
        (mg.recompute_defaults(editable, normal), mg.recompute_defaults(editable.drop(it.PART), normal.drop(it.PART))),
        (mg.merged_rows(mg.selected_rows(editable, groups)), mg.merged_rows(mg.selected_rows(editable.drop(it.PART), groups.drop(it.PART)))),
        (mg.apply_merge(editable, groups)[0], mg.apply_merge(editable.drop(it.PART), groups.drop(it.PART))[0]),
    ]
    for make in (units.conversion_factors_v2, units.conversion_factors):
        pairs.append((make(units.conversion_base(rows, by_name, items)), make(units.conversion_base(rows, by_name.drop(it.PART), away))))
    odd = F.col("unidade") == "CX"
    halves = [units.item_unit_totals(rows.where(half), it.in_parts(items, by_name)) for half in (odd, ~odd)]
    pairs.append((units.conversion_factors_v2(units.base_of_totals(units.merge_unit_totals(*halves), by_name, items)), pairs[-2][1]))
    for placed, plain in pairs:
        assert sorted(placed.columns) == sorted(plain.columns)
        plain = plain.select(*placed.columns)
        assert placed.exceptAll(plain).isEmpty() and placed.count() == plain.count() > 0


def test_steps_meet_in_the_parts_of_descriptions(spark, tables, no_broadcast):
    """Lines move to the part of their description, where their items and products are; nothing else moves."""
    items = _stored_items(tables)
    rows = it.transactions(tables, inventory=False).localCheckpoint()
    normal = it.normalize_items(items)
    editable, products = mg.editable_table(ds.descriptions(normal, located=True)), ds.consolidated_products(ds.descriptions_v2(normal, located=True))
    assert plan_of(mg.with_value_totals(editable, rows, items)).count(MOVE) == 1
    # merged products carry no part: lines find their items, then both sides move by item, by product and to the table
    assert plan_of(mg.with_value_totals(editable.drop(it.PART), rows, items)).count(MOVE) == 5
    assert plan_of(units.conversion_factors_v2(units.conversion_base(rows, products, items))).count(MOVE) == 1
    assert plan_of(mg.recompute_defaults(editable, normal)).count(MOVE) == 0
    assert plan_of(ds.descriptions(normal, mode_over="rows")).count(MOVE) == 0
    # a merge moves its rows to their group alone
    assert plan_of(mg.merged_rows(mg.selected_rows(*_merge_input(tables)))).count(MOVE) == 1


def test_replayed_rows_stay_in_their_parts(spark):
    rows = item_rows(spark, [*LINES, *[("3", str(i), f"item {i}", "UN", i, 1, 1, 1) for i in range(6)]])
    normal = it.normalize_items(session.stage_by(it.aggregate_items(rows, located=True), "cnpj", it.PART))
    editable = session.stage_by(mg.editable_table(ds.descriptions(normal, located=True)), "cnpj", it.PART)
    keys = {(r.cnpj, r.descricao): r.chave_produto for r in editable.collect()}
    one, two, three = ([keys["3", f"ITEM {i}"] for i in pair] for pair in ((0, 1), (2, 3), (4, 5)))
    made = [hashlib.md5("".join(sorted(pair)).encode()).hexdigest() for pair in (one, two)]
    # results and products of the table meet in a later operation; another names what is gone
    operations = [("3", 1, "a", one), ("3", 2, "b", two), ("3", 3, "c", [*made, three[0]]), ("3", 4, "d", [one[0], three[1]]), ("1", 1, "a", [keys["1", "CANETA"], keys["1", "CAIXA"]])]
    log = spark.createDataFrame([(c, o, g, k) for c, o, g, named in operations for k in named], "cnpj string, ordem long, grupo string, chave_produto string")
    placed, plain = (replay_merges(table, log)[0] for table in (editable, editable.drop(it.PART)))
    assert it.PART not in placed.columns
    plain = plain.select(*placed.columns)
    assert placed.exceptAll(plain).isEmpty() and placed.count() == plain.count()
    assert sorted(r.descricao for r in placed.where("cnpj = '3'").collect()) == ["ITEM 0", "ITEM 5"]
    # wide rows move once, by their group
    moves = []
    original, recorded = replay.merged_rows, lambda rows: moves.append(plan_of(rows)) or original(rows)
    replay.merged_rows = recorded
    try:
        replay_merges(editable, log)
    finally:
        replay.merged_rows = original
    # the merges move to the parts, where they are not sent to all tasks
    assert moves[0].count("REPARTITION_BY_COL") == 1 and moves[0].count(MOVE) <= 2


def test_extraction_runs_queries_at_a_time(spark, tables):
    """Two writes wait for each other; one of them fails and is reported in its place."""
    both = threading.Barrier(2, timeout=120)

    def write(name, df):
        both.wait()
        if name == "reg_0190":
            raise OSError("full")
        return f"{name} {df.count() > 0}"

    outcomes = extract(tables, Params(cut_off="1997-06-30"), write, ["reg_0005", "verif_cnpjs", "reg_0190"])
    assert [(o.query, o.status, o.detail) for o in outcomes] == [
        ("reg_0005", "written", "reg_0005 True"), ("verif_cnpjs", "skipped", "no taxpayer parameter"), ("reg_0190", "failed", "OSError: full"),
    ]


def test_keys_of_numbered_items_travel_as_bytes(spark, tables):
    assert "hex(" in plan_of(it.item_characteristics(it.transactions(tables), tables["reg_0000"]))
