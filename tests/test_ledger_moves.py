"""Registers of a ledger file move once, whatever number of joins follows."""

import re

import pytest

from fiscoframe.bindings import MOVED_ONCE, VIEWS, bound_tables
from fiscoframe.checks.audits import PARAMS
from fiscoframe.plans.catalogue import CATALOGUE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def unhinted(spark):
    """Without broadcasts by size, as with large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def moves(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*), \d+\), (\w+)", plan)


@pytest.mark.parametrize("query", ["c170", "c176"])
def test_registers_move_by_their_file_alone(unhinted, query):
    found = [keys for keys, why in moves(CATALOGUE[query].run(bound_tables(unhinted, FOLDER), PARAMS)) if why == "ENSURE_REQUIREMENTS"]
    by_several = [k for k in found if k.count("#") > 1 and "cnpj" not in k and "p_partkey" not in k]
    assert not by_several


def test_analytic_items_move_by_file_and_operation_alone(unhinted):
    found = [keys for keys, _ in moves(CATALOGUE["c176_v2"].run(bound_tables(unhinted, FOLDER), PARAMS))]
    assert not [k for k in found if "reg_c100_id" in k or "cod_nat" in k or "cod_item" in k]
    assert not [k for k in found if k.startswith("cst_icms") or k.startswith("segmento_cest")]


@pytest.mark.parametrize("name", sorted(MOVED_ONCE))
def test_views_for_spark_have_the_same_rows(spark, name):
    tables = bound_tables(spark, FOLDER)
    bases = {n: tables[n] for n in ("lineitem", "part") if "{" + n + "}" in VIEWS[name]}
    # repeated keys, and sizes that lose a digit
    odd = {n: df.union(df.limit(20)) for n, df in bases.items()}
    if "part" in odd:
        columns = ", ".join("p_size + 1000 AS p_size" if c == "p_size" else c for c in odd["part"].columns)
        odd["part"] = odd["part"].union(spark.sql(f"SELECT {columns} FROM {{part}}", part=bases["part"]))
    defined, moved = spark.sql(VIEWS[name], **odd), spark.sql(MOVED_ONCE[name], **odd)
    assert moved.columns == defined.columns and moved.dtypes == defined.dtypes
    assert moved.count() == defined.count()
    assert moved.exceptAll(defined).isEmpty()
