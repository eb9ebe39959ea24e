"""Codes with several descriptions: one pass over the items."""

from conftest import plan_of

from fiscoframe.plans.descriptions import codes_with_several_descriptions
from fiscoframe.plans.items import KEY


def test_codes_are_listed_and_counted_in_one_pass(spark, tmp_path):
    rows = [
        ("1", "7", "k3", "B"), ("1", "7", "k1", "A"), ("1", "7", "k2", "A"),  # two descriptions
        ("1", "8", "k4", "C"), ("1", "8", "k5", "C"),  # one
        ("1", "9", "k6", None), ("1", "9", "k7", "D"),  # a null counts as one
        ("1", "", "k8", "E"), ("1", "", "k9", "F"), ("1", None, "k10", "G"),  # no code
        ("2", "7", "k1", "A"), ("2", "6", "k11", None), ("2", "6", "k12", None),
    ]
    spark.createDataFrame(rows, f"cnpj string, cod_normalizado string, {KEY} string, descricao string").write.parquet(f"{tmp_path}/items")
    found = codes_with_several_descriptions(spark.read.parquet(f"{tmp_path}/items"))
    plan = plan_of(found)
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert sorted(tuple(r) for r in found.collect()) == [
        ("1", "7", ["k1", "k2", "k3"], ["A", "A", "B"], ["7__1", "7__2", "7__3"], 2),
        ("1", "9", ["k6", "k7"], [None, "D"], ["9__1", "9__2"], 2),
    ]
    assert dict(found.dtypes)["qtd_descr"] == "bigint"
