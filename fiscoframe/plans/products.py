"""Movements per unit, products and product groups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions.text import normalize_description
from fiscoframe.operators.aggregates import (
    LONGEST,
    best_description,
    filled_lists,
    mode_of_list,
    modes,
    sorted_distinct,
    sorted_distinct_flat,
)
from fiscoframe.operators.ranking import number_rows, numbered_id
from fiscoframe.operators.sets import union_conformed
from fiscoframe.plans.items import PARTS
from fiscoframe.schemas import MOVEMENT
from fiscoframe.session import stage
from fiscoframe.sources.readers import (
    read_inventory_movements,
    read_invoice_movements,
    read_ledger_movements,
)
from fiscoframe.sources.tables import first_available

GROUPED = (
    "id_agrupado",
    "lista_chave_produto",
    "descr_padrao",
    "ncm_padrao",
    "cest_padrao",
    "gtin_padrao",
    "lista_unidades",
)


def unit_movements(tables: Mapping[str, DataFrame], cfop: DataFrame | None = None) -> DataFrame:
    """Purchases, sales and inventory lines in one schema."""
    parts = [read_invoice_movements(tables[name], cfop) for name in ("nfe", "nfce") if name in tables]
    ledger = first_available(tables, "c170_simplificada", "c170")
    if ledger is not None:
        parts.append(read_ledger_movements(ledger, cfop))
    if "bloco_h" in tables:
        parts.append(read_inventory_movements(tables["bloco_h"]))
    return union_conformed(parts, MOVEMENT)


def with_normalized_description(movements: DataFrame) -> DataFrame:
    return movements.withColumn("descricao_normalizada", normalize_description(F.col("descricao")))


def products(movements: DataFrame) -> DataFrame:
    """One product per normalised description.

    Movements are moved once, to the task of their taxpayer and part of its descriptions.  There they are reduced to
    distinct attribute tuples, which keeps the lines of a common description out of memory, and grouped.
    The result is stored, as numbering reads it three times.
    """
    attributes = ("descricao", "descr_compl", "codigo", "tipo_item", "ncm", "cest", "gtin", "unid")
    part = F.pmod(F.xxhash64(normalize_description(F.col("descricao"))), F.lit(PARTS)).cast("int")
    moved = movements.select("cnpj", *attributes, part.alias("__part")).repartition("cnpj", "__part")
    tuples = with_normalized_description(moved.distinct())
    grouped = tuples.groupBy("cnpj", "__part", "descricao_normalizada").agg(
        F.min("descricao").alias("descricao"),
        sorted_distinct(F.col("descr_compl")).alias("lista_desc_compl"),
        sorted_distinct(F.col("codigo")).alias("lista_codigos"),
        sorted_distinct(F.col("tipo_item")).alias("lista_tipo_item"),
        sorted_distinct(F.col("ncm")).alias("lista_ncm"),
        sorted_distinct(F.col("cest")).alias("lista_cest"),
        sorted_distinct(F.col("gtin")).alias("lista_gtin"),
        sorted_distinct(F.col("unid")).alias("lista_unid"),
    )
    grouped = stage(grouped.drop("__part"))
    numbered = number_rows(grouped, ["cnpj"], [F.col("descricao_normalizada")])
    rest = [c for c in grouped.columns if c != "cnpj"]
    return numbered.select("cnpj", numbered_id("id_produto_").alias("chave_produto"), *rest)


def _own_defaults(df: DataFrame) -> dict:
    return {
        "lista_chave_produto": F.array("chave_produto"),
        "descr_padrao": F.col("descricao"),
        "ncm_padrao": mode_of_list(F.col("lista_ncm"), LONGEST),
        "cest_padrao": mode_of_list(F.col("lista_cest"), LONGEST),
        "gtin_padrao": mode_of_list(F.col("lista_gtin"), LONGEST),
        "lista_unidades": F.col("lista_unid"),
    }


def _position():
    return F.element_at(F.split("chave_produto", "_"), -1).try_cast("bigint")


def grouped_products(product_table: DataFrame, assignment: DataFrame | None = None) -> DataFrame:
    """Product groups: every product on its own, or the given (group, product) rows.

    Ungrouped products follow with continuing numbers.  Without an assignment the
    group number is the product number, as both follow the same order.
    """
    if assignment is None:
        number = F.element_at(F.split("chave_produto", "_"), -1)
        alone = product_table.withColumns(
            {"id_agrupado": F.concat(F.lit("id_agrupado_"), number), **_own_defaults(product_table)}
        )
        return alone.select("cnpj", *GROUPED)

    group = ["cnpj", "id_agrupado"]
    assignment = assignment.select("cnpj", "id_agrupado", "chave_produto").distinct()
    # read by three aggregates
    members = stage(product_table.join(assignment, ["cnpj", "chave_produto"]))
    described = best_description(
        members,
        group,
        "descricao",
        filled_lists(F.col("lista_ncm"), F.col("lista_cest"), F.col("lista_gtin")),
        _position(),
        "descr_padrao",
    )
    codes = modes(
        members,
        group,
        {"ncm_padrao": "lista_ncm", "cest_padrao": "lista_cest", "gtin_padrao": "lista_gtin"},
        LONGEST,
    )
    keys = assignment.groupBy(*group).agg(sorted_distinct(F.col("chave_produto")).alias("lista_chave_produto"))
    units = members.groupBy(*group).agg(sorted_distinct_flat(F.col("lista_unid")).alias("lista_unidades"))
    manual = (
        units.join(keys, group).join(described, group, "left").join(codes, group, "left").select("cnpj", *GROUPED)
    )

    groups = assignment.groupBy("cnpj").agg(F.count_distinct("id_agrupado").alias("__groups"))
    rest = product_table.join(assignment, ["cnpj", "chave_produto"], "left_anti")
    rest = number_rows(rest, ["cnpj"], [_position(), F.col("chave_produto")])
    rest = rest.join(groups, "cnpj", "left").withColumn(
        "seq", F.col("seq") + F.coalesce(F.col("__groups"), F.lit(0))
    )
    rest = rest.withColumns({"id_agrupado": numbered_id("id_agrupado_"), **_own_defaults(rest)})
    return manual.unionByName(rest.select("cnpj", *GROUPED))


def group_members(groups: DataFrame, product_table: DataFrame) -> DataFrame:
    """Bridge table: every product with its group and the group's defaults."""
    exploded = groups.withColumn("chave_produto", F.explode("lista_chave_produto")).drop("lista_chave_produto")
    return exploded.join(product_table, ["cnpj", "chave_produto"], "left")
