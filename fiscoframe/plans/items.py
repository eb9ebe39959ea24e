"""Item characteristics: one row per distinct item of each taxpayer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions import text
from fiscoframe.functions.keys import item_key, item_key_text, packed_key, unpacked_key
from fiscoframe.operators.aggregates import sorted_distinct
from fiscoframe.operators.lookup import ClassificationTables, classify
from fiscoframe.operators.ranking import nulls_last, number_rows, numbered_id
from fiscoframe.operators.sets import union_conformed
from fiscoframe.schemas import ITEM_KEY_FIELDS, TRANSACTION, VALUE_FIELDS
from fiscoframe.session import stage
from fiscoframe.sources.readers import read_inventory_items, read_invoice_items, read_ledger_items
from fiscoframe.sources.tables import base_year, first_available

KEY = "chave_item_individualizado"
#: Parts of a taxpayer's items: rows of one item share a part, a large taxpayer is spread over all of them.
PARTS = 16
PART = "__part"


def transactions(
    tables: Mapping[str, DataFrame], cfop: DataFrame | None = None, inventory: bool = True
) -> DataFrame:
    """All uses of items: invoices, retail invoices, ledger items and inventories."""
    parts: list[DataFrame] = []
    for name, source in (("nfe", "NFe"), ("nfce", "NFCe")):
        if name in tables:
            parts.append(read_invoice_items(tables[name], source, cfop))
    ledger = first_available(tables, "c170_simplificada", "c170")
    if ledger is not None:
        parts.append(read_ledger_items(ledger, cfop))
    if inventory and "bloco_h" in tables:
        parts.append(read_inventory_items(tables["bloco_h"]))
    if not parts:
        raise ValueError("no source of items is available")
    return union_conformed(parts, TRANSACTION)


def with_item_key(df: DataFrame) -> DataFrame:
    return df.withColumn(KEY, item_key())


def condense(rows: DataFrame, *more: str, **flags: Column) -> DataFrame:
    """Sum transactions with the same raw item fields, unit and source.

    A plain hash aggregation, so that keys and normalised texts are computed once per distinct item instead
    of once per line; rows that no earlier step has moved are reduced on the map side.  ``flags`` are conditions on
    the raw item fields, shown as columns.
    """
    return rows.groupBy("cnpj", *more, *ITEM_KEY_FIELDS, "unidade", "fonte").agg(
        *[F.sum(name).alias(name) for name in VALUE_FIELDS],
        F.min(F.col("ano").try_cast("int")).alias("ano"),
        F.count(F.lit(1)).alias("ocorrencias"),
        *[F.max(flag).alias(name) for name, flag in flags.items()],
    )


def by_item_part(rows: DataFrame) -> DataFrame:
    """Rows moved once, to the task of their taxpayer and part; what follows by item finds them there.

    The key itself does not travel: it is computed from the fields where the rows arrive.  A key that most rows
    share streams through one hash aggregation, which takes no memory for its lines.
    """
    part = F.pmod(F.xxhash64(item_key_text()), F.lit(PARTS)).cast("int")
    return rows.withColumn(PART, part).repartition("cnpj", PART)


def by_description_part(rows: DataFrame) -> DataFrame:
    """The same by the description: steps by item and steps by description both find their rows there.

    Rows of one key share the part, as their descriptions differ in case and outer blanks alone.  The exception are
    fields that hold a bar, where the key does not tell the description.
    """
    return rows.withColumn(PART, description_part()).repartition("cnpj", PART)


def description_part() -> Column:
    """The part of a row by its description, raw or normalised."""
    return F.pmod(F.xxhash64(text.bare_letters(F.col("descricao"))), F.lit(PARTS)).cast("int")


def _barred() -> Column:
    """Whether fields hold a bar, so that the key does not tell the description."""
    return F.regexp_count(item_key_text(), F.lit("\\|")) >= len(ITEM_KEY_FIELDS)


def in_parts(items: DataFrame, products: DataFrame) -> bool:
    """Whether lines, items and products can meet in their parts.

    Both tables carry the part, and the keys of all items, as they are and of normalised fields, tell their descriptions:
    lines of an item then lie in its part.  That takes a pass over the stored items, but none over lines.
    """
    if PART not in items.columns or PART not in products.columns:
        return False
    changed = F.col(KEY).rlike("^[0-9a-f]{32}$") & (F.col(KEY) != item_key())
    plain = items.select(*ITEM_KEY_FIELDS, (_barred() | changed).alias("__odd"))
    return not normalize_key_fields(plain).agg(F.max(F.col("__odd") | _barred())).first()[0]


def _grouped_by_key(condensed: DataFrame, *more: str) -> DataFrame:
    ledger_row = F.col("fonte").isin("C170", "bloco_h")
    return (
        with_item_key(condensed)
        .groupBy("cnpj", *more, KEY)
        .agg(
            *[F.min(name).alias(name) for name in ITEM_KEY_FIELDS],
            F.sum("valor_entrada").cast("double").alias("total_entradas"),
            F.sum("valor_saida").cast("double").alias("total_saidas"),
            F.sum("quantidade_entrada").cast("double").alias("qtd_entradas"),
            F.sum("quantidade_saida").cast("double").alias("qtd_saidas"),
            sorted_distinct(F.nullif(F.col("unidade"), F.lit(""))).alias("lista_unidades"),
            sorted_distinct(F.col("fonte")).alias("fonte"),
            F.min("ano").cast("string").alias("ano"),
            F.max(ledger_row | F.col("ano").isNull()).alias("__uses_base_year"),
        )
    )


def aggregate_items(rows: DataFrame, files: DataFrame | None = None, located: bool = False) -> DataFrame:
    """Group transactions by taxpayer and item key.

    Every line moves once.  Sums per raw item, the grouping by key and the join of the base year all find their rows
    where that move put them; the years, one row per taxpayer, are repeated for every part.

    ``located`` moves them to the part of their description and keeps that part as a column, so that steps by taxpayer,
    part and description need no move of their own.  Items whose fields hold a bar, usually none, then move again:
    by their key, and to the part of the description of the item.
    """
    if located:
        # an aggregate, so that no filter on it reaches below the move and lines are read once
        condensed = condense(by_description_part(rows), PART, barred=_barred())
        plain = _grouped_by_key(condensed.where("NOT barred"), PART)
        grouped = plain.unionByName(by_description_part(_grouped_by_key(condensed.where("barred"))))
    else:
        grouped = _grouped_by_key(condense(by_item_part(rows), PART), PART)
    if files is None:
        year: Column = F.coalesce("ano", F.lit(""))
    else:
        every = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias(PART)
        years = base_year(files).select("cnpj", "ano_base", every)
        grouped = grouped.join(years.hint("shuffle_hash"), ["cnpj", PART], "left")
        year = F.coalesce(
            F.least(F.col("ano"), F.when(F.col("__uses_base_year"), F.col("ano_base"))), F.col("ano_base"), F.lit("")
        )
    items = grouped.withColumn("ano", year).drop("__uses_base_year", "ano_base")
    return items if located else items.drop(PART)


def _display_order() -> list[Column]:
    return [*nulls_last(F.col("descricao")), *nulls_last(F.col("codigo")), F.col(KEY)]


def item_characteristics(rows: DataFrame, files: DataFrame | None = None, version: int = 2) -> DataFrame:
    """Item table.  Version 1 names items ``item_N``; version 2 keeps the hash key."""
    # numbering reads its input three times, twice the key columns alone; keys travel as 16 bytes, which have the order of their text
    items = aggregate_items(rows, files).withColumn(KEY, packed_key(F.col(KEY)))
    numbered = number_rows(stage(items), ["cnpj"], _display_order()).withColumn(KEY, unpacked_key(F.col(KEY)))
    sequence = numbered_id("item_")
    amounts = ("total_entradas", "total_saidas", "qtd_entradas", "qtd_saidas", "lista_unidades", "fonte")
    if version == 1:
        return numbered.select("cnpj", sequence.alias(KEY), *ITEM_KEY_FIELDS, *amounts)
    return numbered.select("cnpj", sequence.alias("item_seq_id"), KEY, *ITEM_KEY_FIELDS, *amounts, "ano")


def normalize_items(items: DataFrame) -> DataFrame:
    """Normalised copy: plain upper-case text, codes without zeros or dots."""
    rules = {
        "descricao": text.normalize,
        "descr_compl": text.normalize,
        "tipo_item": text.normalize,
        "ncm": text.remove_dots,
        "cest": text.remove_dots,
        "gtin": text.remove_dots,
        "lista_unidades": text.normalize_elements,
        "fonte": text.normalize_elements,
    }
    out: list[Column] = []
    for name in items.columns:
        out.append(rules[name](F.col(name)).alias(name) if name in rules else F.col(name))
        if name == "codigo":
            out.append(text.normalize_code(F.col("codigo")).alias("cod_normalizado"))
    if "descricao" in items.columns:
        out.append(text.normalize_description(F.col("descricao"), False).alias("descricao_normalizada"))
    return items.select(*out)


def normalize_key_fields(rows: DataFrame) -> DataFrame:
    """Key fields of transactions brought to the form used by the conversion jobs."""
    return rows.withColumns(
        {
            "codigo": text.normalize_code(F.col("codigo")),
            **{c: text.normalize(F.col(c)) for c in ("descricao", "descr_compl", "tipo_item")},
            **{c: text.remove_dots(F.col(c)) for c in ("ncm", "cest", "gtin")},
        }
    )


def classify_items(items: Iterable[DataFrame], tables: ClassificationTables) -> list[DataFrame]:
    """Add the inferred product code to every given item table."""
    return [classify(df, tables) for df in items]
