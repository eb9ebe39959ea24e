"""Description tables, codes with several descriptions, consolidated products.

List columns hold the distinct values of one description of one taxpayer; the
values are made distinct on the map side before they are collected.
:func:`description_members` gives the same relation in rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions.keys import set_key
from fiscoframe.operators.aggregates import (
    mode_of_list,
    modes,
    most_words_of_list,
    sorted_distinct,
    sorted_distinct_flat,
)
from fiscoframe.operators.predicates import not_blank
from fiscoframe.operators.ranking import number_rows
from fiscoframe.plans.items import KEY, PART
from fiscoframe.schemas import TOTAL
from fiscoframe.session import by_leading_keys

_DEFAULTS = {
    "ncm_padrao": "lista_ncm",
    "cest_padrao": "lista_cest",
    "gtin_padrao": "lista_gtin",
    "tipo_item_padrao": "lista_tipo_item",
    "unid_padrao": "lista_unids",
}


def _total(name: str) -> Column:
    return F.sum(F.col(name).cast(TOTAL)).cast("double").alias(name)


def _lists(items: DataFrame, mapping: dict[str, str]) -> list[Column]:
    return [
        sorted_distinct(F.col(old)).alias(new) for old, new in mapping.items() if old in items.columns
    ]


def _mode_columns(
    items: DataFrame, group: str, defaults: dict[str, str], sources: dict[str, str], mode_over: str
) -> tuple[list[Column], DataFrame | None]:
    """Default-value columns, from the lists or (``rows``) from the item rows."""
    if mode_over == "distinct":
        return [mode_of_list(F.col(lst)).alias(name) for name, lst in defaults.items()], None
    if mode_over != "rows":
        raise ValueError("mode_over is 'distinct' or 'rows'")
    attributes = {name: sources[lst] for name, lst in defaults.items()}
    return [F.col(name) for name in defaults], modes(items, _keys(items, group), attributes)


def _by_description(items: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Items moved once, as plain rows, to the task that groups their description.

    Few items share a description, so sets collected before the move would reduce nothing and weigh several times
    the rows.  What follows by taxpayer and description finds the rows there.  Located items are there already.
    """
    kept = [c for c in dict.fromkeys(columns) if c in items.columns and c not in ("cnpj", group)]
    if PART in items.columns:
        return items.select("cnpj", PART, group, *kept)
    return items.select("cnpj", group, *kept).repartition("cnpj", group)


def _keys(items: DataFrame, group: str) -> list[str]:
    return ["cnpj", *([PART] if PART in items.columns else []), group]


def _placed(table: DataFrame, located: bool) -> DataFrame:
    return table if located else table.drop(PART)


def descriptions(items: DataFrame, mode_over: str = "distinct", located: bool = False) -> DataFrame:
    """Products by exact (normalised) description.

    ``located`` keeps the part of located items, so that later steps find products and items in one place.
    """
    lists = {
        "descr_compl": "lista_descr_compl",
        "tipo_item": "lista_tipo_item",
        "ncm": "lista_ncm",
        "cest": "lista_cest",
        "gtin": "lista_gtin",
        "co_sefin_inferido": "lista_co_sefin_inferido",
    }
    aggregates = [
        sorted_distinct(F.col(KEY)).alias("lista_chave_item_individualizado"),
        sorted_distinct(F.col("cod_normalizado")).alias("lista_cod_normalizado"),
        _total("total_entradas"),
        _total("total_saidas"),
        *_lists(items, lists),
        sorted_distinct_flat(F.col("lista_unidades")).alias("lista_unids"),
        sorted_distinct_flat(F.col("fonte")).alias("lista_fonte"),
    ]
    sources = {new: old for old, new in lists.items()} | {"lista_unids": "lista_unidades"}
    items = _by_description(
        items, "descricao", [KEY, "cod_normalizado", "total_entradas", "total_saidas", *lists, "lista_unidades", "fonte"]
    )
    columns, extra = _mode_columns(items, "descricao", _DEFAULTS, sources, mode_over)
    grouped = items.groupBy(*_keys(items, "descricao")).agg(*aggregates)
    if extra is not None:
        grouped = by_leading_keys(grouped).join(extra, _keys(items, "descricao"), "left")
    grouped = _placed(grouped, located)
    more = []
    if "co_sefin_inferido" in items.columns:
        more = [
            mode_of_list(F.col("lista_co_sefin_inferido")).alias("co_sefin_agr"),
            (F.size("lista_co_sefin_inferido") > 1).alias("co_sefin_agr_divergente"),
        ]
    kept = [c for c in grouped.columns if c not in _DEFAULTS]
    return grouped.select(
        *kept,
        *columns,
        set_key(F.col("lista_chave_item_individualizado")).alias("chave_produto"),
        F.lit(False).alias("verificado"),
        *more,
    )


def descriptions_v2(items: DataFrame, mode_over: str = "distinct", located: bool = False) -> DataFrame:
    """Products by normalised description, with a representative and a score; ``located`` as for :func:`descriptions`."""
    if "descricao_normalizada" not in items.columns:
        items = items.withColumn("descricao_normalizada", F.trim(F.upper("descricao")))
    lists = {
        "descr_compl": "lista_descr_compl",
        "tipo_item": "lista_tipo_item",
        "ncm": "lista_ncm",
        "cest": "lista_cest",
        "gtin": "lista_gtin",
        "co_sefin_inferido": "lista_co_sefin_inferido",
        "item_seq_id": "lista_item_seq_id",
    }
    unit = "lista_unidades" if "lista_unidades" in items.columns else "unidade"
    units = sorted_distinct_flat(F.col(unit)) if unit == "lista_unidades" else sorted_distinct(F.col(unit))
    if "co_sefin_inferido" not in items.columns:
        items = items.withColumn("co_sefin_inferido", F.lit(None).cast("string"))
    amounts = ("total_entradas", "total_saidas", "qtd_entradas", "qtd_saidas")
    aggregates = [
        sorted_distinct(F.col(KEY)).alias("lista_chave_item_individualizado"),
        sorted_distinct(F.col("codigo")).alias("lista_codigos"),
        sorted_distinct(F.col("descricao")).alias("lista_descricoes_originais"),
        *[_total(c) for c in amounts],
        F.count(F.lit(1)).alias("qtd_itens_origem"),
        *_lists(items, lists),
        units.alias("lista_unids"),
        sorted_distinct_flat(F.col("fonte")).alias("lista_fonte"),
    ]
    defaults = {**_DEFAULTS, "codigo_padrao": "lista_codigos"}
    sources = {new: old for old, new in lists.items()} | {"lista_unids": unit, "lista_codigos": "codigo"}
    items = _by_description(
        items, "descricao_normalizada", [KEY, "codigo", "descricao", *amounts, *lists, unit, "fonte"]
    )
    columns, extra = _mode_columns(items, "descricao_normalizada", defaults, sources, mode_over)
    grouped = items.groupBy(*_keys(items, "descricao_normalizada")).agg(*aggregates)
    if extra is not None:
        grouped = by_leading_keys(grouped).join(extra, _keys(items, "descricao_normalizada"), "left")
    grouped = _placed(grouped, located)
    count = F.col("qtd_itens_origem")
    kept = [c for c in grouped.columns if c not in defaults]
    return grouped.select(
        *kept,
        most_words_of_list(F.col("lista_descricoes_originais")).alias("descricao_representativa"),
        *columns,
        set_key(F.col("lista_chave_item_individualizado")).alias("chave_produto"),
        F.lit(False).alias("verificado"),
        mode_of_list(F.col("lista_co_sefin_inferido")).alias("co_sefin_agr"),
        (F.size("lista_co_sefin_inferido") > 1).alias("co_sefin_agr_divergente"),
        (count / (count + 1.0)).alias("score_consistencia"),
    )


def description_members(items: DataFrame, group: str = "descricao_normalizada") -> DataFrame:
    """(taxpayer, description, item) rows: the list column without collecting."""
    return items.select("cnpj", group, KEY).distinct()


def _several_descriptions(items: DataFrame) -> DataFrame:
    """Items whose code has more than one description; a null counts as one."""
    rows = items.where(not_blank(F.col("cod_normalizado"))).select("cnpj", "cod_normalizado", KEY, "descricao")
    counts = (
        rows.groupBy("cnpj", "cod_normalizado")
        .agg(
            (F.count_distinct("descricao") + F.max(F.col("descricao").isNull().cast("int"))).alias("qtd_descr")
        )
        .where(F.col("qtd_descr") > 1)
    )
    return rows.join(counts, ["cnpj", "cod_normalizado"])


def code_suffixes(items: DataFrame) -> DataFrame:
    """One row per item of such codes with its running suffix ``code__n``."""
    order = [F.col("descricao"), F.col(KEY)]
    numbered = number_rows(_several_descriptions(items), ["cnpj", "cod_normalizado"], order)
    suffix = F.concat(F.col("cod_normalizado"), F.lit("__"), F.col("seq").cast("string"))
    return numbered.withColumn("cods_desagregados", suffix)


def codes_with_several_descriptions(items: DataFrame) -> DataFrame:
    """The same as one row per code; the suffix is the position in the sorted list.

    Items are read once and moved once, as plain rows, to the task of their code, which lists and counts them.
    """
    rows = items.where(not_blank(F.col("cod_normalizado"))).select("cnpj", "cod_normalizado", KEY, "descricao")
    entry = F.struct(F.col("descricao"), F.col(KEY))
    code = F.col("cod_normalizado")
    # a null description counts as one
    different = F.size(F.array_distinct(F.transform("entries", lambda e: e["descricao"]))).cast("bigint")
    grouped = (
        rows.repartition("cnpj", "cod_normalizado")
        .groupBy("cnpj", "cod_normalizado")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .withColumn("qtd_descr", different)
        .where(F.col("qtd_descr") > 1)
    )
    return grouped.select(
        "cnpj",
        "cod_normalizado",
        F.transform("entries", lambda e: e[KEY]).alias("lista_chave_item_individualizado"),
        F.transform("entries", lambda e: e["descricao"]).alias("lista_descricao"),
        F.transform("entries", lambda e, i: F.concat(code, F.lit("__"), (i + 1).cast("string"))).alias(
            "cods_desagregados"
        ),
        "qtd_descr",
    )


# The consolidated product table, in order.
CONSOLIDATED_COLUMNS = (
    "chave_id",
    "chave_produto",
    "lista_chave_produto",
    "descricao_normalizada",
    "descricao_final",
    "descricao_padrao",
    "codigo_padrao",
    "ncm_padrao",
    "cest_padrao",
    "gtin_padrao",
    "tipo_item_padrao",
    "unid_padrao",
    "co_sefin_padrao",
    "co_sefin_divergente",
    "lista_chave_item_individualizado",
    "lista_item_seq_id",
    "lista_codigos",
    "lista_descricoes_originais",
    "lista_ncm",
    "lista_cest",
    "lista_gtin",
    "lista_tipo_item",
    "lista_unids",
    "lista_co_sefin_inferido",
    "total_entradas",
    "total_saidas",
    "qtd_entradas",
    "qtd_saidas",
    "qtd_itens_origem",
    "score_confianca",
    "origem_agregacao",
    "status_revisao",
    "verificado_manualmente",
    "usuario_verificacao",
    "data_verificacao",
    "observacao_revisor",
)


def consolidated_products(described: DataFrame) -> DataFrame:
    """Product master with review fields, from either description table; located products keep their part."""
    columns = set(described.columns)
    if "descricao_representativa" not in columns:
        source = "descricao" if "descricao" in columns else "descricao_normalizada"
        described = described.withColumn("descricao_representativa", F.col(source))
    optional = {
        "descricao_normalizada": F.col("descricao_representativa"),
        "lista_item_seq_id": F.array().cast("array<string>"),
        "lista_codigos": F.array().cast("array<string>"),
        "lista_descricoes_originais": F.array("descricao_representativa"),
        "lista_co_sefin_inferido": F.array().cast("array<string>"),
        "codigo_padrao": F.lit(None).cast("string"),
        "co_sefin_agr": F.lit(None).cast("string"),
        "co_sefin_agr_divergente": F.lit(None).cast("boolean"),
        "score_consistencia": F.lit(None).cast("double"),
        "qtd_entradas": F.lit(None).cast("double"),
        "qtd_saidas": F.lit(None).cast("double"),
        "qtd_itens_origem": F.lit(None).cast("bigint"),
    }
    described = described.withColumns({k: v for k, v in optional.items() if k not in columns})
    key = F.col("chave_produto")
    singleton = F.when(not_blank(key), F.array(key)).otherwise(F.array().cast("array<string>"))
    nothing = F.lit(None).cast("string")
    derived = {
        "lista_chave_produto": singleton,
        "chave_id": set_key(singleton),
        "descricao_final": F.col("descricao_representativa"),
        "descricao_padrao": F.col("descricao_representativa"),
        "co_sefin_padrao": F.col("co_sefin_agr"),
        "co_sefin_divergente": F.coalesce("co_sefin_agr_divergente", F.lit(False)),
        "score_confianca": F.coalesce("score_consistencia", F.lit(0.0)),
        "origem_agregacao": F.lit("automatico"),
        "status_revisao": F.lit("pendente"),
        "verificado_manualmente": F.lit(False),
        "usuario_verificacao": nothing,
        "data_verificacao": nothing,
        "observacao_revisor": nothing,
    }
    place = [PART] if PART in columns else []
    return described.withColumns(derived).select("cnpj", *place, *CONSOLIDATED_COLUMNS)
