"""Unit-conversion factors, their quality and their use.

Transactions are summed per (item, unit) before they meet the item-to-product
bridge, so the bridge join moves one row per item and unit instead of every line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscoframe.functions.keys import item_key, packed_key, unpacked_key
from fiscoframe.functions.values import guarded_ratio
from fiscoframe.operators.aggregates import (
    first_non_null,
    largest_unit,
    longest,
)
from fiscoframe.operators.versioning import latest
from fiscoframe.plans.items import KEY, PART, description_part, in_parts, normalize_key_fields
from fiscoframe.plans.products import with_normalized_description
from fiscoframe.schemas import TOTAL, VALUE_FIELDS
from fiscoframe.session import by_leading_keys

PRODUCT = ["cnpj", "chave_produto"]
REFERENCE_OVER_UNIT, UNIT_OVER_REFERENCE = "reference/unit", "unit/reference"
MANUAL, AUTOMATIC = "manual", "automatico"


def item_unit_totals(rows: DataFrame, located: bool = False) -> DataFrame:
    """Amounts per item key (of the normalised fields, as it travels) and unit.

    Lines move once, by taxpayer and key, before they are summed: the product bridge meets the sums there.  ``located``
    moves them to the part of their description instead, where items and products lie, and keeps the part.
    """
    keyed = normalize_key_fields(rows).withColumns({KEY: packed_key(item_key()), PART: description_part()})
    place = ["cnpj", PART] if located else ["cnpj", KEY]
    moved = keyed.select("cnpj", PART, KEY, "unidade", "descricao", *VALUE_FIELDS).repartition(*place)
    return moved.groupBy("cnpj", *([PART] if located else []), KEY, "unidade").agg(
        *[F.sum(name).alias(name) for name in VALUE_FIELDS],
        F.min("descricao").alias("descricao"),
        F.count(F.lit(1)).alias("ocorrencias"),
    )


def merge_unit_totals(*periods: DataFrame) -> DataFrame:
    """Stored ``item_unit_totals`` of several periods as those of all their rows together.

    A new period costs a pass over its own rows and over the totals of earlier ones, never over earlier rows.
    """
    together, located = reduce(DataFrame.unionByName, periods), [PART] if PART in periods[0].columns else []
    return together.repartition("cnpj", *(located or [KEY])).groupBy("cnpj", *located, KEY, "unidade").agg(
        *[F.sum(name).cast(TOTAL).alias(name) for name in VALUE_FIELDS],
        F.min("descricao").alias("descricao"),
        F.sum("ocorrencias").alias("ocorrencias"),
    )


def product_bridge(product_table: DataFrame) -> DataFrame:
    """(product, item key) rows of a product table with list columns."""
    columns = set(product_table.columns)
    unit = F.col("unid_padrao") if "unid_padrao" in columns else F.lit(None).cast("string")
    score = F.col("score_confianca") if "score_confianca" in columns else F.lit(0.0)
    return product_table.select(
        *PRODUCT,
        *_part_of(product_table),
        unit.alias("unid_padrao"),
        score.alias("score_confianca_produto"),
        F.explode("lista_chave_item_individualizado").alias("__item"),
    )


def _part_of(table: DataFrame) -> list[str]:
    return [PART] if PART in table.columns else []


def rekey_items(items: DataFrame) -> DataFrame:
    """Stored item id -> key of the normalised fields used by transactions, both as they travel."""
    keyed = normalize_key_fields(items.withColumnRenamed(KEY, "__item"))
    return keyed.select("cnpj", *_part_of(items), packed_key(F.col("__item")).alias("__item"), packed_key(item_key()).alias(KEY))


def conversion_base(rows: DataFrame, product_table: DataFrame, items: DataFrame) -> DataFrame:
    """Amounts, mean prices and volume per product and unit.

    Where items and products carry their part, lines move there, once, and nothing else moves.
    """
    return base_of_totals(item_unit_totals(rows, in_parts(items, product_table)), product_table, items)


def base_of_totals(totals: DataFrame, product_table: DataFrame, items: DataFrame) -> DataFrame:
    """The same from amounts per item and unit, of one period or merged from several."""
    if PART in totals.columns:
        place = ["cnpj", PART]
    else:
        place, product_table, items = ["cnpj"], product_table.drop(PART), items.drop(PART)
    products = product_bridge(product_table).withColumns(
        {"chave_produto": packed_key(F.col("chave_produto")), "__item": packed_key(F.col("__item"))}
    )
    # rows move before they are grouped: by the key for this set and the next join, then by product for all that follows;
    # in their parts all of them are in place
    bridge = by_leading_keys(products).join(rekey_items(items), [*place, "__item"])
    bridge = bridge.select(*place, KEY, "chave_produto", "unid_padrao", "score_confianca_produto")
    bridge = (
        (bridge if PART in place else bridge.repartition("cnpj", KEY))
        .groupBy(*place, KEY, "chave_produto", "unid_padrao")
        .agg(F.max("score_confianca_produto").alias("score_confianca_produto"))
    )
    joined = totals.join(bridge, [*place, KEY]).drop(KEY).withColumn("chave_produto", unpacked_key(F.col("chave_produto")))
    joined = joined if PART in place else joined.repartition(*PRODUCT)
    grouped = joined.groupBy(*place, "chave_produto", "unidade", "unid_padrao").agg(
        F.sum("valor_entrada").alias("v_entr_total"),
        F.sum("quantidade_entrada").alias("q_entr_total"),
        F.sum("valor_saida").alias("v_saida_total"),
        F.sum("quantidade_saida").alias("q_saida_total"),
        F.max("score_confianca_produto").alias("score_confianca_produto"),
        F.sum("ocorrencias").alias("ocorrencias"),
        first_non_null(F.col("descricao"), F.col("descricao")).alias("descricao"),
        longest(F.col("descricao")).alias("descricao_longa"),
    )
    return with_prices(grouped)


def with_prices(grouped: DataFrame) -> DataFrame:
    """Guarded mean prices and absolute volume of (product, unit) totals."""
    out = grouped.withColumns(
        {
            "preco_medio_entrada": guarded_ratio(F.col("v_entr_total"), F.col("q_entr_total")),
            "preco_medio_saida": guarded_ratio(F.col("v_saida_total"), F.col("q_saida_total")),
            "volume_total": (F.abs("q_entr_total") + F.abs("q_saida_total")).cast("double"),
        }
    )
    totals = ("v_entr_total", "q_entr_total", "v_saida_total", "q_saida_total")
    return out.withColumns({name: F.col(name).cast("double") for name in totals})


def with_reference(base: DataFrame) -> DataFrame:
    """Reference unit of each product, its prices and the number of units, on every row of the product.

    The chosen unit wins; otherwise the unit with the largest volume.  A chosen unit
    that never occurs has no prices.  A product has few units, so its rows meet in one window and
    the base is read once.
    """
    product = Window.partitionBy("cnpj", *_part_of(base), "chave_produto")
    row = F.struct(
        F.col("unidade"), F.col("preco_medio_entrada").alias("ent"), F.col("preco_medio_saida").alias("sai")
    )
    picked = base.withColumns(
        {
            "__chosen": F.max("unid_padrao").over(product),
            "__chosen_row": F.max(F.when(F.col("unidade") == F.col("unid_padrao"), row)).over(product),
            "__auto_row": largest_unit(row, F.col("volume_total")).over(product),
            "__longest": F.min_by("descricao_longa", F.struct(-F.length("descricao_longa"), "descricao_longa")).over(product),
            "__units": F.count(F.lit(1)).over(product),
        }
    )
    prices = F.when(F.col("__chosen").isNotNull(), F.col("__chosen_row")).otherwise(F.col("__auto_row"))
    found = picked.withColumns(
        {
            "unid_ref": F.coalesce("__chosen", "__auto_row.unidade"),
            "preco_ref_ent": prices["ent"],
            "preco_ref_sai": prices["sai"],
        }
    )
    return found.drop("__chosen", "__chosen_row", "__auto_row")


def unit_factor(unit: str, reference: str, direction: str = REFERENCE_OVER_UNIT) -> Column:
    """1 for the reference unit, else the ratio of purchase, else of sale prices, else 0."""

    def ratio(ref: str, own: str) -> Column:
        up, down = (ref, own) if direction == REFERENCE_OVER_UNIT else (own, ref)
        return F.try_divide(F.col(up), F.col(down))

    def usable(ref: str, own: str) -> Column:
        return (F.col(ref) > 0) & (F.col(own) > 0)

    return (
        F.when(F.col(unit) == F.col(reference), F.lit(1.0))
        .when(usable("preco_ref_ent", "preco_medio_entrada"), ratio("preco_ref_ent", "preco_medio_entrada"))
        .when(usable("preco_ref_sai", "preco_medio_saida"), ratio("preco_ref_sai", "preco_medio_saida"))
        .otherwise(F.lit(0.0))
    )


def quality_status(factor: Column, units: Column) -> Column:
    return (
        F.when(factor <= 0, "Erro: Fator <= 0")
        .when((factor > 1000) | (factor < 0.001), "Alerta: Fator Extremo")
        .when(units > 5, "Alerta: Fragmentação")
        .otherwise("OK")
    )


def confidence(volume: Column, score: Column) -> Column:
    return volume / (volume + 1.0) * 0.6 + F.coalesce(score, F.lit(0.0)) * 0.4


def validation_status(factor: Column, score: Column) -> Column:
    return (
        F.when(factor <= 0, "erro")
        .when((factor > 1000) | (factor < 0.001), "extremo")
        .when(score >= 0.85, "auto_aprovavel")
        .when(score >= 0.65, "revisar")
        .otherwise("baixa_confianca")
    )


def with_manual_factors(
    factors: DataFrame, manual: DataFrame | None, computed: str, automatic: str = AUTOMATIC
) -> DataFrame:
    """Manual factors win; the source of each factor is recorded."""
    if manual is None:
        return factors.withColumns({"fator_de_conversao": F.col(computed), "fonte_fator": F.lit(automatic)})
    keys = [k for k in ("cnpj", "chave_produto", "unidade") if k in manual.columns]
    by_hand = manual.groupBy(*keys).agg(F.max("fator_conversao_manual").alias("__manual"))
    given = F.col("__manual")
    return (
        factors.join(by_hand, keys, "left")
        .withColumns(
            {
                "fator_de_conversao": F.coalesce(given, F.col(computed)),
                "fonte_fator": F.when(given.isNotNull(), MANUAL).otherwise(automatic),
            }
        )
        .drop("__manual")
    )


def conversion_factors(base: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Factors of products that use several units, with a quality status."""
    joined = with_reference(base).withColumn("__f", unit_factor("unidade", "unid_ref"))
    out = joined.where(F.col("__units") > 1).select(
        *PRODUCT,
        F.col("__longest").alias("descricao"),
        "unidade",
        F.col("unid_ref").alias("unid_padrao"),
        "v_entr_total",
        "v_saida_total",
        "preco_medio_entrada",
        "preco_medio_saida",
        F.col("__f").alias("fator_de_conversao"),
        quality_status(F.col("__f"), F.col("__units")).alias("status_qualidade"),
    )
    return with_manual_factors(out, manual, "fator_de_conversao", "automático")


def conversion_factors_v2(base: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Suggested factor, confidence and validation status of every product and unit."""
    scored = with_reference(base).withColumns(
        {
            "fator_sugerido": unit_factor("unidade", "unid_ref"),
            "score_confianca": confidence(F.col("volume_total"), F.col("score_confianca_produto")),
        }
    )
    out = scored.select(
        *PRODUCT,
        "descricao",
        "unidade",
        F.col("unid_ref").alias("unid_padrao"),
        "v_entr_total",
        "q_entr_total",
        "v_saida_total",
        "q_saida_total",
        "preco_medio_entrada",
        "preco_medio_saida",
        "volume_total",
        "fator_sugerido",
        "score_confianca",
        validation_status(F.col("fator_sugerido"), F.col("score_confianca")).alias("status_validacao"),
    )
    return with_manual_factors(out, manual, "fator_sugerido")


def review_queue(factors: DataFrame) -> DataFrame:
    """Factors that a person has to check."""
    factor = F.col("fator_de_conversao")
    return factors.where(
        (F.col("status_validacao") != "auto_aprovavel") | (factor <= 0) | (factor > 1000) | (factor < 0.001)
    )


def review_order() -> list[Column]:
    return [F.col("status_validacao"), F.col("score_confianca"), F.col("chave_produto"), F.col("unidade")]


def mean_unit_prices(movements: DataFrame, located: bool = False) -> DataFrame:
    """Mean of positive purchases and of positive sales per description and unit.

    Lines are summed per raw description first, which is then normalised once.  ``located`` moves the lines to the task
    of their normalised description instead, whatever the unit, for steps that compare its units.
    """
    raw = "descricao_normalizada" if "descricao_normalizada" in movements.columns else "descricao"
    if located:
        described = movements if raw == "descricao_normalizada" else with_normalized_description(movements)
        raw = "descricao_normalizada"
        movements = described.select("cnpj", raw, "unid", "compras", "vendas").repartition("cnpj", raw)

    def parts(name: str) -> list[Column]:
        positive = F.when(F.col(name) > 0, F.col(name))
        return [F.sum(positive).alias(f"__sum_{name}"), F.count(positive).alias(f"__rows_{name}")]

    partial = movements.groupBy("cnpj", raw, "unid").agg(
        *parts("compras"), *parts("vendas"), F.count(F.lit(1)).alias("movimentos")
    )
    if raw == "descricao":
        partial = with_normalized_description(partial)

    def mean(name: str, out: str) -> Column:
        total = F.sum(f"__sum_{name}").cast("double")
        return F.coalesce(F.try_divide(total, F.sum(f"__rows_{name}").cast("double")), F.lit(0.0)).alias(out)

    return partial.groupBy("cnpj", "descricao_normalizada", "unid").agg(
        mean("compras", "preco_medio_compra"),
        mean("vendas", "preco_medio_venda"),
        F.sum("movimentos").alias("movimentos"),
    )


def most_used_unit(prices: DataFrame) -> DataFrame:
    """Unit with most movements per description, ties alphabetical."""
    return prices.groupBy("cnpj", "descricao_normalizada").agg(
        F.min_by("unid", F.struct(-F.col("movimentos"), "unid")).alias("unid_ref")
    )


def legacy_factors(product_table: DataFrame, movements: DataFrame) -> DataFrame:
    """Factors from mean prices per movement, unit over reference.

    Only products, rows of the product table, with several units; pairs without usable prices are left out.
    """
    key = ["cnpj", "descricao_normalizada"]
    # a description has few units: one window gives its most used unit with the prices of that unit
    of_description = Window.partitionBy(*key)
    row = F.struct(
        F.col("unid"), F.col("preco_medio_compra").alias("compra"), F.col("preco_medio_venda").alias("venda")
    )
    most_used = F.min_by(row, F.struct(-F.col("movimentos"), "unid")).over(of_description)
    # both sides move once, by description, where units are priced, compared and found
    prices = mean_unit_prices(movements, located=True).withColumn("__ref", most_used)
    wide = product_table.select(*key, "chave_produto", F.col("descricao").alias("descr_padrao"), "lista_unid").repartition(*key)
    wide = wide.withColumn("unid", F.explode("lista_unid")).drop("lista_unid")
    priced = by_leading_keys(wide).join(prices, [*key, "unid"]).withColumn("__units", F.count(F.lit(1)).over(Window.partitionBy(*key, "chave_produto")))
    own = priced.where((F.col("__units") > 1) & (F.col("__ref.unid") != ""))
    ref_compra, ref_venda = F.col("__ref.compra"), F.col("__ref.venda")
    compra = (F.col("preco_medio_compra") > 0) & (ref_compra > 0)
    venda = (F.col("preco_medio_venda") > 0) & (ref_venda > 0)
    factor = (
        F.when(F.col("unid") == F.col("__ref.unid"), F.lit(1.0))
        .when(compra, F.try_divide("preco_medio_compra", ref_compra))
        .when(venda, F.try_divide("preco_medio_venda", ref_venda))
    )
    return (
        own.withColumn("fator", factor)
        .where(F.col("fator").isNotNull())
        .select("cnpj", F.col("chave_produto").alias("id_produtos"), "descr_padrao", "unid", F.col("__ref.unid").alias("unid_ref"), "fator")
    )


def apply_conversion(
    movements: DataFrame, factors: DataFrame, quantity: str = "quantidade", value: str = "valor"
) -> DataFrame:
    """Quantity times factor and price over factor; the value does not change.

    Factors are unit over reference.  Movements without a usable factor keep 1.
    """
    known = factors.select(
        *PRODUCT, "unidade", F.col("fator_de_conversao").alias("__factor"), F.col("unid_padrao").alias("__ref")
    )
    factor = F.when(F.col("__factor") > 0, F.col("__factor")).otherwise(F.lit(1.0))
    converted = F.col(quantity).cast("double") * factor
    return (
        movements.join(known, [*PRODUCT, "unidade"], "left")
        .withColumns(
            {
                "quantidade_convertida": converted,
                "preco_convertido": F.try_divide(F.col(value).cast("double"), converted),
                "unidade_convertida": F.coalesce("__ref", "unidade"),
            }
        )
        .drop("__factor", "__ref")
    )


def invert_factors(factors: DataFrame) -> DataFrame:
    """Turn reference/unit factors into unit/reference ones, and back."""
    return factors.withColumn("fator_de_conversao", F.coalesce(F.try_divide(F.lit(1.0), "fator_de_conversao"), F.lit(0.0)))


def deduplicate_movements(
    movements: DataFrame, keys: tuple[str, ...] = ("chave_acesso", "num_item"), order: list[Column] | None = None
) -> DataFrame:
    """One movement per document and item."""
    rest = [F.col(c).asc() for c in movements.columns if c not in keys]
    return latest(movements, list(keys), order or rest)


def price_volatility(movements: DataFrame, threshold: float, price: str = "preco") -> DataFrame:
    """Coefficient of variation of the price per product and unit, with an alert above the threshold.

    The alert compares nine places, so that a ratio equal to the threshold raises none however its sums were rounded.
    """
    value = F.col(price).cast("double")
    grouped = movements.groupBy(*PRODUCT, "unidade").agg(
        F.avg(value).alias("preco_medio"), F.stddev_samp(value).alias("desvio"), F.count(value).alias("movimentos")
    )
    variation = F.try_divide("desvio", "preco_medio")
    return grouped.withColumns(
        {"coef_variacao": variation, "volatil": F.coalesce(F.round(variation, 9) > threshold, F.lit(False))}
    )
