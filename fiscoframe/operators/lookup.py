"""Classification lookups: prioritised fallback and dated attributes.

Reference tables are reduced to one row per key before the joins, so a lookup
never multiplies rows.  No broadcast hint is given: whether a reference table is
small enough is decided from its measured size when the plan runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions.text import bare_key

# Tax attributes read by product code and date.
TAX_ATTRIBUTES = (
    "it_pc_interna",
    "it_in_st",
    "it_pc_mva",
    "it_in_mva_ajustado",
    "it_in_convenio",
    "it_in_isento_icms",
    "it_in_reducao",
    "it_pc_reducao",
    "it_in_reducao_credito",
    "it_in_pmpf",
)


@dataclass(frozen=True)
class ClassificationTables:
    """The reference tables; ``products`` and ``attributes`` are optional."""

    by_cest_and_ncm: DataFrame
    by_cest: DataFrame
    by_ncm: DataFrame
    products: DataFrame | None = None
    attributes: DataFrame | None = None


def _unique(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Smallest value per key, keys not null."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def classify(
    items: DataFrame,
    tables: ClassificationTables,
    ncm: str = "ncm",
    cest: str = "cest",
    clean: bool = True,
    name: str = "co_sefin_inferido",
    keep_levels: bool = False,
) -> DataFrame:
    """Product code by (cest, ncm), else by cest, else by ncm.

    ``clean`` strips dots and blanks from the keys of both sides; otherwise raw
    codes are compared.
    """
    key = bare_key if clean else (lambda c: c.cast("string"))
    both = _unique(
        tables.by_cest_and_ncm.select(
            key(F.col("it_nu_cest")).alias("__cest"),
            key(F.col("it_nu_ncm")).alias("__ncm"),
            F.col("it_co_sefin").cast("string").alias("__level1"),
        ),
        ["__cest", "__ncm"],
        "__level1",
    )
    by_cest = _unique(
        tables.by_cest.select(
            key(F.col("cest")).alias("__cest"), F.col("`co-sefin`").cast("string").alias("__level2")
        ),
        ["__cest"],
        "__level2",
    )
    by_ncm = _unique(
        tables.by_ncm.select(
            key(F.col("ncm")).alias("__ncm"), F.col("`co-sefin`").cast("string").alias("__level3")
        ),
        ["__ncm"],
        "__level3",
    )
    joined = (
        items.withColumn("__ncm", key(F.col(ncm)))
        .withColumn("__cest", key(F.col(cest)))
        .join(both, ["__cest", "__ncm"], "left")
        .join(by_cest, ["__cest"], "left")
        .join(by_ncm, ["__ncm"], "left")
    )
    levels = ["__level1", "__level2", "__level3"]
    kept = [c for c in items.columns if c != name]
    extra = [F.col(c).alias(c.strip("_")) for c in levels] if keep_levels else []
    return joined.select(*kept, F.coalesce(*levels).alias(name), *extra)


def product_name(items: DataFrame, products: DataFrame, code: str, name: str) -> DataFrame:
    """Name of the product code in ``code``."""
    names = _unique(
        products.select(F.col("it_co_sefin").cast("string").alias("__code"), F.col("it_no_produto").alias(name)),
        ["__code"],
        name,
    )
    return items.join(names, F.col(code).cast("string") == F.col("__code"), "left").drop("__code")


def reference_date(*dates: Column) -> Column:
    """Greatest non-null date as ``YYYYMMDD``."""
    latest = F.greatest(*dates) if len(dates) > 1 else dates[0]
    return F.date_format(latest, "yyyyMMdd")


def dated_attributes(
    items: DataFrame,
    attributes: DataFrame,
    code: str,
    reference: Column,
    suffix: str,
    columns: Sequence[str] = TAX_ATTRIBUTES,
) -> DataFrame:
    """Attributes in force at the reference date; rows without a match get nulls.

    One left join on the code with the interval as a residual condition.  An open
    end is null or blank.
    """
    present = [c for c in columns if c in attributes.columns]
    dated = attributes.select(
        F.col("it_co_sefin").cast("string").alias("__code"),
        F.col("it_da_inicio").cast("string").alias("__from"),
        F.col("it_da_final").cast("string").alias("__to"),
        *[F.col(c).alias(f"{c}_{suffix}") for c in present],
    )
    rows = items.withColumn("__ref", reference)
    in_force = F.col("__from").isNull() | (
        (F.col("__ref") >= F.col("__from"))
        & (F.col("__to").isNull() | (F.trim("__to") == "") | (F.col("__ref") <= F.col("__to")))
    )
    matched = rows.join(dated, (F.col(code).cast("string") == F.col("__code")) & in_force, "left")
    return matched.drop("__code", "__from", "__to", "__ref")


def classify_goods(
    items: DataFrame,
    tables: ClassificationTables,
    ncm: str = "ncm",
    cest: str = "cest",
    extra_code: str | None = None,
    issue_date: str | None = None,
    movement_date: str | None = None,
    extra_suffix: str = "fronteira",
) -> DataFrame:
    """Raw-code classification with names and, if dates are given, dated attributes."""
    needed = [tables.by_cest_and_ncm, tables.by_cest, tables.by_ncm, tables.products]
    dated = issue_date is not None and movement_date is not None
    if dated:
        needed.append(tables.attributes)
    if any(table is None for table in needed):
        raise FileNotFoundError("a classification reference table is missing")
    out = classify(items, tables, ncm, cest, clean=False)
    out = product_name(out, tables.products, "co_sefin_inferido", "descr_co_sefin_inferido")
    has_extra = extra_code is not None and extra_code in items.columns
    if has_extra:
        out = out.withColumn(extra_code, F.col(extra_code).cast("string"))
        out = product_name(out, tables.products, extra_code, f"descr_{extra_code}")
    if dated:
        moment = reference_date(F.col(issue_date), F.col(movement_date))
        out = dated_attributes(out, tables.attributes, "co_sefin_inferido", moment, "inferido")
        if has_extra:
            out = dated_attributes(out, tables.attributes, extra_code, moment, extra_suffix)
    return out
