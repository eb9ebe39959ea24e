"""Readers that bring documents, ledger items and inventories to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions.values import net_item_value, preferred_gtin
from fiscoframe.schemas import MANUAL_FACTOR, MOVEMENT, TRANSACTION, conform, first_present, measure


_LEDGER_ALIASES = {
    "codigo": ("cod_item",),
    "descricao": ("descr_item",),
    "ncm": ("cod_ncm",),
    "gtin": ("cod_barra",),
    "unidade": ("unid",),
}
_INVENTORY_ALIASES = {
    "codigo": ("codigo_produto", "codigo_produto_original"),
    "descricao": ("descricao_produto",),
    "ncm": ("cod_ncm",),
    "gtin": ("cod_barra",),
    "unidade": ("unidade_medida",),
    "unid": ("unidade_medida",),
}
_INVOICE_ALIASES = {
    "cnpj": ("co_emitente",),
    "codigo": ("prod_cprod",),
    "descricao": ("prod_xprod",),
    "ncm": ("prod_ncm",),
    "cest": ("prod_cest",),
    "unidade": ("prod_ucom",),
    "unid": ("prod_ucom",),
}


def no_amount() -> Column:
    return measure(F.lit(0))


def only_cfop(df: DataFrame, cfop: DataFrame | None) -> DataFrame:
    """Keep operations whose code is listed; no list or no code column keeps all.

    A condition, not a join, so that Spark applies it to the table that holds the code, below the joins of a view.
    """
    code = first_present(df, "co_cfop", "cfop")
    if cfop is None or code is None:
        return df
    listed = cfop.select(F.col("co_cfop").cast("string").alias("__cfop"))
    return df.where(F.col(code).cast("string").isin(listed))


def outgoing(df: DataFrame) -> DataFrame:
    """Outgoing documents of the issuer; accepts ``1`` as well as ``1 - SAIDA``.

    An extracted table holds a document once per party; only the issuer's row counts.
    """
    if "cnpj_filtro" in df.columns:
        df = df.where(F.col("cnpj_filtro") == F.col("co_emitente"))
    kind = first_present(df, "tipo_operacao", "co_tp_nf", "tp_nf")
    return df if kind is None else df.where(F.substring(F.col(kind).cast("string"), 1, 1) == "1")


def _issue_year(df: DataFrame) -> Column:
    moment = first_present(df, "ide_dh_emi", "dhemi")
    return F.substring(F.col(moment).cast("string"), 1, 4) if moment else F.lit(None).cast("string")


def read_invoice_items(df: DataFrame, source: str, cfop: DataFrame | None = None) -> DataFrame:
    """Sold items of the issuing taxpayer (electronic or retail invoices)."""
    rows = only_cfop(outgoing(df), cfop)
    rows = (
        rows.withColumn("valor_saida", net_item_value(df))
        .withColumn("quantidade_saida", measure(F.col("prod_qcom")))
        .withColumn("gtin", preferred_gtin(df))
        .withColumn("ano", _issue_year(df))
        .withColumn("fonte", F.lit(source))
    )
    out = conform(rows.drop("cnpj", "descr_compl", "tipo_item"), TRANSACTION, _INVOICE_ALIASES)
    return out.withColumns({"valor_entrada": no_amount(), "quantidade_entrada": no_amount()})


def read_ledger_items(df: DataFrame, cfop: DataFrame | None = None, source: str = "C170") -> DataFrame:
    """Ledger items; value and quantity go to purchases or sales by direction.

    All four amounts are computed in one projection from the original columns.
    The year of ledger rows is the taxpayer's base year and is added later.
    """
    rows = only_cfop(df, cfop)
    direction = F.col("ind_oper").cast("string")
    value = measure(F.col("vl_item")) if "vl_item" in df.columns else measure(F.lit(None))
    quantity = measure(F.col("qtd")) if "qtd" in df.columns else measure(F.lit(None))

    def when(code: str, amount: Column) -> Column:
        return F.when(direction == code, amount).otherwise(no_amount())

    rows = rows.withColumns(
        {
            "valor_entrada": when("0", value),
            "quantidade_entrada": when("0", quantity),
            "valor_saida": when("1", value),
            "quantidade_saida": when("1", quantity),
            "fonte": F.lit(source),
            "ano": F.lit(None).cast("string"),
        }
    )
    return conform(rows, TRANSACTION, _LEDGER_ALIASES)


def read_inventory_items(df: DataFrame, source: str = "bloco_h") -> DataFrame:
    """Inventory lines as a source of item characteristics, without amounts."""
    rows = df.drop("descr_compl", "quantidade").withColumn("fonte", F.lit(source))
    out = conform(rows, TRANSACTION, _INVENTORY_ALIASES)
    zero = no_amount()
    return out.withColumns(
        {
            "valor_entrada": zero,
            "valor_saida": zero,
            "quantidade_entrada": zero,
            "quantidade_saida": zero,
        }
    )


def read_invoice_movements(df: DataFrame, cfop: DataFrame | None = None) -> DataFrame:
    """Sales per unit."""
    rows = (
        only_cfop(outgoing(df), cfop)
        .withColumn("vendas", net_item_value(df))
        .withColumn("compras", no_amount())
        .withColumn("gtin", preferred_gtin(df))
    )
    return conform(rows.drop("cnpj", "descr_compl", "tipo_item"), MOVEMENT, _INVOICE_ALIASES)


def read_ledger_movements(df: DataFrame, cfop: DataFrame | None = None) -> DataFrame:
    """Purchases per unit: incoming ledger items."""
    value = first_present(df, "vl_item", "valor_item")
    rows = only_cfop(df.where(F.col("ind_oper").cast("string") == "0"), cfop)
    rows = rows.withColumn("compras", measure(F.col(value)) if value else no_amount()).withColumn(
        "vendas", no_amount()
    )
    return conform(rows, MOVEMENT, {**_LEDGER_ALIASES, "unid": ("unid",)})


def read_inventory_movements(df: DataFrame) -> DataFrame:
    rows = df.drop("descr_compl").withColumn("compras", no_amount()).withColumn("vendas", no_amount())
    return conform(rows, MOVEMENT, _INVENTORY_ALIASES)


def read_manual_factors(df: DataFrame) -> DataFrame | None:
    """Factors edited by hand; an incomplete table is ignored, incomplete rows dropped."""
    required = ("codigo_produto_ajustado", "unid", "fator")
    if any(name not in df.columns for name in required):
        return None
    schema = dict(MANUAL_FACTOR)
    aliases = {
        "chave_produto": ("codigo_produto_ajustado",),
        "unidade": ("unid",),
        "fator_conversao_manual": ("fator",),
    }
    if "cnpj" not in df.columns:
        schema.pop("cnpj")
    return conform(df, schema, aliases).dropna(subset=["chave_produto", "unidade", "fator_conversao_manual"])


def import_factors(df: DataFrame) -> DataFrame:
    """Edited factor table that replaces the computed one."""
    mapping = {
        "ano": "ano",
        "codigo_produto_ajustado": "chave_produto",
        "unid": "unidade",
        "fator": "fator_de_conversao",
    }
    missing = [name for name in mapping if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    lead = ["cnpj"] if "cnpj" in df.columns else []
    columns = [
        F.col(old).cast("double").alias(new) if new == "fator_de_conversao" else F.col(old).alias(new)
        for old, new in mapping.items()
    ]
    return df.select(*lead, *columns)
