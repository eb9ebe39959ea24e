"""Tolerant schemas: readers adapt to the columns that exist.

``MEASURE`` is the type in which money and quantities are added up.  A decimal
sum does not depend on the order in which a shuffle delivers its rows, so totals
are reproducible.  One amount has 18 integer digits and ten places, a total
(``TOTAL``) 28 integer digits.  Text that is no number counts as missing; a number
that does not fit raises, everywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURE = "decimal(28,10)"
TOTAL = "decimal(38,10)"

ITEM_KEY_FIELDS = ("codigo", "descricao", "descr_compl", "tipo_item", "ncm", "cest", "gtin")
VALUE_FIELDS = ("valor_entrada", "valor_saida", "quantidade_entrada", "quantidade_saida")

# One row per observed use of an item in a document or inventory.
TRANSACTION = {
    "cnpj": "string",
    **{name: "string" for name in ITEM_KEY_FIELDS},
    "unidade": "string",
    "fonte": "string",
    **{name: MEASURE for name in VALUE_FIELDS},
    "ano": "string",
}

# One row per purchase, sale or inventory line, for the unit table.
MOVEMENT = {
    "cnpj": "string",
    **{name: "string" for name in ITEM_KEY_FIELDS},
    "unid": "string",
    "compras": MEASURE,
    "vendas": MEASURE,
}

MANUAL_FACTOR = {"cnpj": "string", "chave_produto": "string", "unidade": "string", "fator_conversao_manual": "double"}

OPERATION_LOG = (
    "timestamp string, cnpj string, chave_produto string, descricao string, unidade string, "
    "ncm string, tot_v_entradas string, tot_v_saidas string, itens_unificados long"
)

REGISTRY = "cnpj string, added_at timestamp, last_run_at timestamp"


def amount(column: Column, data_type: str = MEASURE) -> Column:
    """Decimal of a number or its text; anything else is null, a number out of range raises."""
    number = column.try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number), column.cast(data_type))


def measure(column: Column) -> Column:
    """Null-safe amount: unparsable or missing becomes zero."""
    return F.coalesce(amount(column), F.lit(0).cast(MEASURE))


def first_present(df: DataFrame, *candidates: str) -> str | None:
    """First of several alternative column names that the frame has."""
    present = set(df.columns)
    return next((name for name in candidates if name in present), None)


def conform(
    df: DataFrame,
    schema: Mapping[str, str],
    aliases: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Project ``df`` onto ``schema``: pick, cast tolerantly, add typed nulls.

    ``aliases`` gives alternative source names per target, in order of preference.
    Casting before a union avoids the ANSI failure of widening text with numbers.
    """
    aliases = aliases or {}
    columns = []
    for name, data_type in schema.items():
        source = first_present(df, *aliases.get(name, ()), name) if name in aliases else first_present(df, name)
        if source is None:
            value = F.lit(None).cast(data_type)
        elif data_type.startswith("decimal"):
            value = amount(F.col(source), data_type)
        else:
            value = F.col(source).try_cast(data_type)
        columns.append(value.alias(name))
    return df.select(*columns)


def lower_names(df: DataFrame | None) -> DataFrame | None:
    """Lower-case every column name; a missing frame passes through."""
    if df is None:
        return None
    return df.toDF(*[name.lower() for name in df.columns])


def all_text(df: DataFrame) -> DataFrame:
    """Degrade a frame of mixed types to text in one projection."""
    return df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])
