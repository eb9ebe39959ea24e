"""Reference dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscoframe.operators.lookup import ClassificationTables

MERCANTILE = "operacao_mercantil"
STOCK_AUDIT = "sisaudit_estoque"


def marked_cfop(dimension: DataFrame, flag: str = MERCANTILE) -> DataFrame:
    """Operation codes marked with ``X`` in the given flag column."""
    return (
        dimension.where(F.col(flag) == "X").select(F.col("co_cfop").cast("string").alias("co_cfop")).distinct()
    )


def classification_tables(tables: Mapping[str, DataFrame]) -> ClassificationTables:
    """The classification references by their table names."""
    return ClassificationTables(
        by_cest_and_ncm=tables["sitafe_cest_ncm"],
        by_cest=tables["sitafe_cest"],
        by_ncm=tables["sitafe_ncm"],
        products=tables["sitafe_produto_sefin"] if "sitafe_produto_sefin" in tables else None,
        attributes=tables["sitafe_produto_sefin_aux"] if "sitafe_produto_sefin_aux" in tables else None,
    )
