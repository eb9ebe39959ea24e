"""Item values from the invoice XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags read under any ICMS group of an item.
ICMS_TAGS = ("vBCST", "vICMSST", "vICMSSubstituto", "vICMSSTRet", "vBCFCPST", "pFCPST", "vFCPST")

_ICMS = ",".join(f"{tag}:double" for tag in ICMS_TAGS)
ITEM_SCHEMA = (
    "struct<_nItem:int,prod:struct<cProd:string>,"
    f"imposto:struct<ICMS:map<string,struct<{_ICMS}>>>>"
)
_ITEM = r"(?s)<((?:[\w.-]+:)?)det[\s>].*?</\1det>"
_PREFIX = r"(</?)[\w.-]+:"


def invoice_items(df: DataFrame, xml: str, *keep: str) -> DataFrame:
    """One row per ``det`` element at any depth; missing tags are zero.

    Items are cut out of the document first, so their depth does not matter and
    each is parsed once.  Namespace prefixes of tags do not matter either.
    """
    pieces = df.select(
        *keep, F.explode(F.regexp_extract_all(F.col(xml), F.lit(_ITEM), F.lit(0))).alias("piece")
    )
    pieces = pieces.withColumn("piece", F.regexp_replace("piece", _PREFIX, "$1"))
    parsed = pieces.select(*keep, F.from_xml("piece", ITEM_SCHEMA).alias("item"))
    groups = F.coalesce(F.map_values("item.imposto.ICMS"), F.array())

    def first_value(tag: str):
        present = F.filter(F.transform(groups, lambda g: g[tag]), lambda v: v.isNotNull())
        return F.coalesce(F.try_element_at(present, F.lit(1)), F.lit(0.0)).alias(f"icms_{tag.lower()}")

    return parsed.select(
        *keep,
        F.col("item._nItem").alias("prod_nitem"),
        F.col("item.prod.cProd").alias("prod_cprod"),
        *[first_value(tag) for tag in ICMS_TAGS],
    )
