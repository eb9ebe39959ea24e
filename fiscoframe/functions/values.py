"""Small value rules used by several readers and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.schemas import first_present, measure

NET_PLUS = ("prod_vprod", "prod_vfrete", "prod_vseg", "prod_voutro")
NET_MINUS = "prod_vdesc"


def net_item_value(df: DataFrame) -> Column:
    """Product + freight + insurance + other - discount; missing parts are zero."""
    total = measure(F.lit(None))
    for name in NET_PLUS:
        if name in df.columns:
            total = total + measure(F.col(name))
    if NET_MINUS in df.columns:
        total = total - measure(F.col(NET_MINUS))
    return total


def preferred_gtin(df: DataFrame) -> Column:
    """Tax GTIN unless null or empty, else commercial GTIN."""
    tax = first_present(df, "prod_ceantrib")
    plain = first_present(df, "prod_cean")
    if tax and plain:
        return F.coalesce(F.nullif(F.col(tax).cast("string"), F.lit("")), F.col(plain).cast("string"))
    if tax or plain:
        return F.col(tax or plain).cast("string")
    return F.lit(None).cast("string")


def ddmmyyyy(column: Column) -> Column:
    """Date from an eight-digit ``DDMMYYYY`` text, else null."""
    return F.when(column.rlike("^[0-9]{8}$"), F.try_to_date(column, "ddMMyyyy"))


def yyyymmdd(column: Column) -> Column:
    return F.when(F.trim(column).rlike("^[0-9]{8}$"), F.try_to_date(F.trim(column), "yyyyMMdd"))


def period(column: Column, style: str = "yyyy/MM") -> Column:
    return F.date_format(column, style)


def months_between_2dp(end: Column, start: Column) -> Column:
    """Months between two dates, cut (not rounded) to two places."""
    months = F.months_between(end, start, False)
    return F.when(months >= 0, F.floor(months * 100)).otherwise(F.ceil(months * 100)).cast("decimal(18,0)") / F.lit(
        100
    ).cast("decimal(5,0)")


def plain_number(column: Column) -> Column:
    """Two-place number as text without trailing zeros."""
    return F.regexp_replace(column.cast("decimal(18,2)").cast("string"), "(\\.00|0)$", "")


def as_list(column: Column, is_array: bool) -> Column:
    """Null -> [], scalar -> [scalar]; null and empty elements dropped."""
    if not is_array:
        column = F.array(F.trim(column.cast("string")))
    else:
        column = F.coalesce(column, F.array().cast("array<string>"))
    return F.filter(column, lambda v: v.isNotNull() & (v != ""))


def display_text(df: DataFrame, separator: str = ", ", drop_empty: bool = False) -> list[Column]:
    """Every column as text: lists joined, booleans lower case, null as empty."""
    out = []
    for name, data_type in df.dtypes:
        value = F.col(f"`{name}`")
        if data_type.startswith("array"):
            elements = F.transform(value, lambda v: v.cast("string"))
            keep = (lambda v: v.isNotNull() & (v != "")) if drop_empty else (lambda v: v.isNotNull())
            value = F.array_join(F.filter(elements, keep), separator)
        out.append(F.coalesce(value.cast("string"), F.lit("")).alias(name))
    return out


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator when the denominator is positive, else 0."""
    return F.when(
        denominator > 0, F.try_divide(numerator.cast("double"), denominator.cast("double"))
    ).otherwise(F.lit(0.0))

