"""Row keys, set keys and taxpayer-id checks."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscoframe.functions.text import strip
from fiscoframe.schemas import ITEM_KEY_FIELDS

# Mod-11 weights of the two check digits.
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def digits_only(column: Column) -> Column:
    return F.regexp_replace(column, "[^0-9]", "")


def sanitize_cnpj(column: Column) -> Column:
    """The 14 digits of a taxpayer id, or null when it has another length."""
    digits = digits_only(column)
    return F.when(F.length(digits) == 14, digits)


def is_valid_cnpj(column: Column) -> Column:
    """True for 14 digits, not all alike, with both check digits right."""
    digits = digits_only(F.coalesce(column, F.lit("")))

    def digit(position: int) -> Column:
        return F.substring(digits, position, 1).try_cast("int")

    def check(weights: tuple[int, ...]) -> Column:
        total = reduce(add, [digit(i + 1) * w for i, w in enumerate(weights)])
        rest = total % 11
        return F.when(rest < 2, 0).otherwise(11 - rest)

    well_formed = (F.length(digits) == 14) & ~digits.rlike("^(.)\\1{13}$")
    checked = (digit(13) == check(FIRST_WEIGHTS)) & (digit(14) == check(SECOND_WEIGHTS))
    return well_formed & F.coalesce(checked, F.lit(False))


def item_key_text(fields: tuple[str, ...] = ITEM_KEY_FIELDS) -> Column:
    """The key fields, each stripped and upper-cased, null as empty, in one text."""
    parts = [F.coalesce(F.upper(strip(F.col(name).cast("string"))), F.lit("")) for name in fields]
    return F.concat_ws("|", *parts)


def item_key(fields: tuple[str, ...] = ITEM_KEY_FIELDS) -> Column:
    """MD5 of the key fields, each stripped and upper-cased, null as empty."""
    return F.md5(item_key_text(fields))


def set_key(column: Column) -> Column:
    """MD5 of the sorted elements joined without separator; empty gives ``''``."""
    values = F.coalesce(column, F.array().cast("array<string>"))
    return F.when(F.size(values) == 0, F.lit("")).otherwise(F.md5(F.array_join(F.sort_array(values), "")))


#: In front of a key that is no hash, which makes it longer than any hash.
_TEXT_KEY = bytes(17)


def packed_key(column: Column) -> Column:
    """A key as it travels: the 16 bytes of a hash, other keys marked; :func:`unpacked_key` gives the text back."""
    return F.when(column.rlike("^[0-9a-f]{32}$"), F.unhex(column)).otherwise(F.concat(F.lit(_TEXT_KEY), F.encode(column, "UTF-8")))


def unpacked_key(column: Column) -> Column:
    text = F.decode(F.substring(column, F.lit(len(_TEXT_KEY) + 1), F.octet_length(column)), "UTF-8")
    return F.when(F.octet_length(column) == 16, F.lower(F.hex(column))).otherwise(text)
