"""Ad-hoc filters, search, column choice and quick filters.

All operators are defined on the text form of a column.  Where a comparison of the
column itself with a literal of its type means the same, that is used, because only
such a comparison reaches the scan: equality on text and numbers, and the
numeric comparisons on numbers.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal, InvalidOperation
from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTEXT = Context(prec=400)

# Operator names of the predicate grammar.
CONTAINS = "contém"
EQUALS = "igual"
STARTS = "começa com"
ENDS = "termina com"
IS_NULL = "é nulo"
NOT_NULL = "não é nulo"
COMPARISONS = (">", ">=", "<", "<=")

# Physical columns tried, in order, for each quick filter.
QUICK_FILTER_COLUMNS = {
    "ncm_padrao": ("ncm_padrao", "NCM_padrao", "lista_ncm"),
    "cest_padrao": ("cest_padrao", "CEST_padrao", "lista_cest"),
    "descricao_normalizada": ("descricao_normalizada", "descricao", "descr_norm"),
    "descricao": ("descricao", "lista_descricoes", "descr"),
}


@dataclass(frozen=True)
class Condition:
    column: str
    operator: str
    value: str = ""
    quick: bool = False


def as_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _number(value: str) -> float | None:
    try:
        return float(value.replace(",", "."))
    except ValueError:
        return None


_WHOLE_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def _literal(scaled: int, data_type: str) -> Column | None:
    """``scaled`` units of the last place as a literal of the type, if it fits."""
    if data_type in _WHOLE_BITS:
        fits = -(1 << _WHOLE_BITS[data_type] - 1) <= scaled < 1 << _WHOLE_BITS[data_type] - 1
        return F.lit(scaled).cast(data_type) if fits else None
    precision, scale = map(int, data_type[8:-1].split(","))
    return F.lit(str(Decimal(scaled).scaleb(-scale))).cast(data_type) if abs(scaled) < 10**precision else None


def _typed(column: Column, operator: str, value: str, data_type: str) -> Column | None:
    """The same condition on the column itself, or None where only the text form will do."""
    if data_type == "string":
        return column == value if operator == EQUALS and value else None
    if data_type == "double":
        number = _number(value) if operator in COMPARISONS else None
        return None if number is None else _compared(column, operator, F.lit(number))
    if data_type not in _WHOLE_BITS and not data_type.startswith("decimal"):
        return None
    scale = 0 if data_type in _WHOLE_BITS else int(data_type[8:-1].split(",")[1])
    try:
        exact = Decimal(value.replace(",", ".") if operator in COMPARISONS else value).scaleb(scale, _CONTEXT)
    except InvalidOperation:
        return None
    if not exact.is_finite():
        return None
    if operator == EQUALS:
        plain = exact == int(exact) and format(Decimal(int(exact)).scaleb(-scale), "f") == value
        literal = _literal(int(exact), data_type) if plain else None
        return None if literal is None else column == literal
    if operator not in COMPARISONS:
        return None
    literal = _literal(floor(exact) if operator in (">", "<=") else ceil(exact), data_type)
    return None if literal is None else _compared(column, operator, literal)


def _compared(column: Column, operator: str, limit: Column) -> Column:
    return {">": column > limit, ">=": column >= limit, "<": column < limit, "<=": column <= limit}[operator]


def _scalar(column: Column, operator: str, value: str, data_type: str = "") -> Column:
    typed = _typed(column, operator, value, data_type)
    if typed is not None:
        return typed
    text = as_text(column)
    if operator == CONTAINS:
        return F.lower(text).contains(value.lower())
    if operator == STARTS:
        return F.lower(text).startswith(value.lower())
    if operator == ENDS:
        return F.lower(text).endswith(value.lower())
    if operator == IS_NULL:
        return column.isNull() | (text == "")
    if operator == NOT_NULL:
        return column.isNotNull() & (text != "")
    number = _number(value) if operator in COMPARISONS else None
    if number is None:
        return text == value
    return _compared(column.try_cast("double"), operator, F.lit(number))


def predicate(df: DataFrame, condition: Condition) -> Column:
    """Boolean column of one condition; a list column matches on any element."""
    column = F.col(f"`{condition.column}`")
    data_type = dict(df.dtypes)[condition.column]
    if not data_type.startswith("array"):
        return _scalar(column, condition.operator, condition.value, data_type)
    empty = column.isNull() | (F.size(column) == 0)
    if condition.operator == IS_NULL:
        return empty
    if condition.operator == NOT_NULL:
        return ~empty
    matches = F.exists(column, lambda v: _scalar(v, condition.operator, condition.value))
    return F.coalesce(matches, F.lit(False))


def is_active(condition: Condition) -> bool:
    if not condition.column:
        return False
    return condition.operator in (IS_NULL, NOT_NULL) or condition.value != ""


def apply_filters(df: DataFrame, conditions: Iterable[Condition]) -> DataFrame:
    """All active conditions, combined with AND."""
    for condition in conditions:
        if is_active(condition):
            df = df.where(predicate(df, condition))
    return df


def visible(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """Chosen columns that exist; no choice means all."""
    if not columns:
        return df
    return df.select(*[name for name in columns if name in df.columns])


def search_everywhere(df: DataFrame, term: str) -> DataFrame:
    """Rows in which any column contains the term, ignoring case."""
    term = term.strip().lower()
    if not term:
        return df
    hits = []
    for name, data_type in df.dtypes:
        column = F.col(f"`{name}`")
        if data_type.startswith("array"):
            column = F.array_join(F.transform(column, lambda v: v.cast("string")), ", ")
        hits.append(F.lower(as_text(column)).contains(term))
    return df.where(reduce(or_, hits))


def _fold(name: str) -> str:
    decomposed = unicodedata.normalize("NFKD", name)
    return "".join(c for c in decomposed if not unicodedata.combining(c)).lower()


def resolve_column(df: DataFrame, logical: str) -> str:
    """Physical column of a quick-filter field."""
    for candidate in QUICK_FILTER_COLUMNS.get(logical, ()):
        if candidate in df.columns:
            return candidate
    if logical in df.columns:
        return logical
    return next((name for name in df.columns if _fold(name) == _fold(logical)), logical)


def with_quick_filters(
    df: DataFrame, current: Iterable[Condition], fields: dict[str, str]
) -> list[Condition]:
    """Conditions after replacing earlier quick filters by the given ones."""
    replaced = set(fields) | {resolve_column(df, name) for name in fields}
    kept = [c for c in current if not c.quick and c.column not in replaced]
    added = []
    for logical, value in fields.items():
        physical = resolve_column(df, logical)
        if value.strip() and physical in df.columns:
            added.append(Condition(physical, CONTAINS, value.strip(), quick=True))
    return kept + added


def equals_if_given(column: Column, value: object | None) -> Column:
    """Optional parameter: no value means no restriction."""
    return F.lit(True) if value is None else column == F.lit(value)


def between_dates(column: Column, start=None, end=None, today=None) -> Column:
    """Date range whose ends default to 1900-01-01 and the given current day."""
    lower = F.lit(start or "1900-01-01").cast("date")
    upper = F.lit(end or today)
    return column.between(lower, upper.cast("date"))


def authorised(status: Column) -> Column:
    """Documents authorised for use."""
    return status.cast("string").isin("100", "150")


def consumer_or_invoice_model(access_key: Column) -> Column:
    return F.substring(access_key, 21, 2).isin("55", "65")


def not_blank(column: Column) -> Column:
    return column.isNotNull() & (column != "")
