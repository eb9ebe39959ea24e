"""Unions and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.operators.versioning import latest
from fiscoframe.schemas import conform


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Align by name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_conformed(frames: Iterable[DataFrame], schema: Mapping[str, str]) -> DataFrame:
    """Bring every frame to one schema first, so that types never clash."""
    return reduce(DataFrame.unionByName, [conform(df, schema) for df in frames])


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def wider_type(a: str, b: str) -> str:
    """Common type of two columns: numbers stay numbers, moments stay moments, anything else is text."""
    if a == b:
        return a
    numbers = (*_WHOLE, "float", "double")
    if {a, b} <= set(_WHOLE):
        return "bigint"
    if {a, b} == {"date", "timestamp"}:
        return "timestamp"
    if not all(t in numbers or t.startswith("decimal") for t in (a, b)):
        return "string"
    if not {a, b}.isdisjoint({"float", "double"}):
        return "double"
    # whole numbers have up to 19 digits before the point
    sizes = [tuple(map(int, t[8:-1].split(","))) if t.startswith("decimal") else (19, 0) for t in (a, b)]
    scale = max(s for _, s in sizes)
    return f"decimal({min(38, max(p - s for p, s in sizes) + scale)},{scale})"


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """Align by name and widen differing types."""
    types: dict[str, str] = {}
    for df in frames:
        for name, data_type in df.dtypes:
            types[name] = wider_type(types.get(name, data_type), data_type)
    return union_conformed(frames, types)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given total order."""
    return latest(df, keys, order)


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def without(df: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose composite text key (null as empty) is not among the removed ones."""
    marks = removed.select(
        *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"__r_{k}") for k in keys]
    ).distinct()
    same = reduce(
        lambda a, b: a & b,
        [F.coalesce(df[k].cast("string"), F.lit("")) == marks[f"__r_{k}"] for k in keys],
    )
    return df.join(marks, same, "left_anti")
