"""Every capability as a query over the test tables, with equivalent plain SQL.

A check runs library code over the whole bound tables and shows the result in
simple types: amounts as doubles, dates and lists as text.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscoframe.bindings import bound_tables, standalone_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_MODULES = ("sources", "predicates", "joins", "aggregates", "windows", "scalars", "jobs", "audits")


def plain(df: DataFrame) -> DataFrame:
    """Show decimals as doubles, dates and timestamps as text, lists as joined text."""
    out = []
    for name, data_type in df.dtypes:
        column = F.col(f"`{name}`")
        if data_type.startswith("decimal"):
            column = column.cast("double")
        elif data_type == "date":
            column = column.cast("string")
        elif data_type.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif data_type.startswith("array"):
            column = F.array_join(F.transform(column, lambda v: v.cast("string")), "; ", "<null>")
        out.append(column.alias(name))
    return df.select(*out)


def check(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with its SQL if it has one."""

    def register(build):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(bound_tables(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"duplicate check {name}")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = standalone_sql(sql)
        return build

    return register


def dbl(*names: str) -> str:
    """SQL select list that shows amounts as doubles."""
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n.split('.')[-1]}" for n in names)


def txt(*names: str) -> str:
    """SQL select list that shows dates as text."""
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n.split('.')[-1]}" for n in names)


def lst(expression: str) -> str:
    """SQL text of a sorted distinct list aggregate."""
    return f"coalesce(array_to_string(list_sort(list_distinct(list({expression}) FILTER (WHERE {expression} IS NOT NULL))), '; '), '')"


def load() -> None:
    for module in _MODULES:
        import_module(f"fiscoframe.checks.{module}")


def loaded(registry):
    if not QUERIES:
        load()
    return dict(registry)
