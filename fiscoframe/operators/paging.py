"""Pages of an ordered result, found through the sizes of its slices.

An offset would send all rows before a page to one task.  Here the ordered rows fall into slices (see
``operators.ranking``); the sizes of the slices tell which one or two hold a page, and only their rows are
sorted and numbered, each slice in a task of its own.  ``next_page`` goes on from the last row of the page before, and a
table that is stored by slices (``store_slices``) is opened in the folders of a page alone.

An order is a sequence of column names or values, ascending with nulls first; it must be total, since files have no row order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscoframe.operators.predicates import Condition, apply_filters, visible
from fiscoframe.operators.ranking import ROWS_PER_SLICE, SLICE, with_slice

PAGE_SIZE = 200
#: Rows up to the end of a page that every task may keep at most; further pages go through slices.
FRONT = 10_000
_BEFORE, _PLACE = "__before", "__place"


@dataclass(frozen=True)
class Page:
    """One page; the numbers are counted when they are asked for."""

    rows: DataFrame
    total: DataFrame
    asked: int
    page_size: int
    clamp: bool

    @property
    def total_rows(self) -> int:
        return self.total.first()[0]

    @property
    def page(self) -> int:
        return min(self.asked, max(1, (self.total_rows - 1) // self.page_size + 1)) if self.clamp else self.asked


def _values(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def slice_sizes(sliced: DataFrame) -> DataFrame:
    """slice, rows, rows before it, and the total: as many rows as there are slices."""
    sizes = sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("__rows"))
    ascending = Window.orderBy(SLICE)
    return sizes.select(
        SLICE,
        "__rows",
        (F.sum("__rows").over(ascending) - F.col("__rows")).alias(_BEFORE),
        F.sum("__rows").over(ascending.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__total"),
    )


def page_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    page: int = 1,
    page_size: int = PAGE_SIZE,
    columns: Sequence[str] | None = None,
    clamp: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rows of one page in order; ``clamp`` stays on the last page."""
    page, values = max(page, 1), _values(order)
    if page * page_size <= FRONT and not clamp:
        return visible(df.orderBy(*[v.asc_nulls_first() for v in values]).offset((page - 1) * page_size).limit(page_size), columns)
    sliced = with_slice(df, [], values, rows_per_slice)
    number = F.lit(page).cast("bigint")
    if clamp:
        number = F.least(number, F.greatest(F.lit(1), F.floor((F.col("__total") - 1) / page_size) + 1))
    first = (number - 1) * page_size
    held = slice_sizes(sliced).withColumn("__first", first)
    held = held.where((F.col(_BEFORE) < F.col("__first") + page_size) & (F.col(_BEFORE) + F.col("__rows") > F.col("__first")))
    held = F.broadcast(held.select(F.col(SLICE).alias("__of"), _BEFORE, "__first"))
    found = sliced.join(held, F.col(SLICE) == F.col("__of"))
    inside = Window.partitionBy(SLICE).orderBy(*[v.asc_nulls_first() for v in values])
    placed = found.withColumn(_PLACE, F.row_number().over(inside) + F.col(_BEFORE) - F.col("__first"))
    return visible(placed.where(F.col(_PLACE).between(1, page_size)).orderBy(_PLACE).select(*df.columns), columns)


def next_page(df: DataFrame, order: Sequence[str], after: Sequence, page_size: int = PAGE_SIZE, columns: Sequence[str] | None = None) -> DataFrame:
    """The page behind a row, given by its values of the order columns: a filter that reaches the scan, then the first rows."""

    def beyond(column: str, value) -> Column:
        return F.col(column).isNotNull() if value is None else F.col(column) > F.lit(value)

    alternatives = []
    for i, (column, value) in enumerate(zip(order, after, strict=True)):
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(order[:i], after[:i], strict=True)]
        alternatives.append(reduce(lambda a, b: a & b, [*same, beyond(column, value)]))
    rows = df.where(reduce(lambda a, b: a | b, alternatives))
    if after[0] is not None:
        rows = rows.where(F.col(order[0]) >= F.lit(after[0]))
    return visible(rows.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(page_size), columns)


def page_total(df: DataFrame, conditions: Sequence[Condition]) -> DataFrame:
    """One row with the number of rows that match (0 if none does), as a frame."""
    return apply_filters(df, conditions).agg(F.count(F.lit(1)).alias("total"))


def get_page(
    df: DataFrame,
    conditions: Sequence[Condition],
    order: Sequence[Column | str],
    page: int = 1,
    page_size: int = PAGE_SIZE,
    columns: Sequence[str] | None = None,
    clamp: bool = False,
) -> Page:
    """One page of the filtered rows and their count; nothing runs before one of them is used."""
    rows = page_rows(apply_filters(df, conditions), order, page, page_size, columns, clamp)
    return Page(rows, page_total(df, conditions), max(page, 1), page_size, clamp)


def store_slices(df: DataFrame, order: Sequence[str], path: str, rows_per_slice: int = ROWS_PER_SLICE) -> str:
    """Store a table for paging: a folder for each slice of the order, and the sizes of the slices beside them."""
    sliced = with_slice(df, [], _values(order), rows_per_slice)
    placed = sliced.hint("rebalance", SLICE).sortWithinPartitions(SLICE, *order)
    placed.write.mode("overwrite").partitionBy(SLICE).parquet(f"{path}/rows")
    sizes = slice_sizes(df.sparkSession.read.parquet(f"{path}/rows"))
    sizes.withColumn("__order", F.array(*map(F.lit, order))).coalesce(1).write.mode("overwrite").parquet(f"{path}/sizes")
    return path


def stored_page(spark: SparkSession, path: str, page: int = 1, page_size: int = PAGE_SIZE, columns: Sequence[str] | None = None, clamp: bool = False) -> DataFrame:
    """A page of a table stored by slices; only the folders that hold it are listed and read."""
    sizes = spark.read.parquet(f"{path}/sizes").orderBy(SLICE).collect()  # one row for each slice
    page = max(page, 1)
    if clamp and sizes:
        page = min(page, max(1, (sizes[0]["__total"] - 1) // page_size + 1))
    first = (page - 1) * page_size
    held = [r for r in sizes if r[_BEFORE] < first + page_size and r[_BEFORE] + r["__rows"] > first]
    rows = spark.read.parquet(f"{path}/rows").where(F.col(SLICE).isin([r[SLICE] for r in held]))
    if not held:
        return visible(rows.drop(SLICE), columns)
    keys = [F.asc_nulls_first(c) for c in held[0]["__order"]]
    # within the one or two slices; a slice has a bounded number of rows
    numbered = rows.withColumn(_PLACE, F.row_number().over(Window.partitionBy(SLICE).orderBy(*keys)))
    starts = F.create_map(*[x for r in held for x in (F.lit(r[SLICE]), F.lit(r[_BEFORE] - first))])
    placed = numbered.withColumn(_PLACE, F.col(_PLACE) + starts[F.col(SLICE)])
    return visible(placed.where(F.col(_PLACE).between(1, page_size)).orderBy(_PLACE).drop(_PLACE, SLICE), columns)


def last_rows(df: DataFrame, order: Sequence[Column | str], count: int) -> DataFrame:
    return df.orderBy(*order).limit(count)
