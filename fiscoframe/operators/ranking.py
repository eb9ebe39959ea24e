"""Numbering of rows inside groups of any size, by ranks from a quantile sketch.

A window over a taxpayer would put all rows of a large one into a single task.  Here a
sample of the keys (group, order) gives slice bounds: quantiles of the keys, as many as the
number of rows asks for.  Rows are numbered inside their slice and shifted by the number
of rows of the group in earlier slices.  The bounds depend on the rows alone, not on how
they are spread over tasks, so every use of them agrees, also after a task is rerun.

Everything is one plan: the bounds are one row that is sent to all tasks, the sizes of the slices an aggregate
with few rows, and the rows themselves are shuffled once, by (group, slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys that the sketch keeps: those with the smallest hashes, merged task by task.
SKETCH = 8192
#: Rows that a slice should hold, and the most slices (each then has several keys of the sketch).
ROWS_PER_SLICE, MOST_SLICES = 500_000, 2048

SLICE = "__slice"
_BEFORE, _ROWS, _KEY, _BOUNDS = "__before", "__rows", "__key", "__bounds"


def nulls_last(column: Column) -> list[Column]:
    """Order values that put nulls behind all others; a plain column puts them first."""
    return [column.isNull(), column]


def sort_key(group: Sequence[str], order: Sequence[Column]) -> Column:
    return F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)], *[c.alias(f"o{i}") for i, c in enumerate(order)])


def slice_bounds(df: DataFrame, key: Column, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row with the ascending first keys of all slices but the first; none where the rows fit into one slice.

    The sketch keeps the keys with the smallest hashes.  They are a uniform sample of the keys, and the
    largest hash kept tells how many keys there are.
    """
    kept = df.select(key.alias("k"), F.xxhash64(key).alias("h")).orderBy("h").limit(SKETCH)
    sketch = kept.agg(F.sort_array(F.collect_list("k")).alias("keys"), F.max("h").alias("last"), F.count("*").alias("n"))
    share = (F.col("last").cast("double") + 2.0**63) / 2.0**64
    total = F.when(F.col("n") < SKETCH, F.col("n").cast("double")).otherwise(F.col("n") / share)
    slices = F.greatest(F.lit(1), F.least(F.lit(MOST_SLICES), F.ceil(total / rows_per_slice))).cast("int")
    every = F.transform(F.sequence(F.lit(1), F.col("slices")), lambda j: F.get("keys", (j * F.col("n") / F.col("slices")).cast("int")))
    # the last one lies behind all keys
    return sketch.select("keys", "n", slices.alias("slices")).select(F.slice(every, 1, F.col("slices") - 1).alias(_BOUNDS))


def with_slice(df: DataFrame, group: Sequence[str], order: Sequence[Column], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add the number of the slice; slices ascend in (group, order).  Rows of one key share a slice.

    The slice is the number of bounds up to the key: a binary search in the one row of bounds, one projection for
    each of its steps, all in one stage of generated code with the scan.
    """
    key = sort_key(group, order)
    bounds = slice_bounds(df, key, rows_per_slice)
    placed = df.select("*", key.alias(_KEY)).crossJoin(F.broadcast(bounds)).withColumn(SLICE, F.lit(0))
    step = MOST_SLICES // 2
    while step:
        reached = F.get(_BOUNDS, F.col(SLICE) + (step - 1)) <= F.col(_KEY)
        placed = placed.withColumn(SLICE, F.when(reached, F.col(SLICE) + step).otherwise(F.col(SLICE)))
        step //= 2
    return placed.drop(_KEY, _BOUNDS)


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str = "seq",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add a gap-free 1..n number per group in the given total order (values, ascending, nulls first).

    A group continues into a slice only if the previous one ended inside it, so
    at most one (group, slice) pair per slice needs a shift: the shift table has
    fewer rows than there are slices, whatever the data, and can be broadcast.
    """
    ranged = with_slice(df, group, order, rows_per_slice)
    sizes = ranged.groupBy(*group, SLICE).agg(F.count(F.lit(1)).alias(_ROWS))
    earlier = Window.partitionBy(*group).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sizes.withColumn(_BEFORE, F.sum(_ROWS).over(earlier))
        .where(F.col(_BEFORE) > 0)
        .select(*[F.col(c).alias(f"__g_{c}") for c in group], F.col(SLICE).alias("__g_slice"), _BEFORE)
    )
    inside = Window.partitionBy(*group, SLICE).orderBy(*order)
    numbered = ranged.withColumn(_ROWS, F.row_number().over(inside))
    same = F.col(SLICE) == F.col("__g_slice")
    for column in group:
        same = same & F.col(column).eqNullSafe(F.col(f"__g_{column}"))
    return (
        numbered.join(F.broadcast(shifts), same, "left")
        .withColumn(name, F.col(_ROWS) + F.coalesce(F.col(_BEFORE), F.lit(0)))
        .select(*df.columns, name)
    )


def numbered_id(prefix: str, number: str = "seq") -> Column:
    return F.concat(F.lit(prefix), F.col(number).cast("string"))
