"""Aggregations that Spark has no single function for.

Modes count (group, value) pairs first, so the final step sees one row per
distinct value.  Several attributes are counted in the same pass by turning each
row into (attribute, value) pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscoframe.functions.text import natural_key, strip
from fiscoframe.schemas import MEASURE

ALPHABETICAL, NATURAL, LONGEST = "alphabetical", "natural", "longest"


def _tie_key(value: Column, tie: str) -> Column:
    if tie == NATURAL:
        return natural_key(value)
    if tie == LONGEST:
        return -F.length(value)
    return F.lit(0)


def values_of(df: DataFrame, column: str) -> Column:
    """A column, scalar or list, as a list of texts; null gives an empty one."""
    values = F.col(column)
    if not dict(df.dtypes)[column].startswith("array"):
        values = F.array(values.cast("string"))
    return F.coalesce(values, F.array().cast("array<string>"))


def attribute_values(df: DataFrame, keys: Sequence[str], attributes: Mapping[str, str]) -> DataFrame:
    """(keys, attribute, value) rows of several columns, scalar or list, in one pass."""

    def pairs(name: str, column: str) -> Column:
        return F.transform(values_of(df, column), lambda v: F.struct(F.lit(name).alias("attribute"), v.alias("value")))

    return df.select(*keys, F.inline(F.concat(*[pairs(n, c) for n, c in attributes.items()])))


def modes(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Mapping[str, str],
    tie: str = ALPHABETICAL,
    distinct: bool = False,
) -> DataFrame:
    """Most frequent non-blank stripped value of each attribute per group.

    ``distinct`` counts each different raw value of the group once, which is what a
    mode over an already de-duplicated list means.
    """
    values = attribute_values(df, keys, attributes)
    if distinct:
        values = values.distinct()
    counted = (
        values.withColumn("value", strip(F.col("value")))
        .where(F.col("value") != "")
        .groupBy(*keys, "attribute", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = F.struct(-F.col("n"), _tie_key(F.col("value"), tie), F.col("value"))
    return counted.groupBy(*keys).agg(
        *[
            F.min_by(
                F.when(F.col("attribute") == name, F.col("value")),
                F.when(F.col("attribute") == name, order),
            ).alias(name)
            for name in attributes
        ]
    )


def _only(column: Column) -> Column:
    """The single element of a short list, stripped; blank gives null."""
    return F.nullif(strip(F.get(column, 0)), F.lit(""))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: inside, it is the variable of a lambda, not a copy of its expression."""
    return F.get(F.transform(F.array(value), body), 0)


def _most_frequent(values: Column, tie: str) -> Column:
    """Most frequent element of a sorted list, by its runs of equal neighbours."""
    starts = F.array_compact(
        F.transform(values, lambda v, i: F.when((i == 0) | (F.get(values, i - 1) != v), i).otherwise(F.lit(None)))
    )

    def runs(at: Column) -> Column:
        return F.transform(
            at,
            lambda start, j: F.struct(
                (start - F.coalesce(F.get(at, j + 1), F.size(values))).alias("n"),
                _tie_key(F.get(values, start), tie).alias("t"),
                F.get(values, start).alias("v"),
            ),
        )

    return _bound(starts, lambda at: F.array_min(runs(at))["v"])


def mode_of_list(column: Column, tie: str = ALPHABETICAL) -> Column:
    """Mode of one list cell (blanks ignored, values stripped).

    Short lists and lists without repeats, the usual case, are answered directly;
    otherwise the values are sorted once and counted as runs of equal neighbours.
    """
    listed = F.coalesce(column, F.array().cast("array<string>"))
    clean = F.array_remove(F.transform(listed, strip), "")

    def chosen(values: Column) -> Column:
        counted = _bound(F.sort_array(values), lambda ascending: _most_frequent(ascending, tie))
        if tie != ALPHABETICAL:
            return counted
        return F.when(F.size(F.array_distinct(values)) == F.size(values), F.array_min(values)).otherwise(counted)

    return F.when(F.size(listed) <= 1, _only(listed)).otherwise(_bound(clean, chosen))


def mode_of_values(column: Column, tie: str = ALPHABETICAL) -> Column:
    """Aggregate: mode of the elements of a group's list cells, as ``modes`` counts them, in the same pass as other aggregates."""
    return mode_of_list(F.array_compact(F.flatten(F.collect_list(column))), tie)


def word_count(column: Column) -> Column:
    text = strip(F.regexp_replace(column, "\\s+", " "))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def most_words_of_list(column: Column) -> Column:
    """Element with most words, then alphabetical."""
    listed = F.coalesce(column, F.array().cast("array<string>"))
    values = F.array_remove(F.transform(listed, strip), "")
    scored = F.transform(values, lambda v: F.struct((-word_count(v)).alias("n"), v.alias("v")))
    return F.when(F.size(listed) <= 1, _only(listed)).otherwise(F.array_min(scored)["v"])


def most_words(description: Column, position: Column) -> Column:
    """Aggregate: description with most words; among equals the first position."""
    return F.min_by(description, F.struct(-word_count(description), position))


def longest(description: Column) -> Column:
    """Aggregate: longest text, ties alphabetical."""
    return F.min_by(description, F.struct(-F.length(description), description))


def largest_unit(unit: Column, volume: Column) -> Column:
    """Aggregate: unit with the largest volume, ties alphabetical."""
    return F.min_by(unit, F.struct(-volume, unit))


def first_non_null(value: Column, order: Column) -> Column:
    """Aggregate: value of the first row in order that has one."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(order, value)))


def filled_lists(*columns: Column) -> Column:
    """How many of the list columns have elements."""
    total = F.lit(0)
    for column in columns:
        total = total + F.when(F.size(F.coalesce(column, F.array().cast("array<string>"))) > 0, 1).otherwise(0)
    return total


def best_description(
    df: DataFrame, keys: Sequence[str], description: str, filled: Column, position: Column, name: str
) -> DataFrame:
    """Mode; then filled code lists of its first row; then longest; then alphabetical."""
    text = strip(F.col(description))
    per_text = (
        df.where(text != "")
        .groupBy(*keys, text.alias("__text"))
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.min_by(filled, F.when(F.col(description) == text, position)).alias("__filled"),
        )
    )
    rank = F.struct(
        -F.col("__n"), -F.coalesce(F.col("__filled"), F.lit(0)), -F.length("__text"), F.col("__text")
    )
    return per_text.groupBy(*keys).agg(F.min_by("__text", rank).alias(name))


def sorted_distinct(column: Column) -> Column:
    """Aggregate: sorted distinct non-null values."""
    return F.sort_array(F.collect_set(column))


def sorted_distinct_flat(column: Column) -> Column:
    """Aggregate: sorted distinct non-null elements of list cells."""
    return F.sort_array(F.array_distinct(F.array_compact(F.flatten(F.collect_set(column)))))


def is_divergent(column: Column) -> Column:
    """Aggregate: more than one distinct non-empty value."""
    return F.coalesce(F.min(F.nullif(column, F.lit(""))) != F.max(F.nullif(column, F.lit(""))), F.lit(False))


def conditional_sum(code: Column, codes: Sequence[str], amount: Column) -> Column:
    """Aggregate: sum over the rows whose code is listed; nulls count as zero."""
    zero = F.lit(0).cast(MEASURE)
    return F.sum(F.when(code.isin(*codes), F.coalesce(amount.cast(MEASURE), zero)).otherwise(zero))


def formatted_totals(df: DataFrame, keys: Sequence[str], unit: str, totals: Mapping[str, str]) -> DataFrame:
    """``[unit; n]`` per unit with a positive total, cut to whole numbers, in unit order.

    ``totals`` maps result names to amount columns; all are built in one pass.
    """
    per_unit = df.groupBy(*keys, unit).agg(*[F.sum(value).alias(name) for name, value in totals.items()])
    some = reduce(or_, [F.col(name) > 0 for name in totals])

    def entries(name: str) -> Column:
        text = F.concat(F.lit("["), F.col(unit), F.lit("; "), F.floor(name).cast("string"), F.lit("]"))
        positive = F.when(F.col(name) > 0, F.struct(F.col(unit).alias("u"), text.alias("t")))
        return F.array_join(F.transform(F.sort_array(F.collect_list(positive)), lambda e: e["t"]), "; ").alias(name)

    return per_unit.where(some).groupBy(*keys).agg(*[entries(name) for name in totals])


def parse_code_entry(entry: Column) -> tuple[Column, Column]:
    """(code, frequency) of ``[code; n]``; any other text counts once."""
    pattern = "^\\[(.*?);\\s*(\\d+)\\]"
    matched = entry.rlike(pattern)
    code = F.when(matched, strip(F.regexp_extract(entry, pattern, 1))).otherwise(entry)
    count = F.when(matched, F.regexp_extract(entry, pattern, 2).try_cast("bigint")).otherwise(F.lit(1))
    return code, F.coalesce(count.cast("bigint"), F.lit(1).cast("bigint"))


def code_frequencies(df: DataFrame, keys: Sequence[str], entries: str, spare: str | None = None) -> DataFrame:
    """Default code per group and its codes re-rendered with their largest count.

    Codes are summed per (group, code) before anything is collected.  Groups without
    any code use the entries of the ``spare`` column.
    """
    tagged = attribute_values(df, keys, {"own": entries, **({"spare": spare} if spare else {})})
    code, count = parse_code_entry(F.col("value"))
    per_code = (
        tagged.where(F.col("value") != "")
        .select(*keys, "attribute", code.alias("__code"), count.alias("__count"))
        .groupBy(*keys, "attribute", "__code")
        .agg(F.sum("__count").alias("__sum"), F.max("__count").alias("__max"))
    )
    natural = natural_key(F.col("__code"))
    rendered = F.concat(F.lit("["), F.col("__code"), F.lit("; "), F.col("__max").cast("string"), F.lit("]"))
    entry = F.struct(natural.alias("k"), F.col("__code").alias("c"), rendered.alias("r"))
    rank = F.struct(-F.col("__sum"), natural, F.col("__code"))

    def chosen(tag: str, value: Column) -> Column:
        return F.when(F.col("attribute") == tag, value)

    grouped = per_code.groupBy(*keys).agg(
        F.min_by(chosen("own", F.col("__code")), chosen("own", rank)).alias("own_default"),
        F.min_by(chosen("spare", F.col("__code")), chosen("spare", rank)).alias("spare_default"),
        F.collect_list(chosen("own", entry)).alias("own_list"),
        F.collect_list(chosen("spare", entry)).alias("spare_list"),
    )
    has_own = F.col("own_default").isNotNull()
    kept = F.sort_array(F.when(has_own, F.col("own_list")).otherwise(F.col("spare_list")))
    return grouped.select(
        *keys,
        F.coalesce("own_default", "spare_default").alias("codigo_padrao"),
        F.transform(kept, lambda e: e["r"]).alias("lista_codigos"),
    )


def code_summary(own: Column, spare: Column) -> tuple[Column, Column]:
    """The result of ``code_frequencies`` as aggregates, in the same pass as others: for groups whose list fits their row.

    ``own`` and ``spare`` are list cells without blanks; equal codes are runs of the sorted entries.
    """
    mine = F.flatten(F.collect_list(own))
    entries = F.when(F.size(mine) > 0, mine).otherwise(F.flatten(F.collect_list(spare)))

    def parsed(entry: Column) -> Column:
        code, count = parse_code_entry(entry)
        return F.struct(code.alias("c"), count.alias("n"))

    def starts(rows: Column) -> Column:
        return F.array_compact(
            F.transform(rows, lambda v, i: F.when((i == 0) | (F.get(rows, i - 1)["c"] != v["c"]), i).otherwise(F.lit(None)))
        )

    def runs(rows: Column, at: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            end = F.coalesce(F.get(at, j + 1), F.size(rows))
            code, most = F.get(rows, start)["c"], F.get(rows, end - 1)["n"]
            total = F.aggregate(F.slice(rows, start + 1, end - start), F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
            rendered = F.concat(F.lit("["), code, F.lit("; "), most.cast("string"), F.lit("]"))
            return F.struct(natural_key(code).alias("k"), code.alias("c"), rendered.alias("r"), total.alias("n"))

        return F.transform(at, run)

    codes = _bound(F.sort_array(F.transform(entries, parsed)), lambda rows: _bound(starts(rows), lambda at: F.sort_array(runs(rows, at))))
    default = F.array_min(F.transform(codes, lambda e: F.struct((-e["n"]).alias("n"), e["k"].alias("k"), e["c"].alias("c"))))["c"]
    return default, F.transform(codes, lambda e: e["r"])


def with_distinct_count(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values per group on every row; a null counts as a value.

    Aggregate and join instead of a window: the aggregate combines on the map side
    and a hot group is split by the skew join.
    """
    counts = df.groupBy(*keys).agg(
        (F.count_distinct(value) + F.max(F.col(value).isNull().cast("int"))).alias(name)
    )
    return df.join(counts, list(keys))


def with_group_size(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(sizes, list(keys))


def groups_with_several(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of groups that have more than one row."""
    return with_group_size(df, keys, "__n").where(F.col("__n") > 1).drop("__n")

