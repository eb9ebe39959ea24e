"""Merkle manifest of a dataset with a witness for every row: aligned append with incremental witnesses.

Leaves of a group (a language) stand in a fixed order.  While a group has several nodes, every two consecutive
ones become their parent; a last node without a partner becomes a parent of its own.  What remains is the
subroot of the group; subroots, by group, become the root in the same way.  A parent is the sha256 of its
children's hex digests, one after the other.

A task receives a block of consecutive leaves whose number is a multiple of the block size (an aligned block; the last
one of a group may be shorter) and appends them one by one.  It keeps the open subtrees, the largest first, each
with the witnesses of its leaves so far; an append that completes a pair closes both subtrees into one,
and every witness of either side is extended by the root of the other.  At the end the rest of a
short block is closed.  The roots of the blocks are then appended in the same way as leaves of the next
round, whose witnesses extend those of all leaves below, until every group has one node; then
subroots are appended.  Blocks bound what a task holds, whatever the size of a group, and a rerun
gives the same result.

A witness is an array of steps (before, after): the siblings to the left and to the right on each level, null where
there is none.  Leaves that are equal in everything are leaves each.  Null groups and null ids come first; leaves of one id
are ordered by digest.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .common import in_batches, ship

ship(__name__)

#: Levels of a block: 2 ** LEVELS nodes meet in one task.
LEVELS = 12
#: Fields of a row that make its leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def field_text(value: Column) -> Column:
    """``-`` for a null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """The leaf of a row of documents; ``changed`` replaces fields."""
    return F.sha2(F.concat(*[field_text(changed.get(f, F.col(f))) for f in FIELDS]), 256)


class Frontier:
    """Open subtrees of one block, the largest first: level, root, and its leaves with their witnesses."""

    def __init__(self):
        self.open: list[tuple[int, str, list[list]]] = []

    def append(self, leaf: str) -> list:
        """Append a leaf; return its witness, which later appends extend."""
        witness: list = []
        level, root, members = 0, leaf, [witness]
        while self.open and self.open[-1][0] == level:
            _, left, earlier = self.open.pop()
            for w in earlier:
                w.append((None, root))
            for w in members:
                w.append((left, None))
            level, root, members = level + 1, digest(left, root), earlier + members
        self.open.append((level, root, members))
        return witness

    def raise_last(self, height: int) -> None:
        """Lift the smallest subtree, which has no partner, to ``height``."""
        level, root, members = self.open.pop()
        while level < height:
            for w in members:
                w.append((None, None))
            level, root = level + 1, digest(root)
        self.open.append((level, root, members))

    def close(self, height: int | None) -> str:
        """The block's root: joined with larger subtrees as far as there are any, then lifted to ``height``, if given."""
        while len(self.open) > 1:
            self.raise_last(self.open[-2][0])
            level, right, members = self.open.pop()
            _, left, earlier = self.open.pop()
            for w in earlier:
                w.append((None, right))
            for w in members:
                w.append((left, None))
            self.open.append((level + 1, digest(left, right), earlier + members))
        if height is not None:
            self.raise_last(height)
        return self.open[0][1]


def append_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, levels: int) -> Iterator[pa.RecordBatch]:
    """Nodes sorted by (group, place) with their witnesses inside the block and the root of the block."""
    current, frontier, rows, witnesses = None, Frontier(), [], []

    def flush():
        nonlocal frontier, rows, witnesses
        # only the first block of a group can be short without others beside it; then its top is the group's root
        root = frontier.close(None if current[1] == 0 else levels)
        columns = [pa.concat_arrays([r.column(i) for r in rows]) for i in range(rows[0].num_columns)]
        ends = [0]
        for w in witnesses:
            ends.append(ends[-1] + len(w))
        steps = [s for w in witnesses for s in w]
        sides = pa.StructArray.from_arrays([pa.array([s[i] for s in steps], pa.string()) for i in (0, 1)], names=["before", "after"])
        arrays = [*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), sides), pa.array([root] * len(witnesses), pa.string())]
        frontier, rows, witnesses = Frontier(), [], []
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    for batch in batches:
        groups, places, nodes = (batch.column(c).to_pylist() for c in ("group", "place", "node"))
        begin = 0
        for i, (group, place, node) in enumerate(zip(groups, places, nodes, strict=True)):
            if (group, place >> levels) != current:
                if current is not None:
                    if begin < i:
                        rows.append(batch.slice(begin, i - begin))
                    yield flush()
                current, begin = (group, place >> levels), i
            witnesses.append(frontier.append(node))
        if begin < batch.num_rows:
            rows.append(batch.slice(begin))
    if current is not None:
        yield flush()


def append_round(nodes: DataFrame, levels: int) -> DataFrame:
    """Stored nodes (group, place, node and any others) with ``steps`` inside their block and the ``top`` of the block."""
    blocks = nodes.withColumn("block", F.shiftright("place", levels))
    placed = blocks.repartition("group", "block").sortWithinPartitions("group", "place").drop("block")
    schema = T.StructType([*placed.schema.fields, T.StructField("steps", STEPS), T.StructField("top", T.StringType())])
    arrow = placed.sparkSession.createDataFrame([], schema).toArrow().schema
    return stage(in_batches(placed, partial(append_blocks, schema=arrow, levels=levels), schema))


def above(blocks: DataFrame, levels: int) -> DataFrame:
    """group, place, steps from a block's root up to the group's subroot, and the subroot, for every block (few rows)."""
    several = blocks.filter(F.col("place") > 0).limit(1).count() > 0
    if not several:
        return blocks.select("group", "place", F.array().cast(STEPS).alias("steps"), F.col("node").alias("subroot"))
    done = append_round(blocks, levels)
    higher = above(tops(done, levels), levels).select("group", F.col("place").alias("up"), F.col("steps").alias("further"), "subroot")
    return extended(done, higher, levels).select("group", "place", F.concat("steps", "further").alias("steps"), "subroot")


def tops(done: DataFrame, levels: int) -> DataFrame:
    """The roots of the blocks as nodes of the next round."""
    first = F.col("place") % (1 << levels) == 0
    return done.filter(first).select("group", F.shiftright("place", levels).alias("place"), F.col("top").alias("node"))


def extended(done: DataFrame, higher: DataFrame, levels: int) -> DataFrame:
    """Nodes with the row of ``higher`` of their block."""
    higher = higher.withColumnRenamed("group", "of")
    return done.join(higher, F.col("group").eqNullSafe(F.col("of")) & (F.shiftright("place", levels) == F.col("up"))).drop("of", "up")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their place in their group, from 0 in the given order, nulls first.

    Rows are stored in ranges of (group, order) with the number of the range, so that the sizes of ranges hold also after a
    task is rerun; a range adds the rows that its group has in earlier ranges.
    """
    ranged = stage(rows.repartitionByRange(F.asc_nulls_first("group"), *[F.asc_nulls_first(c) for c in order]).withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("group", "range").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # a group enters a range only if the range before ended inside it: fewer rows than ranges
    before = sizes.select(F.col("group").alias("of"), F.col("range").alias("at"), F.sum("rows").over(earlier).alias("before")).filter("before > 0")
    inside = Window.partitionBy("group", "range").orderBy(*[F.asc_nulls_first(c) for c in order])
    own = ranged.withColumn("place", F.row_number().over(inside) - F.lit(1).cast("long"))
    joined = own.join(F.broadcast(before), F.col("group").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")), "left")
    return joined.withColumn("place", F.col("place") + F.coalesce("before", F.lit(0))).drop("range", "of", "at", "before")


def witnessed(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Rows (group, doc_id, node and any others) with ``steps`` from the leaf to the root, ``subroot`` and ``root``."""
    done = append_round(numbered(stage(leaves), ["doc_id", "node"]), levels)
    blocks = stage(above(tops(done, levels), levels))
    # the subroots are one group of their own
    subroots = blocks.filter(F.col("place") == 0).select(F.lit(None).cast("string").alias("group"), F.col("group").alias("member"), F.col("subroot").alias("node"))
    summit = append_round(numbered(subroots, ["member"]), levels)
    over = above(tops(summit, levels), levels).select("group", F.col("place").alias("up"), F.col("steps").alias("further"), F.col("subroot").alias("root"))
    whole = F.concat("steps", "further").alias("last_steps")
    over = extended(summit, over, levels).select("member", whole, "root")
    joined = blocks.join(over, F.col("group").eqNullSafe(F.col("member")))
    higher = joined.select("group", F.col("place").alias("up"), F.concat("steps", "last_steps").alias("further"), "subroot", "root")
    result = extended(done, higher, levels)
    return result.withColumn("steps", F.concat("steps", "further")).drop("further", "top", "place")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness give."""
    none = F.lit("")
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(F.coalesce(s["before"], none), node, F.coalesce(s["after"], none)), 256))


def proof(steps: Column) -> Column:
    """All siblings of a witness, one after the other."""
    return F.array_join(F.transform(steps, lambda s: F.concat(F.coalesce(s["before"], F.lit("")), F.coalesce(s["after"], F.lit("")))), "")


def manifest(docs: DataFrame, levels: int = LEVELS, **also: Column) -> DataFrame:
    """doc_id, lang, leaf, steps, subroot, root of every row; ``also`` adds columns computed from the row."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("group"), leaf_digest().alias("node"), *[c.alias(n) for n, c in also.items()])
    return witnessed(known, levels).withColumnsRenamed({"group": "lang", "node": "leaf"})
