"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times that the mix should take it.  Among all rates
between 0 and ``MOST`` whose words meet each source's target, the one closest in
entropy to taking everything once is ``min(MOST, exp(lambda_s * size / mean_s))``; the
multipliers solve a convex dual.  Newton iterations find them: each one is an
aggregate over the stored histogram of (source, size), kept inside a bracket.

Rates become copies without drift: within a source, from large sizes to small ones, each size class gets
the whole number of copies that brings the words taken nearest to the words due; inside a class the
documents with the smallest hashes of their ids are taken once more than the others.  A source's
words differ from its target by about one short document at most.

A null text has size 0; sizes of 0 are never repeated and count for nothing.  Null sources
are one source, the last.  Repeated rows are taken each on their own account.  Only one row for each
source passes through the driver.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import ship

ship(__name__)

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix for every word of the input.
SHARE = 1.5
#: Times that a document is taken at most.
MOST = 2
ROUNDS = 40
#: Rows of one size class that are ranked together.
CHUNK_ROWS = 200_000


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Shares by weight; what exceeds ``most`` times a source's size goes to the others by weight."""
    left, out = share * sum(sizes), [None] * len(sizes)
    while True:
        open_ = [i for i, t in enumerate(out) if t is None]
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            return out
        for i in over:
            out[i] = float(most * sizes[i])
        left = max(0.0, left - sum(out[i] for i in over))


def solve(spark: SparkSession, histogram: DataFrame, sources: list[dict]) -> dict[int, float]:
    """Multiplier of every source: safeguarded Newton steps on the dual, one aggregate an iteration."""
    state = {}
    for s in sources:
        top = math.log(MOST) * s["mean"] / s["least"] if s["size"] else 0.0
        full = s["target"] >= MOST * s["size"]
        state[s["number"]] = {"at": top if full else min(top, math.log(max(s["target"], 1e-9) / s["size"])) if s["size"] else 0.0, "low": None, "high": top, "done": full or not s["size"] or not s["target"]}
        if s["size"] and not s["target"]:
            state[s["number"]]["at"] = -1e6
    by_number = {s["number"]: s for s in sources}
    for _ in range(ROUNDS):
        going = {k: x for k, x in state.items() if not x["done"]}
        if not going:
            break
        points = spark.createDataFrame([(k, x["at"], by_number[k]["mean"]) for k, x in going.items()], "number int, at double, mean double")
        tilt = F.exp(F.least(F.col("at") * F.col("size") / F.col("mean"), F.lit(math.log(MOST))))
        words = F.col("rows") * F.col("size") * tilt
        slope = F.when(tilt < MOST, words * F.col("size") / F.col("mean")).otherwise(0.0)
        # decimals, so that the order of the rows changes nothing
        got = histogram.join(F.broadcast(points), "number").groupBy("number").agg(F.sum(words.cast("decimal(28,6)")).cast("double").alias("words"), F.sum(slope.cast("decimal(28,6)")).cast("double").alias("slope"))
        for r in got.collect():
            x, s = state[r["number"]], by_number[r["number"]]
            gap = r["words"] - s["target"]
            if abs(gap) <= max(0.25, 1e-9 * s["target"]):
                x["done"] = True
                continue
            if gap > 0:
                x["high"] = x["at"]
            else:
                x["low"] = x["at"]
            step = x["at"] - gap / r["slope"] if r["slope"] > 0 else None
            low, high = x["low"], x["high"]
            if step is None or step >= high or low is not None and step <= low:
                step = (low + high) / 2 if low is not None else high - max(1.0, 2 * abs(high))
            if low is not None and high - low < 1e-13 * max(1.0, abs(high)):
                x["done"] = True
            x["at"] = step
    return {k: round(x["at"], 10) for k, x in state.items()}


def whole_numbers(classes: pd.DataFrame) -> pd.DataFrame:
    """Copies of each size class of one source: how many all its rows get, and how many of them one more.

    Largest sizes first, each class gets the number of copies that brings the words taken so far nearest
    to the words due so far, so that small texts even out what large ones leave.  One row for each
    different size, however many documents there are.
    """
    classes = classes.sort_values("size", ascending=False)
    due = taken = 0
    copies = []
    for size, rows, micro in zip(classes["size"].tolist(), classes["rows"].tolist(), classes["micro"].tolist(), strict=True):
        due += size * rows * micro
        k = rows
        if size:
            k = min(MOST * rows, max(0, (due - taken + size * 500_000) // (size * 1_000_000)))
            taken += k * size * 1_000_000
        copies.append(k)
    classes["base"] = [k // n for k, n in zip(copies, classes["rows"], strict=True)]
    classes["more"] = [k % n for k, n in zip(copies, classes["rows"], strict=True)]
    return classes[["number", "size", "rows", "base", "more"]]


def planned(rows: DataFrame, source: str = "source", key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns of ``rows`` with ``__size``, ``__source_size``, ``__target`` and ``__copies``."""
    spark = rows.sparkSession
    sized = rows.withColumn("__size", word_count(F.col(text))).withColumn("__source", F.col(source).cast("string"))
    sized = sized if keep_text else sized.drop(text)
    light = stage(sized.groupBy("__source", "__size").agg(F.count("*").alias("rows")))
    by_source = light.groupBy("__source").agg(F.sum(F.col("rows") * F.col("__size")).alias("size"), F.sum("rows").alias("rows"), F.min(F.when(F.col("__size") > 0, F.col("__size"))).alias("least"))
    # one row for each source, in code point order, null last
    found = sorted((r.asDict() for r in by_source.collect()), key=lambda r: (r["__source"] is None, (r["__source"] or "").encode()))
    if not found:
        return sized.drop("__source").withColumns({"__source_size": F.lit(0).cast("long"), "__target": F.lit(0.0), "__copies": F.lit(0).cast("long")})
    goal = targets([s["size"] for s in found], [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(found))])
    for i, (s, t) in enumerate(zip(found, goal, strict=True)):
        s |= {"number": i, "target": t, "mean": s["size"] / s["rows"] or 1.0}
    names = spark.createDataFrame([(s["number"], s["__source"], s["size"], s["target"], s["mean"]) for s in found], "number int, __name string, __source_size long, __target double, __mean double")
    names = F.broadcast(names)  # one row for each source
    histogram = light.join(names, F.col("__source").eqNullSafe(F.col("__name"))).select("number", F.col("__size").alias("size"), "rows")
    histogram = stage(histogram)
    multipliers = solve(spark, histogram, found)
    at = spark.createDataFrame([(s["number"], multipliers[s["number"]], s["mean"]) for s in found], "number int, at double, mean double")

    # copies by size class: whole part, and how many of the class get one more
    rate = F.exp(F.least(F.col("at") * F.col("size") / F.col("mean"), F.lit(math.log(MOST))))
    micro = F.when(F.col("size") > 0, F.round(rate * 1_000_000).cast("long")).otherwise(F.lit(1_000_000))
    classes = histogram.join(F.broadcast(at), "number").withColumn("micro", micro)
    classes = classes.select("number", "size", "rows", "micro")
    schema = "number int, size long, rows long, base long, more long"
    classes = stage(classes.groupBy("number").applyInPandas(whole_numbers, schema))

    # large classes are ranked in chunks, each with its own part of the class's extra copies
    own = ["__number", "__size", "__chunk"]
    chunks_of = F.ceil(F.col("rows") / CHUNK_ROWS)
    draw = F.xxhash64(F.lit(17), F.col(key))
    plan = classes.select(F.col("number").alias("__number"), F.col("size").alias("__size"), "rows", "base", "more", chunks_of.alias("chunks"))
    plan = plan.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    numbered = sized.join(names, F.col("__source").eqNullSafe(F.col("__name"))).withColumnRenamed("number", "__number")
    most_chunks = light.agg(F.max(F.ceil(F.col("rows") / CHUNK_ROWS))).collect()[0][0] or 1
    if most_chunks > 1:
        wide = classes.filter(F.col("rows") > CHUNK_ROWS).select(F.col("number").alias("__number"), F.col("size").alias("__size"), chunks_of.alias("__chunks"))
        numbered = numbered.join(wide, ["__number", "__size"], "left")
        numbered = numbered.withColumn("__chunk", F.coalesce(F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.col("__chunks")), F.lit(0).cast("long"))).drop("__chunks")
        counts = numbered.groupBy(*own).agg(F.count("*").alias("held"))
        within = Window.partitionBy("__number", "__size").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, 0)
        plan = plan.join(counts, own).withColumn("upto", F.sum("held").over(within))
        plan = plan.withColumn("more", F.floor(F.col("more") * F.col("upto") / F.col("rows")) - F.floor(F.col("more") * (F.col("upto") - F.col("held")) / F.col("rows")))
    else:
        numbered = numbered.withColumn("__chunk", F.lit(0).cast("long"))
    plan = plan.select(*own, F.col("base").alias("__base"), F.col("more").alias("__more"))
    place = F.row_number().over(Window.partitionBy(*own).orderBy(draw, F.col(key)))
    ranked = numbered.withColumn("__place", place).join(plan, own)
    copies = (F.col("__base") + (F.col("__place") <= F.col("__more")).cast("long")).alias("__copies")
    kept = [c for c in sized.columns if c not in ("__source", "__size")]
    return ranked.select(*[F.col(f"`{c}`") for c in kept], "__size", "__source_size", "__target", copies)


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    rows = docs.select("doc_id", "source", "text")
    done = planned(rows, keep_text=False)
    return done.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    done = planned(docs)
    again = done.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])
