"""License scans with ordered signature rules, in DataFrame functions only.

A text whose lower form holds none of a few keywords costs one look for them and a word count.  The others
are turned into words joined by one space; then each rule whose own keyword occurs is tried.  A detection is
dropped if it lies inside one of higher priority, or inside a longer one of the same priority
(of equal ones the first by name stays).

The base phrases are counted exactly, wherever their words stand consecutively.  A null text is an empty
one and has no detections.  Repeated rows are scanned each.  Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts
from .license_rules import rules

# Phrases with their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: One of these stands in every text that a rule can match; each lies inside one word, as words may be apart by any separators.
GATES = ("licen", "copyleft", "domain", "reserved", "spdx", "permission", "redistribut", "warranty", "endorse", "creativecommons", "proprietary", "opensource", "commons", "cc0", "wtfpl", "gnu", "apache", "mozilla", "boost", "attribution")
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Values of a running array that are gathered together.
BLOCK = 64
#: Confidence of one surviving detection, by priority from 1.
CONFIDENCE = (0.4, 0.6, 0.8, 0.9, 0.97)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "array<struct<name:string,label:string,priority:int,keyword:string,pattern:string>>"
SPAN = "struct<begin:int,end:int>"
DETECTION = "array<struct<begin:int,end:int,priority:int,name:string,label:string>>"


def spaced(text: Column, separators: str) -> Column:
    """Words joined by one space, with a space at either end; one space if there are none."""
    return F.concat(F.lit(" "), F.ltrim(F.concat(F.rtrim(F.regexp_replace(text, separators, " ")), F.lit(" "))))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def rule_table() -> Column:
    listed = [{"name": r.name, "label": r.label, "priority": r.priority, "keyword": r.keyword, "pattern": f" {r.pattern}(?= )"} for r in rules()]
    return F.from_json(F.lit(json.dumps(listed)), RULE)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def in_blocks(items: Column, size: int) -> Column:
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.slice(items, at, F.lit(size)))


def running(items: Column, start: Column, step: Callable, kind: str) -> Column:
    """``step(state, item) -> (state, value)`` along an array; the values as an array of ``kind``.

    ``items`` must be a column or bound.  Array functions copy their array, so items are cut into blocks in two steps and
    values are gathered block by block: n items cost far less than n * n copies.
    """
    none, blocks = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def inner(state, item):
        after, value = step(state["state"], item)
        return F.struct(after.alias("state"), F.array_append(state["out"], value).alias("out"), state["done"].alias("done"))

    def outer(state, block):
        fresh = F.struct(state["state"].alias("state"), none.alias("out"), F.array_append(state["done"], state["out"]).alias("done"))
        return F.aggregate(block, fresh, inner)

    cut = F.flatten(F.transform(in_blocks(items, BLOCK * BLOCK), lambda b: in_blocks(b, BLOCK)))
    begin = F.struct(start.alias("state"), none.alias("out"), blocks.alias("done"))
    return F.aggregate(cut, begin, outer, lambda s: F.flatten(F.array_append(s["done"], s["out"])))


def matches(words: Column, rule: Column) -> Column:
    """Where a rule's expression matches: character positions of begin and end."""
    gaps = F.split(words, rule["pattern"], -1)
    hits = F.regexp_extract_all(words, rule["pattern"], F.lit(0))
    sizes = F.arrays_zip(F.transform(gaps, F.length).alias("gap"), F.transform(hits, F.length).alias("hit"))

    def step(at, size):
        begin = at + size["gap"]
        end = begin + F.coalesce(size["hit"], F.lit(0))
        return end, F.struct(begin.alias("begin"), end.alias("end"))

    # the text behind the last match has no hit
    found = bound(sizes, lambda s: F.slice(running(s, F.lit(0), step, SPAN), 1, F.size(s) - 1))
    return F.when(F.regexp_like(words, rule["pattern"]), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def detections(words: Column) -> Column:
    """All matches of the rules whose keyword occurs."""
    tried = F.filter(rule_table(), lambda r: F.contains(words, r["keyword"]))
    found = F.transform(
        tried,
        lambda r: F.transform(matches(words, r), lambda m: F.struct(m["begin"].alias("begin"), m["end"].alias("end"), r["priority"].alias("priority"), r["name"].alias("name"), r["label"].alias("label"))),
    )
    return F.flatten(found).cast(DETECTION)


def surviving(found: Column) -> Column:
    """Detections that none contains which has a higher priority, or the same and is longer or, if equal, earlier by name.

    In the order of begin, falling end, falling priority and name, all that may contain a detection stand before it; so
    it stays if none of its priority or a higher one before it has reached its end.
    """
    ordered = F.array_sort(F.transform(found, lambda d: F.struct(d["begin"].alias("begin"), (-d["end"]).alias("back"), (-d["priority"]).alias("rank"), d["name"].alias("name"), d["label"].alias("label"))))
    levels = range(1, len(CONFIDENCE) + 1)

    def step(reached, d):
        end, priority = -d["back"], -d["rank"]
        over = F.greatest(F.lit(-1), *[F.when(priority <= p, reached[f"p{p}"]) for p in levels])
        after = F.struct(*[F.when(priority == p, F.greatest(reached[f"p{p}"], end)).otherwise(reached[f"p{p}"]).alias(f"p{p}") for p in levels])
        kept = F.struct(d["begin"].alias("begin"), end.alias("end"), priority.alias("priority"), d["name"].alias("name"), d["label"].alias("label"))
        return after, F.when(over < end, kept)

    none = F.struct(*[F.lit(-1).alias(f"p{p}") for p in levels])
    return F.array_compact(bound(ordered, lambda o: running(o, none, step, DETECTION[6:-1]))).cast(DETECTION)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base counts and positions, and the surviving detections of every whole text."""
    rows = texts(docs)
    lowered = F.lower("text")
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(lowered, F.lit(word))
    rows = rows.withColumn("gated", gate)
    # words do not depend on case, so that most texts are never lower-cased letter by letter
    either = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    rows = rows.select("doc_id", "gated", spaced(F.col("text"), either).alias("words"))
    rows = rows.select("doc_id", (spaces(F.col("words")) - 1).cast("long").alias("n_words"), F.when(F.col("gated"), F.translate("words", UPPER, LOWER)).alias("words"))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        gaps = F.when(F.contains("words", F.lit(f" {phrase} ")), F.split("words", f" {phrase}(?= )", -1))
        n = F.coalesce(F.size(gaps) - 1, F.lit(0))
        length = phrase.count(" ") + 1
        counts.append(F.when(gaps.isNull(), 0).otherwise(n))
        firsts.append(F.when(gaps.isNotNull(), spaces(F.get(gaps, F.lit(0)))))
        lasts.append(F.when(gaps.isNotNull(), F.col("n_words") + 1 - spaces(F.element_at(gaps, -1)) - length))
        labels.append(F.when(gaps.isNotNull(), F.lit(label)))
    found = F.when(F.col("words").isNotNull(), detections(F.col("words")))
    rows = rows.select(
        "doc_id",
        "n_words",
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base"),
        found.alias("found"),
    )
    return rows.withColumn("found", F.coalesce(surviving(F.col("found")), F.array().cast(DETECTION)))


def license_scan(docs: DataFrame) -> DataFrame:
    """The columns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections."""
    rows = scan(docs)
    own = F.transform("found", lambda d: d["label"])
    doubt = F.aggregate("found", F.lit(1.0), lambda s, d: s * (1 - F.get(F.array(*[F.lit(c) for c in CONFIDENCE]), d["priority"] - 1)))
    base = F.when(F.size("base") > 0, F.lit(1 - CONFIDENCE[1])).otherwise(F.lit(1.0))
    return rows.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", own))), ",").alias("labels"),
        (1 - F.least(doubt, base)).alias("score"),
        F.size("found").alias("n_detections"),
    )
