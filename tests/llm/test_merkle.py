"""The manifest against a plain tree, with small blocks, and under damage."""

from __future__ import annotations

import collections
import hashlib
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fiscoframe.llm import merkle, queries

FOLDER = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def plain_tree(nodes):
    """The root, and the (before, after) steps of every node."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    steps = []
    for i in range(len(nodes)):
        own = []
        for level in levels[:-1]:
            own.append((level[i - 1], None) if i % 2 else (None, level[i + 1] if i + 1 < len(level) else None))
            i //= 2
        steps.append(own)
    return levels[-1][0], steps


def plain_manifest(rows):
    """(leaf, subroot, root, steps) of every row, sorted."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])]) for g in order}
    root, over = plain_tree([trees[g][0] for g in order])
    return sorted((x[2], trees[g][0], root, str(steps + over[k])) for k, g in enumerate(order) for x, steps in zip(sorted(groups[g]), trees[g][1], strict=True))


def measured(df):
    return sorted((r["leaf"], r["subroot"], r["root"], str([tuple(s) for s in r["steps"]])) for r in df.collect())


ROWS = [(i, f"s{i % 3}", "ab"[i % 2] if i % 5 else None, i if i % 7 else None, "tëxt " * (i % 4)) for i in range(83)]
ROWS += [(None, None, None, None, None), (None, None, None, None, None), (5, "x", "a", 1, "again"), (5, "x", "a", 1, "again"), (200, "x", "", 1, ""), (201, "x", "é", 1, "one alone")]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_any_block_size_gives_the_plain_tree(spark, levels):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ROWS], SCHEMA + ", place int, node int").repartition(3)
    got = merkle.manifest(docs, levels)
    assert measured(got) == plain_manifest(ROWS)
    check = got.select((merkle.folded(F.col("leaf"), F.col("steps")) == F.col("root")).alias("ok"))
    assert all(r["ok"] for r in check.collect())


@pytest.mark.parametrize("n", [1, 3, 8])
def test_few_leaves(spark, n):
    rows = [(i, "s", "a", 1, "t") for i in range(n)]
    assert measured(merkle.manifest(spark.createDataFrame(rows, SCHEMA), 2)) == plain_manifest(rows)


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_frontier_keeps_few_open_subtrees():
    frontier, witnesses = merkle.Frontier(), []
    for i in range(100):
        witnesses.append(frontier.append(h(str(i))))
        assert len(frontier.open) == (i + 1).bit_count()
    root = frontier.close(None)
    assert (root, witnesses) == plain_tree([h(str(i)) for i in range(100)])


def test_op11_finds_the_damage(spark):
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    rows = [(int(r.doc_id), r.source, r.lang, int(r.n_chars), r.text) for r in docs.itertuples()]
    expected = {r[0]: r for r in plain_manifest(rows)}
    got = queries.op11_manifest(spark, FOLDER).collect()
    assert len(got) == len(rows)
    for r in got:
        plain, subroot, root, steps = expected[r["leaf"]]
        siblings = "".join(x for s in eval(steps) for x in s if x)
        assert (r["subroot"], r["root"], r["proof_sha256"]) == (subroot, root, h(siblings))
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) == (r["folded_root"] == root)
