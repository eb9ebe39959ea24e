"""Pages through slices: against plain slicing, without jobs before an action, without a global offset."""

from __future__ import annotations

import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from fiscoframe.operators import paging
from fiscoframe.operators.predicates import Condition
from fiscoframe.operators.ranking import nulls_last, number_rows, with_slice


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return sorted(((rng.choice([None, "a", "b", "hot", "hot", "hot"]), i) for i in range(5000)), key=lambda r: (r[0] is not None, r[0] or "", r[1]))


@pytest.fixture(scope="module")
def df(spark, rows):
    shuffled = list(rows)
    random.Random(3).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "k string, i int").repartition(5)


def jobs_started(spark, build):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        built = build()
        return built, len(tracker.getJobIdsForGroup("planning"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("page", [1, 7, 60, 99, 100, 101, 5000])
@pytest.mark.parametrize("clamp", [False, True])
def test_pages_equal_plain_slices(df, rows, monkeypatch, page, clamp):
    monkeypatch.setattr(paging, "FRONT", 100)
    got = paging.page_rows(df, ["k", "i"], page, 50, clamp=clamp, rows_per_slice=300).collect()
    last = min(page, 100) if clamp else page
    assert [tuple(r) for r in got] == rows[(last - 1) * 50 : last * 50]


def test_page_50_000_has_no_global_offset(spark):
    df = spark.range(20_000_000).select(F.col("id").alias("i"))
    page, jobs = jobs_started(spark, lambda: paging.get_page(df, [Condition("i", ">=", "0")], ["i"], 50_000))
    plan = plan_of(page.rows)
    assert jobs == 0 and "Offset" not in plan and "offset" not in plan
    assert [r["i"] for r in page.rows.collect()] == list(range(49_999 * 200, 50_000 * 200))


def test_get_page_counts_only_when_asked(spark, df):
    page, jobs = jobs_started(spark, lambda: paging.get_page(df, [], ["k", "i"], 10**6, 200, clamp=True))
    assert jobs == 0 and (page.total_rows, page.page, page.rows.count()) == (5000, 25, 200)
    nothing = paging.get_page(df, [Condition("i", ">", "99999")], ["i"], 3, clamp=True)
    assert (nothing.total_rows, nothing.page, nothing.rows.collect()) == (0, 1, [])


def test_next_page_continues(df, rows):
    seen, after = [], None
    page = paging.page_rows(df, ["k", "i"], 1, 700).collect()
    while page:
        seen += [tuple(r) for r in page]
        after = tuple(page[-1])
        page = paging.next_page(df, ["k", "i"], after, 700).collect()
    assert seen == rows and "TakeOrderedAndProject" in plan_of(paging.next_page(df, ["k", "i"], after))


@pytest.mark.parametrize("page", [1, 33, 72, 500])
def test_stored_pages_read_few_folders(spark, df, rows, tmp_path, page):
    path = paging.store_slices(df, ["k", "i"], str(tmp_path / "t"), rows_per_slice=250)
    folders = len(list((tmp_path / "t" / "rows").glob("__slice=*")))
    got = paging.stored_page(spark, path, page, 70)
    assert [tuple(r) for r in got.collect()] == rows[(page - 1) * 70 : page * 70]
    assert folders >= 15 and len(got.inputFiles()) <= 2 * folders
    last = paging.stored_page(spark, path, 10**6, 70, clamp=True)
    assert [tuple(r) for r in last.collect()] == rows[71 * 70 :]
    assert page == 500 or re.search(r"PartitionFilters: \[[^]]*__slice", plan_of(got))


def test_numbering_runs_nothing_and_shuffles_rows_once(spark, df):
    numbered, jobs = jobs_started(spark, lambda: number_rows(df, ["k"], [F.col("i")]))
    main = plan_of(numbered).split("BroadcastExchange")[0]
    assert jobs == 0 and main.count("hashpartitioning") == 1


def test_slices_follow_the_number_of_rows(spark):
    for n, least, most in ((1000, 1, 1), (40_000, 35, 45)):
        df = spark.range(n).select(F.lit("hot").alias("g"), F.col("id").alias("v"))
        sizes = [r["count"] for r in with_slice(df, ["g"], [F.col("v")], 1000).groupBy("__slice").count().collect()]
        assert least <= len(sizes) <= most and max(sizes) < max(1001, 1500)


def test_numbering_is_the_same_for_any_partitioning(df, rows):
    order = [*nulls_last(F.col("k")), F.col("i")]
    expected = {r: n for n, r in enumerate(sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1])), 1)}
    for parts in (1, 3, 17):
        got = number_rows(df.repartition(parts, "i"), [], order, rows_per_slice=97).collect()
        assert {(r["k"], r["i"]): r["seq"] for r in got} == expected
