"""Listings: pages by position and after a key, and which files they read."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators.listing import Listing


@pytest.fixture(scope="module")
def listed(spark, tmp_path_factory):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "b", "c"]), i, f"text {i}", rnd.random() < 0.02) for i in range(5000)]
    df = spark.createDataFrame(rows, "label string, id long, text string, open boolean").repartition(7)
    listing = Listing.write(df, str(tmp_path_factory.mktemp("listing") / "l"), ["label", "id"], parts=40)
    return listing, sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))


def test_pages_are_those_of_a_sorted_table(listed):
    listing, rows = listed
    assert listing.rows == 5000
    for number, size in ((1, 10), (7, 33), (250, 20), (100, 50), (101, 50), (0, 3), (900, 10)):
        got = listing.page(number, size).collect()
        first = (max(number, 1) - 1) * size
        assert [tuple(r)[:4] for r in got] == rows[first : first + size]
        assert [r.pos for r in got] == [*range(first, first + len(got))]
    assert [r.pos for r in listing.between(1200, 1700).collect()] == [*range(1200, 1700)]


def test_a_late_page_reads_its_own_files_only(listed):
    listing, _ = listed
    page = listing.page(490, 10)
    files = {f.rsplit("/", 2)[1] for f in page.inputFiles()}
    all_files = {f.rsplit("/", 2)[1] for f in listing.spark.read.parquet(f"{listing.path}/rows").inputFiles()}
    assert len(all_files) > 20
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    scanned = page._jdf.queryExecution().executedPlan()
    page.collect()
    assert files <= all_files and _files_read(scanned) <= 2 * len(listing.page(1)._jdf.inputFiles()) and _files_read(scanned) <= 4


def _files_read(plan) -> int:
    """``numFiles`` of the scan below a plan that has run."""
    stack, found = [plan], 0
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numFiles").value()
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return found


def test_keyset_paging_walks_through_everything_once(listed):
    listing, rows = listed
    key, seen = None, []
    for _ in range(12):
        page = [tuple(r) for r in listing.after(key, 450).collect()]
        if not page:
            break
        seen += page
        key = page[-1][:2]
    assert seen == rows


def test_keyset_paging_with_a_filter(listed):
    listing, rows = listed
    wanted = [r for r in rows if r[3]]
    first = [tuple(r) for r in listing.after(None, 30, F.col("open")).collect()]
    assert first == wanted[:30]
    rest = [tuple(r) for r in listing.after(first[-1][:2], 10_000, F.col("open")).collect()]
    assert rest == wanted[30:]
    assert listing.after(("c", 10**9), 5).count() == 0
    assert [tuple(r) for r in listing.after((None, 4999), 1).collect()] == [next(r for r in rows if r[0] is not None)] or rows[-1][0] is None


def test_a_listing_is_opened_again(listed):
    listing, rows = listed
    again = Listing(listing.spark, listing.path, listing.order_by)
    assert [tuple(r)[:4] for r in again.page(3, 25).collect()] == rows[50:75]


def test_an_empty_listing(spark, tmp_path):
    listing = Listing.write(spark.createDataFrame([], "id long, text string"), str(tmp_path / "l"), ["id"])
    assert listing.rows == 0 and listing.page(1).count() == 0 and listing.after(None).count() == 0
