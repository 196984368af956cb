"""Every registered query beside its SQL check, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"
# Each of these trains at least one model; one stays in the default run.
SLOW = {
    "classifier_explanations", "classifier_predictions", "curation_run", "learning_cycle", "reviewed_training",
    "strategy_comparison",
}
NAMES = [pytest.param(name, marks=pytest.mark.slow) if name in SLOW else name for name in sorted(entry.queries())]


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_checks_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem = oracle.compare(spark, con, name, SF_DIR)
    assert problem in ("", "both empty") or (name not in entry.oracle_sql() and problem == "no rows"), problem


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and [row.rows for row in rows] == sorted((row.rows for row in rows), reverse=True)
