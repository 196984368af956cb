"""Host verdicts: the prior's moments, hosts that stand out, and the query's SQL on hosts of which some are bad."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from textloom.llm import host_rules, queries

SCHEMA = "doc_id long, text string, source string, host string, n long, judged string, rate_base double"


def _documents(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    bad = {
        "base": lambda: prose(3), "symbols": lambda: prose(30) + " ###$$$%%%" * 8, "lines": lambda: "\n".join([prose(4), prose(4)] * 4 + [prose(9)]),
        "words": lambda: " ".join("x" for _ in range(20)) + prose(9).replace(" ", ""),
    }
    rows = []
    for host in [f"fine{i}" for i in range(14)] + [None]:
        rows += [(prose(40) if rnd.random() > 0.05 else rnd.choice([*bad.values()])(), host) for _ in range(60)]
    for host, rule, share, many in (("spam", "lines", 0.7, 80), ("signs", "symbols", 0.8, 50), ("shouts", "base", 0.9, 90), ("small", "lines", 1.0, 1)):
        rows += [(bad[rule]() if rnd.random() < share else prose(40), host) for _ in range(many)]
    rows += [(None, "fine1"), ("", "fine2")]
    return [(i, text, host) for i, (text, host) in enumerate(rows)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, "j", 0.5) for r in rows], SCHEMA).repartition(3)


def test_bad_hosts_go_with_all_their_documents(spark):
    rows = _documents(1)
    got = {r.doc_id: r for r in host_rules.judge(_frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    failed = {r.host for r in got.values() if r.host_failed}
    assert {"spam", "signs", "shouts"} <= failed <= {"spam", "signs", "shouts", "small"}
    assert all(r.kept == (not r.base_failed and r.host not in failed) for r in got.values())
    # The verdict decides: good documents of bad hosts go, bad documents of good ones go alone.
    assert sum(not r.base_failed and not r.kept for r in got.values()) > 30
    assert sum(r.kept for r in got.values()) > 750


def test_query_equals_its_sql_where_verdicts_fall(spark, tmp_path):
    for seed in (2, 3):
        rows = _documents(seed)
        spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/{seed}/documents.parquet")
        got = queries.QUERIES["op6_host_rules"](spark, f"{tmp_path}/{seed}").toPandas()
        con = duckdb.connect()
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/{seed}/documents.parquet/*.parquet'")
        want = con.sql(queries.CHECKS["op6_host_rules"]).df()
        key = lambda df: df[sorted(df.columns)].sort_values("doc_id").reset_index(drop=True)
        pd.testing.assert_frame_equal(key(got), key(want), check_dtype=False)
        assert (got.kept != ~got.base_failed).sum() > 20


def test_prior_of_simulated_hosts():
    """The fit finds the parameters that rates were drawn with, and no spread where there is none."""
    rnd = np.random.default_rng(4)
    n = rnd.integers(5, 400, 3000)
    for mean, strength in ((0.1, 8.0), (0.3, 40.0)):
        failed = rnd.binomial(n, rnd.beta(mean * strength, (1 - mean) * strength, len(n)))
        prior = host_rules.fit_prior(len(n), n.sum(), (n * n).sum(), failed.sum(), (failed * (failed / n)).sum())
        assert prior.mean == pytest.approx(mean, rel=0.1) and prior.strength == pytest.approx(strength, rel=0.25)
    same = rnd.binomial(n, 0.2)
    assert host_rules.fit_prior(len(n), n.sum(), (n * n).sum(), same.sum(), (same * (same / n)).sum()).strength > 500
    for sums in ((0, 0, 0, 0, 0), (1, 9, 81, 3, 1), (2, 8, 32, 0, 0), (2, 8, 32, 8, 8)):
        assert host_rules.fit_prior(*sums).strength == host_rules.STRONGEST


def test_limits_follow_the_prior():
    assert host_rules.Prior(0.05, host_rules.STRONGEST).limit == host_rules.FLOOR
    assert host_rules.Prior(0.5, 1.0).limit == host_rules.HOST_LIMIT
    assert host_rules.FLOOR < host_rules.Prior(0.2, 8.0).limit <= host_rules.HOST_LIMIT
