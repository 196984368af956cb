"""The pipeline's stages on a small corpus with planted cases."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.oracle import compare, connect
from textloom.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} >= {n.split("_")[0] for n in queries.QUERIES} and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]


def test_rows_that_share_a_key_or_have_none_are_judged_by_their_own_texts(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    a, b, c = ("alpha beside quiet rivers", "gamma above old bridges", "delta among tall lanterns")
    rows = [(1, a), (1, b), (2, b), (3, c), (3, c), (4, f"mail x@mail.example.com {a} now"), (4, f"mail me, y@mail.example.com {c}"), (None, f"mail z@mail.example.com {b}"), (5, item), (5, f"{c} {c}"), (None, item)]
    docs = spark.createDataFrame([(k, t, None, "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    dedup = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert got(dedup.where("doc_id < 4")) == [(1, a), (1, b), (3, c)] and dedup.where("doc_id IS NULL").count() == 2
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert got(kept) == sorted((k or 0, t) for k, t in rows if t != item) and kept.columns == docs.columns
    clean = got(corpus_pipeline.redact_personal_data(spark, docs, SF))
    assert len(clean) == len(rows) and not any("@" in t for _, t in clean)
    assert {(4, f"mail [email] {a} now"), (4, f"mail me, [email] {c}"), (0, f"mail [email] {b}")} <= {*clean}


def test_stages_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    item = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").first().text
    clean = "Completely ordinary sentences about gardens rivers mountains bridges lanterns harbours engines and quiet libraries"
    planted = spark.createDataFrame(
        [(5001, clean, "en", "new", 1), (5002, clean.upper(), "en", "new", 1), (5003, f"Look here {item} and there", "en", "new", 1), (5004, "Write to somebody@mail.example.com soon please or never at all", "en", "new", 1)],
        docs.schema,
    )
    docs = docs.unionByName(planted)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.01").cache()
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    toxic = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic = 0").collect()}
    assert toxic <= {*kept["toxicity"]}
    assert 5001 in kept["near_duplicates"] and 5002 not in kept["near_duplicates"]
    assert 5003 in kept["near_duplicates"] and 5003 not in kept["decontamination"] and 5001 in kept["decontamination"]
    assert kept["personal_data"][5004] == "Write to [email] soon please or never at all"
    assert kept["personal_data"].keys() == kept["decontamination"].keys()


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_queries_equal_their_sql(spark, name):
    assert compare(spark, connect(SF), name, SF) in ("", "both empty")
