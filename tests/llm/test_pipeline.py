"""The pipeline, stage by stage, and the registered queries against their SQL."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.test_operators import LONG, base_spans, components, split
from tools.compare import TABLES, rows_of
from vocatio.llm import language_id, tables
from vocatio.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(contract.oracle_sql())))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    found = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert found == rows_of(names, result.fetchall())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = [(9001, None, "en", "s", 0), (9002, "12 34", None, None, 5), (9003, LONG, "en", "s", len(LONG))]
    docs = docs.unionByName(spark.createDataFrame(extra + extra[2:], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language"](spark, docs, SF_DIR).cache()
    left = {r["doc_id"] for r in known.collect()}
    assert known.columns == docs.columns and not left & {9001, 9002} and len(left) >= 0.99 * (docs.count() - 3)
    one = stages["near_duplicates"](spark, known, SF_DIR).cache()
    expected = components([(r["doc_id"], r["text"]) for r in known.collect()], 80)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c for _, c in expected.values()})
    clean = stages["benchmark"](spark, one, SF_DIR).cache()
    items = [" ".join(split(r["text"])) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert not any(item in " ".join(split(r["text"])) for r in clean.collect() for item in items)
    safe = stages["secrets"](spark, clean, SF_DIR).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    assert all(base_spans(r["text"]) == "" for r in safe.collect())
    pieces = stages["packing"](spark, safe, SF_DIR).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in safe.collect()}
    assert np.all([r["length"] == len(r["ids"]) for r in pieces])


def test_least_language_score_comes_from_all_labelled_documents(spark):
    """Labelled documents beyond those that a network learns from count for the threshold as well."""
    sample = [("aa", "abab baba"), ("bb", "cdcd dcdc")] * 5
    net = language_id.train(sample)
    rows = [(i, lang, text) for i, (lang, text) in enumerate(sample * 200)]
    rows += [(5000 + i, "aa", "acbd dbca bdac cadb") for i in range(100)] + [(6000, None, "zzzz"), (6001, "aa", "1")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    scored = language_id.scored(docs, net).cache()
    assert scored.count() == len(rows) - 1
    scores = sorted(r[language_id.SCORE] for r in scored.collect() if r["lang"])
    lowest = scores[int(0.01 * (len(scores) - 1))]
    least = language_id.least_score(net, scored.filter("lang IS NOT NULL"))
    assert abs(least - (0.5 + (lowest - 0.5) / 2)) <= 1 / language_id.SCORE_STEPS
    assert least < language_id.least_score(net, sample) - 0.01
    kept = language_id.keep_scored(scored, least)
    assert kept.columns == docs.columns and kept.filter("lang IS NOT NULL").count() >= 0.99 * (len(rows) - 2)


def test_workers_give_freed_memory_back(monkeypatch):
    """After the last batch, a worker lets go what other stages left there and hands freed memory back."""
    monkeypatch.setattr(tables, "IDLE_SECONDS", -1)
    tables.once_per_worker("of another stage", lambda: 1)
    pool = type("Pool", (), {"release_unused": lambda self: events.append("released")})()
    events = []
    monkeypatch.setattr(tables.pa, "default_memory_pool", lambda: pool)

    def uses(batches):
        yield from batches
        events.append("of another stage" in tables.sys.modules["pyspark"].__dict__["_vocatio_llm"])

    assert list(tables.lean(uses)([1, 2])) == [1, 2]
    assert events == [True, "released"]
    assert "of another stage" not in tables.sys.modules["pyspark"].__dict__["_vocatio_llm"]


def test_run_and_empty_documents(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 200
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
