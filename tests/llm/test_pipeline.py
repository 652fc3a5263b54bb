"""Each stage of the pipeline against what its operator decides, on its own input."""

import sys

import pytest
from corpus import words

import __spark_entry__ as entry
from riskspark.llm import ngram_join, recompression, secrets, toxicity
from riskspark.llm.common import documents, read_table, written
from riskspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    docs, out = documents(spark, SF), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "near_duplicates", "repeated_passages", "secrets", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_decisions_take_effect(spark, stages):
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = stages
    machine = toxicity.fit_machine(a, read_table(spark, SF, "labels"))
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(a, machine).collect()}
    assert set(texts(b)) == {i for i, s in score.items() if s < toxicity.THRESHOLD}
    groups = ngram_join.near_duplicates(b, 5, 80).collect()
    assert set(texts(c)) == {r["component_id"] for r in groups}
    first, expected = {}, {}
    for i, t in sorted(texts(c).items()):
        w = words(t)
        gone = set()
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k:k + 13]), i) < i:
                gone |= set(range(k, k + 13))
        expected[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    assert texts(d) == expected
    hidden = {(r["doc_id"], r["value"]) for r in secrets.findings(d).where("secret").collect()}
    masked = texts(e)
    assert all(v not in masked[i] for i, v in hidden)
    assert {i for i, _ in hidden} == {i for i, t in masked.items() if t != texts(d)[i]}
    assert {r["doc_id"] for r in f.collect()} == set(masked)


def test_registered(spark):
    registered = entry.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in registered) == 1
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert recompression.WINDOW == 13


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert not any(k.startswith("op") and k[2:3].isdigit() for k in entry.queries())
    assert entry.oracle_sql()
