"""The pipeline stage by stage: each works on all rows its predecessor kept, and its decisions hold."""

from collections import Counter

import pytest

import corpus_pipeline
from ratelake.llm import mixing, secrets, simhash, toxicity

from .test_operators import check_packing


@pytest.fixture(scope="module")
def tables(spark, small):
    """What goes into each stage, and what comes out of the last."""
    from ratelake import session

    docs = spark.read.parquet(f"{small}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = session.staged(stage(spark, docs, small), session.run_dir(spark, f"test-{name}"))
        made.append(docs)
    return made


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_keep_the_columns(tables):
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_toxic_documents_go_and_others_stay(spark, small, tables):
    scored = toxicity.toxicity(tables[0], spark.read.parquet(f"{small}/labels.parquet"))
    bad = {r["doc_id"] for r in scored.filter("predicted = 1").collect()}
    assert rows(tables[1]) == Counter({k: n for k, n in rows(tables[0]).items() if k[0] not in bad})


def test_one_of_each_group_stays(tables):
    heads = {r["component_id"] for r in simhash.near_duplicates(tables[1]).collect()}
    kept = rows(tables[2])
    assert {k[0] for k in kept} == heads and not kept - rows(tables[1]) and max(kept.values()) == 1


def test_secrets_are_masked(tables):
    found = {r["doc_id"]: [s["value"] for s in r["secrets"]] for r in secrets.scan(tables[2]).collect()}
    before = {r["doc_id"]: r for r in tables[2].collect()}
    for r in tables[3].collect():
        text = before[r["doc_id"]]["text"]
        for value in sorted(set(found[r["doc_id"]]), key=len, reverse=True):
            text = text.replace(value, secrets.MASK)
        assert r["text"] == text and (r["n_chars"] == len(text) or not found[r["doc_id"]])
    assert tables[3].count() == tables[2].count()


def test_mix_and_packing(tables):
    taken = {r["doc_id"]: r["passes"] for r in mixing.mix(tables[3]).collect()}
    assert Counter(r["doc_id"] for r in tables[4].collect()) == +Counter(taken)
    check_packing([(r["doc_id"], r["text"]) for r in tables[4].collect()], tables[5].collect())


def test_run_gives_the_last_stage(spark, small, tables):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert rows(corpus_pipeline.run(spark, small).select(*key)) == rows(tables[5].select(*key))
