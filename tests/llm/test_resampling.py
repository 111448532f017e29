"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ratelake.llm import resampling
from tests.llm.conftest import DOCUMENTS

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(run):
    return zlib.crc32(run.encode()) % 10000


def brute(docs, target, percent=5):
    source, aim = Counter(), Counter()
    for _, text in docs:
        source.update(map(bucket, runs(text)[1]))
    for text in target:
        aim.update(map(bucket, runs(text)[1]))
    s, t = sum(source.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((source[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for i, (doc_id, text) in enumerate(docs):
        n, own = runs(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(r)] for r in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None, n, i])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0], r[6]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def found(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return Counter(map(tuple, df.collect()))


def test_hard_rows(hard, spark):
    target = spark.createDataFrame([(0, "alpha beta gamma alpha"), (1, None), (2, ""), (3, "Zwei WÖRTER")], "item_id long, text string")
    docs = [tuple(r) for r in hard.select("doc_id", "text").collect()]
    for percent in (5, 60):
        assert found(resampling.resampled(hard, target, percent)) == brute(docs, [r["text"] for r in target.collect()], percent)


def test_empty_tables(hard, empty, spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(empty, nothing).count() == 0
    docs = [tuple(r) for r in hard.select("doc_id", "text").collect()]
    assert found(resampling.resampled(hard, nothing)) == brute(docs, [])


def test_one_id_and_text_for_most_rows(spark):
    rows = [(7, "a b c d e f g h i j k l m n o p q r s t u", "en", None, 1, "s", "t", "l", "i", "k")] * 300 + [
        (i, f"x{i} " * 30, "en", None, 1, "s", "t", "l", "i", "k") for i in range(100)
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    target = spark.createDataFrame([(0, "a b c d")], "item_id long, text string")
    assert found(resampling.resampled(docs, target, 80)) == brute([r[:2] for r in rows], ["a b c d"], 80)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB \x00é😀z9", max_size=60), min_size=1, max_size=6), st.integers(0, 6))
def test_head_and_tail_give_the_crc_of_the_bytes(texts, n):
    names = sorted({w for t in texts for w in resampling.words(t.encode())})[:n]
    pairs = [a * resampling.FREQUENT + b for a in range(len(names)) for b in range(0, len(names), 2)]
    head = resampling.Vocabulary(names, resampling.np.array(pairs, resampling.np.int64))
    for text in texts:
        got = resampling.words(text.encode())
        own = [b"%s" % r.encode() for r in runs(text)[1]]
        if got:
            assert [x for part in head.buckets(got) for x in part.tolist()] == [zlib.crc32(r) % 10000 for r in own]


@pytest.mark.parametrize("size", [0, 3])
def test_the_head_decides_nothing(hard, spark, size, monkeypatch):
    target = spark.createDataFrame([(0, "alpha beta gamma alpha")], "item_id long, text string")
    want = found(resampling.resampled(hard, target, 50))
    whole = resampling.vocabulary
    monkeypatch.setattr(resampling, "vocabulary", lambda docs: whole(docs, size, size))
    assert found(resampling.resampled(hard, target, 50)) == want


def test_query_equals_sql(spark):
    small = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    df = resampling.op11_resampling(spark, small)
    want = con.execute(resampling.OP11_SQL)
    assert [d[0] for d in want.description] == df.columns
    assert found(df) == Counter(want.fetchall())
