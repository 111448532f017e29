"""Alignment of two tokenizers against brute force."""

import hashlib
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratelake.llm import alignment
from tests.llm.conftest import DOCUMENTS

FIRST, SECOND = alignment.paths()


@pytest.fixture(scope="module")
def tokenizers():
    one = Tokenizer.from_file(FIRST)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def pieces(text, tokenizers):
    """Ids of both sides with the bytes of their tokens."""
    one, two = tokenizers
    byte_of = alignment.byte_of()
    a = [(i, bytes(byte_of[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in two.encode(text):
        piece = two.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
    return a, b


def groups(text, tokenizers):
    if not text:
        return None
    a, b = pieces(text, tokenizers)
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return None
    ends = []
    for side in (a, b):
        at = np.cumsum([len(x) for _, x in side]).tolist()
        ends.append(dict(zip(at, range(1, len(side) + 1), strict=True)))
    found, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        found.append(([x for x, _ in a[i : ends[0][end]]], [x for x, _ in b[j : ends[1][end]]]))
        i, j = ends[0][end], ends[1][end]
    return found


def brute(docs, tokenizers):
    found = [(doc_id, groups(text, tokenizers)) for doc_id, text in docs]
    counts, links = Counter(), []
    for _, own in found:
        pairs = Counter((x, y) for a, b in own or [] for x in a for y in b)
        counts.update(pairs.keys())
        links.append(pairs)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = Counter()
    for (doc_id, own), pairs in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own or [])
        rows[
            doc_id, sum(len(a) for a, _ in own or []), sum(len(b) for _, b in own or []), len(own or []), sum(pairs.values()),
            hashlib.sha256(text.encode()).hexdigest() if own is not None else "",
            sum(n for p, n in pairs.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in pairs.items()),
        ] += 1
    return rows


def found(df):
    return Counter(
        map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect())
    )


ODD = ["a  b \t\n c", "▁x", "<0x41> <|endoftext|>", "x\x1cy \x1f z", "\x00", " lead", "trail \n", "日本語 テスト", "é ﬁ   x", "don't 12345 ...", "\r\n\r\n"]


@pytest.mark.parametrize("head", [0, 40, alignment.HEAD])
def test_hard_rows_with_and_without_a_head(hard, spark, tokenizers, head):
    more = [(1000 + i, t, "en", None, 1, "s", "t", "l", "i", "k") for i, t in enumerate(ODD)]
    docs = hard.unionByName(spark.createDataFrame(more, DOCUMENTS))
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], tokenizers)
    assert found(alignment.alignment(docs, head=head)) == want


def test_nothing(empty):
    assert alignment.alignment(empty).count() == 0


def test_ties_are_all_best(spark, tokenizers):
    docs = spark.createDataFrame([(1, "tie one"), (2, "tie one"), (3, "xqzv jjkw"), (None, "xqzv")], "doc_id long, text string")
    assert found(alignment.alignment(docs)) == brute([tuple(r) for r in docs.collect()], tokenizers)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="aé \n\t'.1▁\x1c😀日B", max_size=60), min_size=1, max_size=5))
def test_windows_give_the_groups_of_whole_texts(texts):
    own = alignment.aligner(FIRST, SECOND)
    both = own.first.tokenizer, own.second.model
    for text, row in zip(texts, own.align([t.encode() for t in texts]), strict=True):
        want = groups(text, both)
        if want is None:
            assert row is None
        else:
            assert row[4].decode() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want)
            assert row[:4] == (sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want), sum(len(a) * len(b) for a, b in want))


def test_long_groups_count_repeats(tokenizers):
    own = alignment.Aligner(FIRST, SECOND)
    one, two = own.first.encode([" " + "x" * 3000])[0], own.second.encode(["x" * 3000])[0]
    assert sum(w.links for w in own.windows(one, two)) == sum(len(a) * len(b) for a, b in groups("x" * 3000, tokenizers))


def test_query(spark, small, tokenizers):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    assert found(alignment.op12_alignment(spark, small)) == brute([tuple(r) for r in docs.collect()], tokenizers)


def test_groups_as_text(hard):
    rows = alignment.aligned(hard, FIRST, SECOND, with_groups=True).filter(F.col("n_a") > 0).collect()
    assert rows and all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in rows)


def test_texts_side_by_side_keep_their_links(tokenizers):
    texts = ["x" * 3000, "", "don't 12345", "▁x", "x" * 500 + " a", "日本語 " + "7" * 300]
    for text, row in zip(texts, alignment.aligner(FIRST, SECOND).align([t.encode() for t in texts]), strict=True):
        want = groups(text, tokenizers)
        assert (row is None) == (want is None)
        if row:
            pairs = Counter(x << 16 | y for a, b in want for x in a for y in b)
            found = zip(np.frombuffer(row[5], "<u4").tolist(), np.frombuffer(row[6], "<i8").tolist(), strict=True)
            assert list(found) == sorted(pairs.items())


def test_new_words_cost_no_calls_each():
    own, calls = alignment.Aligner(FIRST, SECOND), 0
    text = " ".join(f"ward{i}qz" for i in range(2000))
    one, two = own.first.encode([" " + text])[0], own.second.encode([text])[0]

    def count(*_):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    try:
        own.windows(one, two)
    finally:
        sys.setprofile(None)
    assert calls < 2000
