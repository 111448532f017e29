"""Importance resampling of documents towards a target, over hashed runs of words.

A text's features are its runs of one to three words; a feature's bucket is the CRC-32 of its bytes. The
CRC of a run is the state of its beginning, moved on by the next word, and moving a state on is linear. So
the vocabulary is cut in two. Its head, the most frequent words by exact counts, is broadcast with the
state of each word, which moves whole arrays of states on by table lookups; so are the buckets of the most
frequent pairs. What is not in the head, the tail, takes the CRC of its bytes directly. Both give the same
numbers, so the cut decides the speed alone, and all totals are exact.

Words and pairs are counted in a pass each, buckets in a third, and a fourth weighs the documents. No pass
shuffles texts: tasks send counts of words, of at most FREQUENT ** 2 pairs and of the buckets.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import most_frequent, slices, staged, table, utf8
from ratelake.operators.spread import rank_over

BUCKETS = 10_000
#: Bounds of the head, which is broadcast: its words and their bytes, the words of its pairs, and the pairs.
WORDS, LONGEST, FREQUENT, PAIRS = 65_536, 64, 512, 65_536
#: Different words a task counts before it sends the counts on.
HELD = 400_000
SEED = 42

#: A-Z in lower case, and a blank for every byte that is in no word.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


@cache
def moves() -> np.ndarray:
    """For 0 to LONGEST + 1 bytes the map of a CRC behind so many zero bytes, as four tables of 256."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    now = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    found = [now]
    for _ in range(LONGEST + 1):
        now = (now >> np.uint32(8)) ^ step[now & np.uint32(255)]
        found.append(now)
    return np.concatenate(found)


@dataclass
class Vocabulary:
    """The head: its words by frequency, and its frequent pairs as numbers first * FREQUENT + second."""

    names: list[bytes]
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self):
        self.ids = {name: i for i, name in enumerate(self.names)}
        self.spaced = np.array([zlib.crc32(b" " + name) for name in self.names] + [0], np.uint32)
        self.alone = np.array([zlib.crc32(name) for name in self.names] + [0], np.uint32)
        self.size = np.array([len(name) + 1 for name in self.names] + [0], np.int64)
        first, second = self.pairs // FREQUENT, self.pairs % FREQUENT
        self.pair_state = self.moved(self.alone[first], second)
        self.pair_bucket = (self.pair_state % np.uint32(BUCKETS)).astype(np.int64)
        self.pair_place = np.full(FREQUENT * FREQUENT, -1, np.int32)
        self.pair_place[self.pairs] = np.arange(len(self.pairs))

    def __reduce__(self):
        return Vocabulary, (self.names, self.pairs)

    def look_up(self, found: list[bytes]) -> np.ndarray:
        """The words' places in the head; -1 for the tail."""
        return np.fromiter(map(self.ids.get, found, repeat(-1)), np.int64, len(found))

    def moved(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The CRCs behind a blank and a word of the head."""
        tables, at = moves(), self.size[ids] * 1024
        out = self.spaced[ids].copy()
        for k in range(4):
            out ^= tables[at + 256 * k + ((states >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int64)]
        return out

    def next_states(self, states: np.ndarray, found: list[bytes], ids: np.ndarray) -> np.ndarray:
        """The CRCs of runs that go on with `found`: by the head's tables, or directly."""
        out = self.moved(states, ids)
        tail = np.flatnonzero(ids < 0)
        if len(tail):
            out[tail] = [
                zlib.crc32(b" " + found[i], s) for i, s in zip(tail.tolist(), states[tail].tolist(), strict=True)
            ]
        return out

    def buckets(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the runs of one, two and three words that begin at each word of a long list."""
        ids = self.look_up(found)
        one = self.alone[ids]
        tail = np.flatnonzero(ids < 0)
        one[tail] = [zlib.crc32(found[i]) for i in tail.tolist()]
        first, second = ids[:-1], ids[1:]
        known = (first >= 0) & (second >= 0) & (first < FREQUENT) & (second < FREQUENT)
        place = np.where(known, self.pair_place[np.where(known, first * FREQUENT + second, 0)], -1)
        frequent, rest = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        two = np.empty(len(place), np.uint32)
        of_two = np.empty(len(place), np.int64)
        two[frequent], of_two[frequent] = self.pair_state[place[frequent]], self.pair_bucket[place[frequent]]
        two[rest] = self.next_states(one[:-1][rest], [found[i + 1] for i in rest.tolist()], second[rest])
        of_two[rest] = two[rest] % np.uint32(BUCKETS)
        three = self.next_states(two[:-1], found[2:], ids[2:])
        return (one % np.uint32(BUCKETS)).astype(np.int64), of_two, (three % np.uint32(BUCKETS)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(utf8(F.col("text")).alias("text"))


def _parts(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray]]:
    """Rows with all their words, one text behind the other, and where each text's words begin and end."""
    for batch in batches:
        for part in slices(batch, column):
            own = [words(raw) for raw in part.column(column).to_pylist()]
            ends = np.cumsum([0] + [len(w) for w in own])
            yield part, [w for text in own for w in text], ends


def _inside(ends: np.ndarray, run: int) -> np.ndarray:
    """Which words begin a run of `run` words of one text, of all but the last run - 1 words."""
    n = max(0, int(ends[-1]) - run + 1)
    inside = np.ones(n, bool)
    for back in range(1, run):
        at = ends[1:-1] - back
        inside[at[(at >= 0) & (at < n)]] = False
    return inside


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs in all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for _, found, _ in _parts(batches):
            counts.update(found)
            if len(counts) > HELD:
                yield sent(counts)
                counts = Counter()
        yield sent(counts)

    def sent(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    return _texts(docs).mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _summed(docs: DataFrame, head: Broadcast, size: int, of_part) -> DataFrame:
    """(place, n): sums over all texts of the arrays `of_part` gives for parts of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for _, found, ends in _parts(batches):
            if found:
                total += of_part(head.value, found, ends)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "n"])

    return _texts(docs).mapInArrow(work, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, size: int = WORDS, pairs: int = PAIRS) -> Vocabulary:
    """The most frequent words of all texts and the most frequent pairs of the first FREQUENT of them.

    At most `size` words of LONGEST bytes and `pairs` pairs, whatever the number of texts: small enough to broadcast.
    """
    counts = staged(word_counts(docs).filter(F.length("word") <= LONGEST), "resampling-words")
    often = sorted((-row["n"], bytes(row["word"])) for row in most_frequent(counts, size).collect())
    head = Vocabulary([word for _, word in often])

    def of_part(head: Vocabulary, found: list[bytes], ends: np.ndarray) -> np.ndarray:
        ids = head.look_up(found)
        ids[ids >= FREQUENT] = -1
        ok = _inside(ends, 2) & (ids[:-1] >= 0) & (ids[1:] >= 0)
        return np.bincount((ids[:-1] * FREQUENT + ids[1:])[ok], minlength=FREQUENT * FREQUENT)

    sent = docs.sparkSession.sparkContext.broadcast(head)
    top = most_frequent(staged(_summed(docs, sent, FREQUENT * FREQUENT, of_part), "resampling-pairs"), pairs)
    return Vocabulary(head.names, np.array([row["place"] for row in top.collect()], np.int64))


def bucket_totals(docs: DataFrame, head: Broadcast) -> np.ndarray:
    """How many features of all texts each bucket holds."""

    def of_part(head: Vocabulary, found: list[bytes], ends: np.ndarray) -> np.ndarray:
        one, two, three = head.buckets(found)
        counted = np.bincount(one, minlength=BUCKETS) + np.bincount(two[_inside(ends, 2)], minlength=BUCKETS)
        return counted + np.bincount(three[_inside(ends, 3)], minlength=BUCKETS)

    total = np.zeros(BUCKETS, np.int64)
    for row in _summed(docs, head, BUCKETS, of_part).collect():
        total[row["place"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in the target to that in the source, one added to each bucket."""
    s, t = int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((b + 1) * (s + BUCKETS)) / float((a + 1) * (t + BUCKETS))))
            for a, b in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighed(docs: DataFrame, head: Broadcast, gain: Broadcast) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found, ends in _parts(batches, 1):
            worth = np.zeros(len(found) + 1, np.int64)
            if found:
                for run, own in enumerate(head.value.buckets(found), 1):
                    worth[1 : len(own) + 1] += np.where(_inside(ends, run), gain.value[own], 0)
            upto = np.cumsum(worth)
            n = np.diff(ends)
            features = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
            weight = upto[ends[1:]] - upto[ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(features), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    return read.mapInArrow(work, "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 5, least: int = 20, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of `docs`: the draw of `percent` of them that is most like `target`.

    A score is a document's weight and a Gumbel value drawn from its id, so the highest scores are a draw
    without replacement in proportion to the weights. Documents of fewer than `least` words are not drawn.
    Only doc_id and text of `docs` and text of `target` are read. A NULL, empty or wordless text has no
    features and the weight 0; a NULL id draws as the empty text. Repeated rows are drawn each for itself,
    ties go to the smaller doc_id, a NULL one first. Empty tables give no rows; an empty target shifts no
    two buckets apart but by the source's counts.
    """
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(vocabulary(docs))
    gain = spark.sparkContext.broadcast(gains(bucket_totals(docs, head), bucket_totals(target, head)))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    drawn = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    order = [F.desc("eligible"), F.desc("score"), F.col("doc_id"), F.col("row")]
    scored = staged(
        weighed(docs, head, gain).select(
            "doc_id", "n_features", "weight", (F.col("weight") + drawn).alias("score"),
            (F.col("n_words") >= least).alias("eligible"), F.monotonically_increasing_id().alias("row"),
        ),
        "resampling-scores",
    )
    n = scored.agg(F.count_if("eligible").alias("n")).first()["n"]
    # Ranges of the order, written with their number: ranks inside ranges, and one count a range across them.
    ranges = staged(scored.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "resampling-ranges")
    ranked = rank_over(ranges, [], order, F.col("range"), "place")
    rank = F.when(F.col("place") <= percent * n // 100, F.col("place").cast("long"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and score towards the benchmark, and its rank among those drawn."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 by its table, a byte of every different run at a time.
OP11_SQL = r"""
WITH RECURSIVE
steps AS (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i)
),
worded AS (
    SELECT 'd' AS side, row_number() OVER () AS row, doc_id, text FROM documents
    UNION ALL
    SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
),
words AS (
    SELECT side, row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM worded
),
placed AS (SELECT side, row, unnest(w) AS a, generate_subscripts(w, 1) AS pos FROM words),
near AS (
    SELECT side, row, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c
    FROM placed WINDOW p AS (PARTITION BY side, row ORDER BY pos)
),
runs AS (
    SELECT side, row, a AS run FROM near
    UNION ALL
    SELECT side, row, a || ' ' || b FROM near WHERE b IS NOT NULL
    UNION ALL
    SELECT side, row, a || ' ' || b || ' ' || c FROM near WHERE c IS NOT NULL
),
counted AS (SELECT side, row, run, count(*) AS n FROM runs GROUP BY ALL),
crcs AS (
    SELECT run, hex(encode(run)) AS rest, 4294967295::BIGINT AS s FROM (SELECT DISTINCT run FROM counted)
    UNION ALL
    SELECT run, substr(rest, 3), xor(s >> 8, v) AS s
    FROM crcs JOIN steps
    ON i = xor(s, (instr('0123456789ABCDEF', rest[1]) - 1) * 16 + instr('0123456789ABCDEF', rest[2]) - 1) & 255
    WHERE rest <> ''
),
buckets AS (SELECT run, xor(s, 4294967295) % 10000 AS bucket FROM crcs WHERE rest = ''),
features AS (SELECT side, row, bucket, sum(n)::BIGINT AS n FROM counted JOIN buckets USING (run) GROUP BY ALL),
totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::BIGINT AS t
    FROM features GROUP BY bucket
),
whole AS (SELECT sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM totals),
gains AS (
    SELECT bucket, floor(1000 * ln(((totals.t + 1) * (whole.s + 10000))::DOUBLE / ((totals.s + 1) * (whole.t + 10000))::DOUBLE))::BIGINT AS gain
    FROM totals, whole
),
weights AS (SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (row) WHERE side = 'd'
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
        count(*) OVER (PARTITION BY n_words >= 20) AS n
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""
