"""Toxicity by non-negative positive-unlabelled learning.

Toxic labels confirm some texts; everything else is unlabelled, not clean. A linear classifier over the
words of a text and the beginnings of its words is trained with numpy on the risk
    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])
with logistic loss. Where the part for negatives falls below zero its gradient is turned round, as the
method has it, so the classifier can't win by taking confirmed texts out of the unlabelled ones.

The fit sees a bounded sample; scoring is one pass over all texts without an exchange.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelake.llm.common import table, utf8

#: Bounds of the sample a fit sees: confirmed and unlabelled texts, the least by a hash of the id.
POSITIVES, UNLABELLED = 4000, 12000
THRESHOLD = 0.7
BEGINNINGS = (4, 5, 6)
#: Standard deviations by which a feature must be more frequent in confirmed texts.
SURPRISE = 4.0
#: Words whose weight a task keeps; beyond, it starts anew.
CACHE = 400_000
WORDS = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Hashes of a word and of its beginnings, so that endings of a language don't hide a stem."""
    found = [zlib.crc32(word.encode())]
    return found + [zlib.crc32(f"{word[:n]}*".encode()) for n in BEGINNINGS if len(word) > n]


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: the crc32 of the id as text leaves 1 by 3. NULL is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The features of confirmed and of unlabelled texts, outside the held-out rows."""
    order = F.xxhash64("doc_id")
    toxic = labels.filter((F.col("toxic") == 1) & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    some = docs.filter(~held_out(F.col("doc_id"))).select("doc_id").distinct()
    chosen = (
        toxic.orderBy(order, "doc_id").limit(positives).withColumn("_confirmed", F.lit(True))
        .unionByName(some.orderBy(order, "doc_id").limit(unlabelled).withColumn("_confirmed", F.lit(False)))
        .select(F.col("doc_id").alias("_id"), "_confirmed")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch.column(1):
                words = set(WORDS.findall(raw.as_py().decode("utf-8", "replace").lower()))
                own = {f for w in words for f in features(w)}
                found.append(np.fromiter(own, np.uint32, len(own)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["confirmed", "features"])

    # The sample is bounded by its two parameters, so it may be broadcast and collected.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("_confirmed", utf8(F.col("text")).alias("text"))
        .mapInArrow(work, "confirmed boolean, features binary")
        .toArrow()
    )
    sides = ([], [])
    for confirmed, own in sorted(zip(rows["confirmed"].to_pylist(), rows["features"].to_pylist(), strict=True)):
        sides[0 if confirmed else 1].append(np.frombuffer(own, np.uint32))
    return sides


def _prior(labels: DataFrame) -> float:
    """Share of toxic among the labels that may be learnt from; 1 % to 50 %."""
    row = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).agg(F.avg("toxic").alias("p")).first()
    return min(0.5, max(0.01, row["p"] or 0.0))


def train(
    confirmed: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
    epochs: int = 40, batches: int = 8, rate: float = 0.05, decay: float = 1e-4, seed: int = 7,
) -> tuple[dict[int, float], float]:
    """Weights by feature hash, and the bias; without confirmed texts no weights and a bias of -10.

    Features take part that more confirmed texts have than the rate among unlabelled texts explains.
    """
    if not confirmed or not unlabelled:
        return {}, -10.0
    n, m = len(confirmed), len(unlabelled)
    names, often = np.unique(np.concatenate(confirmed), return_counts=True)
    names, often = names[often >= 3], often[often >= 3]
    if not len(names):
        return {}, -10.0
    # Only what several confirmed texts have can be used, so nothing else of a text is kept.
    held = []
    for text in confirmed + unlabelled:
        at = np.minimum(np.searchsorted(names, text), len(names) - 1)
        held.append(at[names[at] == text].astype(np.int32))
    columns = np.concatenate(held)
    rows = np.repeat(np.arange(n + m), [len(t) for t in held])
    rare = np.bincount(columns[rows >= n], minlength=len(names))
    expected = n * (rare + 0.5) / (m + 1)
    use = often - expected >= SURPRISE * np.sqrt(expected + 0.5)
    if not use.any():
        return {}, -10.0
    names = names[use]
    place = np.cumsum(use) - 1
    keep = use[columns]
    rows, columns = rows[keep], place[columns[keep]]
    ends = np.searchsorted(rows, np.arange(n + m + 1))

    weights, bias = np.zeros(len(names)), math.log(prior / (1 - prior))
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    random, step = np.random.default_rng(seed), 0

    def pick(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = ends[ids + 1] - ends[ids]
        at = np.repeat(ends[ids] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        return np.repeat(np.arange(len(ids)), sizes), columns[at]

    for _ in range(epochs):
        some, others = random.permutation(n), n + random.permutation(m)
        for p, u in zip(np.array_split(some, min(batches, n, m)), np.array_split(others, min(batches, n, m)), strict=True):
            ids = np.concatenate([p, u])
            own, cols = pick(ids)
            g = bias + np.bincount(own, weights[cols], len(ids))
            s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            gp, sp, su = g[: len(p)], s[: len(p)], s[len(p) :]
            negative = np.logaddexp(0, g[len(p) :]).mean() - prior * np.logaddexp(0, gp).mean()
            slope = np.concatenate([-prior * sp / len(p), su / len(u)])  # of the part for negatives
            if negative >= 0:
                slope[: len(p)] += prior * (sp - 1) / len(p)
            else:
                slope = -slope
            whole = np.append(np.bincount(cols, slope[own], len(names)) + decay * weights, slope.sum())
            step += 1
            first = 0.9 * first + 0.1 * whole
            second = 0.999 * second + 0.001 * whole**2
            move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
    return dict(zip(names.tolist(), weights.tolist(), strict=True)), float(bias)


def toxicity(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `docs`, from its text alone.

    Only doc_id and text are read; doc_id decides what may be learnt and enters no score. A NULL text is
    empty and gets the score of the bias. Labels without toxic = 1 give every text a score near 0. Labels of
    other rows, repeated or NULL labels do no harm: an id is confirmed if any of its labels is 1. Words
    count once a text, so a score neither ends with a prefix nor grows with a repeated line.
    """
    rows = docs.select(F.struct("doc_id", held_out(F.col("doc_id")).alias("held_out")).alias("row"), utf8(F.col("text")).alias("text"))
    model = train(*_sample(docs, labels, positives, unlabelled), _prior(labels))
    return scored(rows, *model).select("row.*", "score").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def scored(rows: DataFrame, weights: dict[int, float], bias: float) -> DataFrame:
    """(row, score) for (row, text as bytes): the row passes by as it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            scores = []
            for raw in batch.column(1):
                words = set(WORDS.findall(raw.as_py().decode("utf-8", "replace").lower()))
                fresh = words.difference(known)
                if len(known) > CACHE:
                    known.clear()
                    fresh = words
                for word in fresh:
                    known[word] = sum(weights.get(f, 0.0) for f in features(word))
                g = bias + math.fsum(map(known.__getitem__, words))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, g)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    kind = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(work, kind)


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not scored as toxic, with all their columns. No exchange.

    Each row is kept or not by its own text: repeated rows alike, NULL and empty texts by the bias, and a score
    of exactly THRESHOLD goes. Without confirmed labels every row stays. No rows give none.
    """
    rows = docs.select(F.struct("*").alias("row"), utf8(F.col("text")).alias("text"))
    model = train(*_sample(docs, labels, POSITIVES, UNLABELLED), _prior(labels))
    return scored(rows, *model).filter(F.col("score") < THRESHOLD).select("row.*")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
