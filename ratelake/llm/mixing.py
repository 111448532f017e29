"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order that follows from their ids, read up to
three times over. A document's virtual finish time is the words of its queue up to its end, divided by
the source's target. All sources merge by that time and are cut at the total budget, so at the cut each
source has given its target, but for one document.

No task holds a source: a queue's running sum is taken inside 4,096 buckets of the shuffled order, whose
sums are carried across them; the cut is found by two rounds of buckets of the finish time, and only the
last bucket is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged, table, word_count

#: Buckets of the finish time: COARSE to each factor e, each cut in FINE.
COARSE, FINE = 2048, 4096


def targets(sources: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """The words each source shall give, from (source, source_size): adds source_rank and target.

    Sources weigh `weights` in turn, in code point order with NULL last. They share the sum of all sizes
    by weight; a source is held at `repeats` times its size, and what lies above is shared by the others.
    In the order of size by weight the held sources come first, so running sums find the level at once.
    One row per source goes through one task. An empty table stays empty; sources without words get 0.
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy(F.col("_cap") / F.col("_weight"), "source_rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turns = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = (
        sources.withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("_weight", F.element_at(turns, ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * repeats)
        .withColumn("_total", F.sum("source_size").over(everything))
    )
    left = F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = F.first(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level")), ignorenulls=True)
    return (
        ranked.withColumn("_level", left / F.sum("_weight").over(onward))
        .withColumn("_level", level.over(whole))
        .withColumn(
            "target",
            F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level") * F.col("_weight"), F.lit(0.0))),
        )
        .select("source", "source_size", "source_rank", "target")
    )


def _crossing(sums: DataFrame, key: str, base: int, budget: int) -> tuple[int, int] | None:
    """The first key at which the running sum of `words` passes the budget, and the sum before it."""
    running = F.sum("words").over(Window.orderBy(key))
    row = (
        sums.withColumn("_upto", running + F.lit(base))
        .filter(F.col("_upto") > F.lit(budget))
        .agg(F.min_by(F.struct(F.col(key).alias("key"), (F.col("_upto") - F.col("words")).alias("base")), key).alias("at"))
        .first()
    )
    return (row["at"]["key"], row["at"]["base"]) if row["at"] is not None else None


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), repeats: int = 3) -> DataFrame:
    """How often the mix takes each document: one row per (doc_id, source, size), with n rows of `docs`.

    Reads doc_id, source and text; other columns are neither read nor returned. Returns doc_id, source,
    size, n, source_size, target, passes (0 to `repeats`) and taken = size * passes. A NULL text has size
    0 and is never taken; a NULL source is a source, a NULL id an id. Rows that agree in id, source and
    size are one place in the queue and share one answer. Equal finish times go by source, so reruns agree.
    """
    entries = staged(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("n")),
        "mix-entries",
    )
    sources = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aimed = targets(sources, weights, repeats).withColumnRenamed("source", "_source")
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = (
        entries.join(aimed, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_order", shuffled)
        .withColumn("_bucket", F.conv(F.substring("_order", 1, 3), 16, 10).cast("int"))
        .withColumn("_words", F.col("size") * F.col("n"))
    )
    before = Window.partitionBy("source_rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("source_rank", "_bucket")
        .agg(F.sum("_words").alias("_sum"))
        .select("source_rank", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("source_rank", "_bucket")
        .orderBy("_order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    queued = staged(
        placed.withColumn("_in", F.sum("_words").over(inside))
        .join(offsets, ["source_rank", "_bucket"])
        .withColumn("_upto", F.col("_in") + F.col("_offset"))
        .drop("_in", "_offset", "_order", "_bucket"),
        "mix-queued",
    )

    def end(turn: Column) -> Column:
        return F.col("_upto") + turn * F.col("source_size")

    def bucket(finish: Column) -> Column:
        return F.floor(F.log1p(finish) * (COARSE * FINE))

    served = (
        queued.filter("size > 0")
        .select("source_rank", "_words", "target", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_turn"), "_upto", "source_size")
        .select("source_rank", F.col("_words").alias("words"), end(F.col("_turn")).alias("_end"), "target")
        .withColumn("_finish", F.col("_end") / F.col("target"))
        .withColumn("_fine", bucket(F.col("_finish")))
        .withColumn("_coarse", F.floor(F.col("_fine") / FINE))
    )
    budget = queued.agg(F.coalesce(F.sum("_words"), F.lit(0)).alias("budget")).first()["budget"]
    coarse = _crossing(served.groupBy("_coarse").agg(F.sum("words").alias("words")), "_coarse", 0, budget)
    if coarse is None:
        passes = F.when(F.col("size") > 0, F.lit(repeats)).otherwise(F.lit(0))
    else:
        inner = served.filter(F.col("_coarse") == F.lit(coarse[0]))
        fine, base = _crossing(inner.groupBy("_fine").agg(F.sum("words").alias("words")), "_fine", coarse[1], budget)
        order = Window.orderBy("_finish", "source_rank", "_end")
        last = (
            inner.filter(F.col("_fine") == F.lit(fine))
            .withColumn("_run", F.sum("words").over(order) + F.lit(base))
            .filter(F.col("_run") <= F.lit(budget))
            .agg(F.max(F.struct("_finish", "source_rank", "_end")).alias("at"))
            .first()["at"]
        )

        def taken_in(turn: int) -> Column:
            finish = end(F.lit(turn)) / F.col("target")
            inside_cut = bucket(finish) < F.lit(fine)
            if last is not None:
                key = F.struct(finish, F.col("source_rank"), end(F.lit(turn)))
                cut = F.struct(F.lit(last["_finish"]), F.lit(last["source_rank"]), F.lit(last["_end"]).cast("long"))
                inside_cut = inside_cut | ((bucket(finish) == F.lit(fine)) & (key <= cut))
            return F.when((F.col("size") > 0) & inside_cut, 1).otherwise(0)

        passes = sum((taken_in(turn) for turn in range(1, repeats)), taken_in(0))
    return queued.select(
        "doc_id", "source", "size", "n", "source_size", "target", passes.cast("int").alias("passes")
    ).withColumn("taken", F.col("size") * F.col("passes"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, a row for each time it takes one, with the columns of `docs`.

    NULL, empty and wordless texts have no size and are never taken, however the sources stand. Repeated rows are
    taken as often each; rows that tie in the queue go together, and reruns agree. No rows give none.
    """
    taken = mix(docs).filter("passes > 0").select("doc_id", "source", "size", "passes")
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
        & F.col("row.source").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size"))
    )
    return (
        docs.select(F.struct("*").alias("row"), word_count(F.col("text")).alias("words"))
        .join(taken, same)
        .select("row", F.explode(F.sequence(F.lit(1), F.col("passes"))))
        .select("row.*")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it."""
    taken = mix(table(spark, sf_dir, "documents"))
    return taken.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP4_SQL = r"""
WITH entries AS (
  SELECT doc_id, source, size, count(*) AS n
  FROM (SELECT doc_id, source,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents)
  GROUP BY ALL),
sources AS (
  SELECT *, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
  FROM (SELECT source, CAST(sum(n * size) AS BIGINT) AS source_size FROM entries GROUP BY source)),
levels AS (
  SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source_rank
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (ORDER BY cap / weight, source_rank
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM sources),
level AS (SELECT arg_min(level, cap / weight) AS level FROM levels WHERE level * weight <= cap),
aimed AS (
  SELECT source, source_size, source_rank,
         least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM level) * weight, 0.0)) AS target
  FROM sources),
queued AS (
  SELECT e.*, a.source_size, a.source_rank, a.target,
         CAST(sum(e.n * e.size) OVER (PARTITION BY a.source_rank
           ORDER BY md5(coalesce(CAST(e.doc_id AS VARCHAR), '')), e.doc_id, e.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM entries e JOIN aimed a ON e.source IS NOT DISTINCT FROM a.source),
served AS (
  SELECT doc_id, source_rank, size, n * size AS words, upto + turn * source_size AS ends,
         (upto + turn * source_size) / target AS finish
  FROM queued, (VALUES (0), (1), (2)) t(turn) WHERE size > 0),
cut AS (
  SELECT *, sum(words) OVER (ORDER BY finish, source_rank, ends
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM served),
passes AS (
  SELECT doc_id, source_rank, size, count(*) AS passes FROM cut
  WHERE run <= (SELECT sum(n * size) FROM entries) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(p.passes, 0) AS taken
FROM queued q LEFT JOIN passes p
  ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.source_rank = p.source_rank AND q.size = p.size,
  range(q.n) r
"""
