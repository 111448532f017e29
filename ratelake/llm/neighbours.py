"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample; every vector is indexed, that is, led down to a leaf. A query walks
the tree through a priority queue, nearest centre first, and so ranks the leaves. How many it visits is
calibrated: for some queries the true neighbours are found by brute force, and visits are widened until the
wanted share of those neighbours lies in visited leaves.

Queries meet vectors in blocks: both are grouped by leaf into chunks of bounded size, and only the best few
of a block leave a task. Copies of a vector are reduced first to those of the smallest ids that any answer
could hold, which loses nothing as ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged, table

K = 10
#: Vectors the fit of the tree may see, and the least of them that make a leaf.
SAMPLE, LEAST = 32_768, 16
#: Vectors a leaf is meant for, while the sample allows as many leaves.
PER_LEAF = 256
BRANCHES = 8
#: Queries of the calibration, and the share of their true neighbours that visits must reach.
CALIBRATION, RECALL = 64, 0.98
#: Vectors and queries in a block.
VECTORS, QUERIES = 4096, 512


class Tree:
    """Centres by level: node 0 is the root; children[i] are nodes, leaf[i] is a leaf's number or -1."""

    def __init__(self, sample: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 3):
        self.centres: list[np.ndarray] = [sample.mean(0)] if len(sample) else [np.zeros(1)]
        self.children: list[list[int]] = [[]]
        self.leaf: list[int] = [-1]
        self.leaves = 0
        self.random = np.random.default_rng(seed)
        self.size = max(LEAST, len(sample) // max(1, leaves))
        self.branches = branches
        self._split(0, sample)
        self.blocks = [np.array([self.centres[c] for c in kids]) if kids else None for kids in self.children]

    def _split(self, node: int, own: np.ndarray) -> None:
        groups = self._kmeans(own) if len(own) > 1.5 * self.size else []
        if len(groups) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return
        for centre, part in groups:
            child = len(self.centres)
            self.centres.append(centre)
            self.children.append([])
            self.leaf.append(-1)
            self.children[node].append(child)
            self._split(child, part)

    def _kmeans(self, own: np.ndarray, rounds: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
        k = min(self.branches, max(2, len(own) // self.size))
        centres = np.unique(own[self.random.permutation(len(own))[: 4 * k]], axis=0)
        centres = self.random.permutation(centres)[:k]
        for _ in range(rounds):
            near = nearest(own, centres)
            centres = np.array([own[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
        near = nearest(own, centres)
        return [(c, own[near == i]) for i, c in enumerate(centres) if (near == i).any()]

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at each level."""
        found = np.zeros(len(rows), np.int32)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            if self.blocks[node] is None:
                found[own] = self.leaf[node]
                continue
            near = nearest(rows[own], self.blocks[node])
            todo += [(c, own[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return found

    def order(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.blocks[node] is None:
                yield self.leaf[node]
                continue
            away = ((self.blocks[node] - query) ** 2).sum(1)
            for child, d in zip(self.children[node], away.tolist(), strict=True):
                heapq.heappush(queue, (d, child))


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(1)


def best(ids: np.ndarray, rows: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k rows nearest to a query, by exact distance in double precision, ties to smaller ids."""
    away = np.sqrt(((rows - query) ** 2).sum(1))
    others = np.nonzero(ids != query_id)[0]
    if len(others) > k:
        limit = np.partition(away[others], k - 1)[k - 1]
        others = others[away[others] <= limit]
    others = others[np.lexsort((ids[others], away[others]))][:k]
    return ids[others], away[others]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part; v in double precision.

    Left out are NULL ids, and vectors that are NULL, zero, hold a NULL or a non-finite component, or have
    another length than most (of equally common lengths the larger).
    """
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fine = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        .filter("vec_id is not null and v is not null and size(v) > 0")
        .filter(F.forall("v", number) & F.exists("v", lambda x: x != 0))
    )
    sizes = fine.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.agg(F.max(F.struct("n", "size")).alias("m")).first()["m"]
    return fine.filter(F.size("v") == F.lit(common["size"] if common else 0))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def search(vectors: DataFrame, asked: Column | None = None, k: int = K, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among all other rows.

    `vectors` has vec_id and embedding; `asked` tells the queries, by default ids divisible by 100. A
    query's own id is no answer. A row that repeats an id and its vector counts once; of an id with several
    vectors the least one asks. Fewer rows than k give fewer answers, none gives none.
    """
    asked = F.col("vec_id") % 100 == 0 if asked is None else asked
    fine = staged(usable(vectors), "ann-rows")
    copies = Window.partitionBy("v").orderBy("vec_id")
    kept = fine.withColumn("_copy", F.dense_rank().over(copies)).filter(F.col("_copy") <= k + 1).select("vec_id", "v")
    kept = staged(kept.distinct(), "ann-kept")
    questions = fine.filter(asked).groupBy("vec_id").agg(F.min("v").alias("v"))

    rows = kept.count()
    sample = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    tree = Tree(_matrix(sample), rows // PER_LEAF)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.assign(_matrix(batch.column(1))), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), leaf], names=["vec_id", "v", "leaf"])

    indexed = staged(kept.mapInArrow(lead, "vec_id long, v array<double>, leaf int"), "ann-index")
    # At most SAMPLE / LEAST leaves, so their counts may be collected and broadcast.
    sizes = {r["leaf"]: r["n"] for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    visits = _calibrated(tree, indexed, questions, k, recall)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, leaves = [], []
            for i, query in enumerate(_matrix(batch.column(1))):
                seen = 0
                for number, leaf in enumerate(tree.order(query)):
                    if number >= visits and seen > k:
                        break
                    if leaf in sizes:
                        owners.append(i)
                        leaves.append(leaf)
                        seen += sizes[leaf]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owners, pa.int64())), batch.column(1).take(pa.array(owners, pa.int64())), pa.array(leaves, pa.int32())],
                names=["query_id", "q", "leaf"],
            )

    routed = staged(questions.mapInArrow(route, "query_id long, q array<double>, leaf int"), "ann-routed")

    def blocks(df: DataFrame, id_: str, vector: str, size: int) -> DataFrame:
        counts = df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("_chunks"))
        return (
            df.join(F.broadcast(counts), "leaf")
            .groupBy("leaf", F.pmod(F.xxhash64(id_), F.col("_chunks")).alias(f"{id_}_chunk"))
            .agg(F.collect_list(F.struct(id_, vector)).alias(f"{id_}s"))
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asks, has = batch.column(0)[i].values, batch.column(1)[i].values
                asks_ids, asks_rows = asks.field(0).to_numpy(zero_copy_only=False), _matrix(asks.field(1))
                ids, own = has.field(0).to_numpy(zero_copy_only=False), _matrix(has.field(1))
                out = [(q, *best(ids, own, q, row, k)) for q, row in zip(asks_ids, asks_rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(asks_ids, [len(o[1]) for o in out]), pa.int64()),
                        pa.array(np.concatenate([o[1] for o in out]), pa.int64()),
                        pa.array(np.concatenate([o[2] for o in out]), pa.float64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    met = blocks(routed, "query_id", "q", QUERIES).join(blocks(indexed, "vec_id", "v", VECTORS), "leaf")
    found = met.select("query_ids", "vec_ids").mapInArrow(compare, "query_id long, vec_id long, score double")
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact(rows: DataFrame, questions: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """The true neighbours of a bounded list of queries among (vec_id, v, leaf), by brute force."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            leaf = dict(zip(ids.tolist(), batch.column(2).to_pylist(), strict=True))
            for query_id, query in questions:
                near, away = best(ids, own, query_id, query, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query_id] * len(near), pa.int64()), pa.array(near, pa.int64()),
                        pa.array(away, pa.float64()), pa.array([leaf[i] for i in near.tolist()], pa.int32()),
                    ],
                    names=["query_id", "vec_id", "score", "leaf"],
                )

    found = rows.select("vec_id", "v", "leaf").mapInArrow(work, "query_id long, vec_id long, score double, leaf int")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _calibrated(tree: Tree, indexed: DataFrame, questions: DataFrame, k: int, recall: float) -> int:
    """Leaf visits after which `recall` of the true neighbours of at most CALIBRATION queries are met."""
    some = questions.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    asked = [(r["vec_id"], np.array(r["v"])) for r in some]
    if not asked:
        return 1
    places = {q: {leaf: i + 1 for i, leaf in enumerate(tree.order(v))} for q, v in asked}
    ranks = sorted(places[r["query_id"]][r["leaf"]] for r in exact(indexed, asked, k).select("query_id", "leaf").collect())
    return ranks[min(len(ranks) - 1, int(recall * len(ranks)))] if ranks else 1


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    return search(table(spark, sf_dir, "embeddings"))
