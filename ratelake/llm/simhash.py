"""SimHash near-duplicates by tiled exact comparison.

Each text becomes a 64-bit fingerprint; equal fingerprints are one from there on. The comparison lays
the distinct fingerprints out in tiles by the population counts of their four 16-bit quarters. Two
fingerprints at most r bits apart have quarter counts that differ by r in sum at most, so a pair of tiles
beyond that is skipped, and all other pairs are compared bit by bit with numpy. Nothing is missed.

A tile with many fingerprints is cut into chunks. A pair of chunks does not give all its links but a
forest that joins the same fingerprints, so a large group of near copies stays linear in its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import staged, table, utf8
from ratelake.llm.components import components

RADIUS = 3
SHINGLE = 3
#: Fingerprints in a chunk of a tile, about.
CHUNK = 4096


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half the hashes of the text's shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = raw.lower().split()  # bytes: lowers A-Z only, splits at ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    hashes = np.fromiter(
        (xxh64_intdigest(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(shingle)), strict=False)),
        np.uint64,
        len(words) - shingle + 1,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row: the fingerprint as a signed long. NULL, empty and blank texts have 0."""
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("row"), utf8(F.col("text")).alias("text"))
    return _printed(rows, shingle).select("row.doc_id", "fp")


def _printed(rows: DataFrame, shingle: int) -> DataFrame:
    """(row, fp) for (row, text as bytes): the row passes by as it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(raw.as_py(), shingle) for raw in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["row", "fp"])

    return rows.mapInArrow(work, f"row {rows.schema['row'].dataType.simpleString()}, fp long")


def quarter_counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(4)]


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join the same fingerprints as all links of at most `radius` bits between both sides."""
    keys = np.concatenate([left, right])
    label = np.arange(len(keys))
    met = False
    step = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), step):
        near = np.bitwise_count(left[at : at + step, None] ^ right[None, :]) <= radius
        i, j = np.nonzero(near)
        i += at
        j += len(left)
        differ = keys[i] != keys[j]
        i, j = i[differ], j[differ]
        while len(i):
            met = True
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
            np.minimum.at(label, high, low)
            while (label[label] != label).any():
                label = label[label]
    if not met:
        return keys[:0], keys[:0]
    moved = np.nonzero(label != np.arange(len(keys)))[0]
    return keys[moved], keys[label[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` that join what lies within `radius` bits.

    Reads the table twice: stage it first. The counts by tile are broadcast: a tile is four counts of 0
    to 16, so there are at most 17**4 = 83,521 of them, whatever the data.
    """
    tiled = distinct.withColumn("tile", F.array(*quarter_counts(F.col("fp"))))
    counts = tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    chunks = staged(
        tiled.join(F.broadcast(counts), "tile")
        .groupBy("tile", F.pmod(F.xxhash64("fp"), F.col("chunks")).alias("chunk"))
        .agg(F.array_sort(F.collect_list("fp")).alias("fps")),
        "simhash-tiles",
    )
    span = range(-radius, radius + 1)
    steps = [
        (a, b, c, d) for a in span for b in span for c in span for d in span
        if abs(a) + abs(b) + abs(c) + abs(d) <= radius and (a, b, c, d) >= (0, 0, 0, 0)
    ]
    around = F.array(*[F.array(*[F.lit(x) for x in step]) for step in steps])
    left = chunks.select(
        F.col("tile").alias("_tile"), F.col("chunk").alias("_chunk"), F.col("fps").alias("left"), F.explode(around).alias("_step")
    ).withColumn("tile", F.zip_with("_tile", "_step", lambda x, y: x + y))
    pairs = left.filter(F.forall("tile", lambda x: x.between(0, 16))).join(chunks, "tile")
    pairs = pairs.filter((F.col("tile") != F.col("_tile")) | (F.col("chunk") >= F.col("_chunk")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for one, other in zip(batch.column(0), batch.column(1), strict=True):
                sides = (np.asarray(x.values).view(np.uint64) for x in (one, other))
                found.append(forest(*sides, radius))
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return pairs.select("left", F.col("fps").alias("right")).mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs`; component_id is the least doc_id reachable.

    Rows without words are linked by their fingerprint 0 like any other. Repeated rows stay. A row whose
    doc_id is NULL takes part, but never names its component unless all of its ids are NULL. Other
    columns are not read. Groups of copies are reduced to one row before any exchange.
    """
    printed = staged(fingerprints(docs, shingle), "simhash-prints")
    distinct = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    joined = components(links(distinct.select("fp"), radius), "simhash-components")
    rooted = distinct.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.join(
        rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root"
    ).select(F.col("fp").alias("_fp"), "component_id")
    return printed.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def kept_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group of near-duplicates: the one that names it, once. All columns stay.

    A group is one of like texts, whatever ids its rows have: unlike texts that share an id stay, one of each
    group. The row with the least (id, hashes of the text) names a group. A row without id goes by a hash of its
    text, above all usual ids: it stays if nothing else is like it, and otherwise yields to a document with one.
    NULL, empty and blank texts are one group; repeated rows are one row; no rows give none.
    """
    text = F.coalesce("text", F.lit(""))
    # Two hashes tell texts apart: with one, ten thousand million texts would hold a few pairs that share it.
    hashes = [F.xxhash64(text).alias("hash"), F.xxhash64(F.lit("again"), text).alias("other")]
    unnamed = F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    key = [F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("id"), *hashes]
    printed = _printed(docs.select(F.struct(*key).alias("row"), utf8(F.col("text")).alias("text")), SHINGLE)
    least = staged(printed.groupBy("fp").agg(F.min("row").alias("head")), "simhash-heads")
    joined = components(links(least.select("fp"), radius), "simhash-components")
    heads = (
        least.join(joined, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("head").alias("head"))
        .select("head.*")
    )
    # Rows of one id and text differ in other columns at most; a hash of the row decides.
    rows = docs.select(*key, F.struct("*").alias("row"))
    kept = rows.join(heads, ["id", "hash", "other"], "left_semi").groupBy("id", "hash", "other").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select("row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
