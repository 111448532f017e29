"""Packing documents into sequences: shortest-pack-first over the histogram of lengths.

Tokenizing is the only work on texts. The plan of the packing needs nothing but the histogram of piece
lengths, at most as many numbers as a sequence has tokens, whatever the number of documents. Lengths are
placed longest first; a plan is a list of packing patterns with counts. Patterns join back to the pieces
by (length, rank): the r-th piece of a length takes the r-th place the plan has for it. Ranks come from
buckets and offsets, so a length that a third of all pieces share is no single group.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.alignment import byte_of
from ratelake.llm.common import staged, table, utf8

TOKENS = 4096
END = 2
#: Word chunks whose ids a generation keeps, two at a time. Bounds memory, not results.
CACHE = 400_000
#: Chunks between blanks: lower-case letters that stay as they are, then marks, two words to the tokenizer; or any other.
PARTS = re.compile("([a-zß-öø-ÿ]+)([.,;:!?]*)(?: |\\Z)|([^ ]+)").findall
#: Longest word of letters that the faster library gets.
LONGEST = 256
#: Buckets of equal lengths for ranks.
BUCKETS = 1024

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def ranked(model: dict):
    """The vocabulary's merges as ranks of the entries they make, for a faster library, and the ids of the ranks.

    A blank behind a word stands for the mark of its end, which a last byte takes up before all merges.
    """
    import tiktoken

    bytes_of = byte_of()
    raw = lambda entry: bytes(bytes_of[c] for c in entry.removesuffix("</w>")) + b" " * entry.endswith("</w>")
    ids = {raw(entry): i for entry, i in model["vocab"].items()}
    merged = [raw("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    ends = [entry for entry in ids if len(entry) == 2 and entry.endswith(b" ")]
    order = list(dict.fromkeys([*ends, *merged, *ids, *[bytes([b]) for b in range(256)]]))
    quick = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks={entry: i for i, entry in enumerate(order)}, special_tokens={})
    return quick, np.array([ids.get(entry, -1) for entry in order], "<i4")


class ChunkIds(dict):
    """The ids of the chunks of a text between ASCII white space, as little-endian 32-bit bytes.

    No token of this vocabulary spans white space, so a text's ids are those of its chunks in turn. Chunks
    not met before are encoded many at a time. Lower-case letters and marks behind them are words of their own
    to the tokenizer, so such a chunk needs no more than its letters, which many chunks share; a faster library
    applies the same merges to these. Two generations are kept: what was used lately outlives a full one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.quick, self.quick_ids = ranked(json.loads(self.tokenizer.to_str())["model"])
        self.older: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        # Lower case is what the vocabulary has; a capital sigma and special tokens depend on their case.
        if "Σ" not in text and "<|" not in text:
            text = text.lower()
        for space in "\t\n\v\f\r":
            text = text.replace(space, " ")
        return text.split(" ")

    def new(self, chunks: set[str]) -> set[str]:
        """What is not known yet; chunks of the older generation are taken over."""
        fresh = chunks.difference(self)
        again = {chunk: self.older[chunk] for chunk in fresh if chunk in self.older}
        self.update(again)
        return fresh.difference(again)

    def learn(self, chunks: set[str]) -> None:
        self[""] = b""
        split = PARTS(" ".join(self.new(chunks)))
        letters = self.new({word for word, _, _ in split})
        long = {word for word in letters if len(word) > LONGEST}
        words = list(letters - long)
        for at in range(0, len(words), 1024):
            self._learn_words(words[at : at + 1024])
        rest = [*long, *self.new({marks or other for _, marks, other in split})]
        for at in range(0, len(rest), 256):
            self._learn_any(rest[at : at + 256])
        self.update({word + marks: self[word] + self[marks] for word, marks, _ in split if marks})

    def _learn_words(self, words: list[str]) -> None:
        """Words of letters: each ends with the only token of its own that ends a word."""
        ids = self.quick_ids[self.quick.encode_ordinary(" ".join(words) + " ")]
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        raw = ids.tobytes()
        for word, start, stop in zip(words, [0, *stops], stops, strict=False):
            self[word] = raw[start:stop]
        if len(stops) != len(words):
            raise ValueError("a word of letters has more than one end")

    def _learn_any(self, chunks: list[str]) -> None:
        encoded = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        ids: list[list[int]] = [[] for _ in chunks]
        starts, place = [], 0
        for chunk in chunks:
            starts.append(place)
            place += len(chunk) + 1
        starts.append(place)
        k = 0
        for token, (start, _) in zip(encoded.ids, encoded.offsets, strict=True):
            while start >= starts[k + 1]:
                k += 1
            ids[k].append(token)
        for chunk, own in zip(chunks, ids, strict=True):
            self[chunk] = b"".join(i.to_bytes(4, "little") for i in own)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks(text) for text in texts]
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()
        self.learn(set().union(*split))
        return [b"".join(map(self.__getitem__, chunks)) for chunks in split]


@cache
def chunk_ids(path: str) -> ChunkIds:
    """One for all tasks of a worker process, so that later tasks need not learn the same words."""
    return ChunkIds(path)


def pieces(docs: DataFrame, path: str | None = None, end: int = END, tokens: int = TOKENS, with_ids: bool = False) -> DataFrame:
    """Every document as pieces of at most `tokens` ids: doc_id, start, length, ids_crc32, doc_tokens.

    A document is its ids and the id `end`; a NULL or empty text is that id alone. Only doc_id and text
    are read. `with_ids` adds the ids, as little-endian 32-bit bytes. Repeated rows give repeated pieces; nothing
    here depends on an order, so there are no ties. Very long texts are encoded whole.
    """
    path = path or tokenizer_path()
    last = end.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = chunk_ids(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [raw.decode("utf-8", "replace") for raw in part.column(1).to_pylist()]
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), known.encode(texts), strict=True):
                    ids += last
                    for start in range(0, len(ids), 4 * tokens):
                        own = ids[start : start + 4 * tokens]
                        rows.append((doc_id, start // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4, own))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: len(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names
                )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    return read.mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def plan(histogram: dict[int, int], tokens: int = TOKENS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Packing patterns as (count, [(length, offset, times)]), by shortest pack first.

    Lengths go longest first. Pieces of a length go to the packs with most room left, all packs of a
    pattern at once; a pattern is split where fewer pieces are left. Without a fitting pack new ones
    are opened, each with as many of the length as fit.
    """
    packs: dict[int, list[tuple[int, list]]] = {}
    rooms: list[int] = []

    def put(room: int, count: int, runs: list) -> None:
        if room not in packs:
            packs[room] = []
            insort(rooms, room)
        packs[room].append((count, runs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                times = min(tokens // length, left)
                count = left // times
                put(tokens - times * length, count, [(length, 0, times)])
                left -= count * times
                continue
            room = rooms[-1]
            count, runs = packs[room].pop()
            if not packs[room]:
                del packs[room]
                rooms.pop(bisect_left(rooms, room))
            used = min(count, left)
            times = min(room // length, left // used)
            if used < count:
                put(room, count - used, runs)
            put(room - times * length, used, [*runs, (length, tokens - room, times)])
            left -= used * times
    return [pack for room in sorted(packs) for pack in packs[room]]


def places(patterns: list[tuple[int, list[tuple[int, int, int]]]]) -> list[tuple[int, list[tuple]]]:
    """By length: (first rank, first sequence, offset, times) of each run of places, ranks ascending."""
    by_length: dict[int, list[tuple]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for count, runs in patterns:
        for length, offset, times in runs:
            first = ranks.get(length, 0)
            by_length.setdefault(length, []).append((first, sequence, offset, times))
            ranks[length] = first + count * times
        sequence += count
    return sorted(by_length.items())


def packed(cut: DataFrame, tokens: int = TOKENS) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` of 1 to `tokens`; other columns stay.

    Equal pieces may swap places, which changes no row of the result; an empty table stays empty.
    The histogram, at most `tokens` numbers, is planned on the driver; the table of places is broadcast,
    as its rows are at most `tokens` and do not grow with the pieces.
    """
    spark = cut.sparkSession
    counted = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(BUCKETS)))
    groups = staged(counted.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.createDataFrame(
        places(plan(histogram, tokens)),
        "_length long, _slots array<struct<first: long, sequence: long, offset: long, times: long>>",
    )
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    place = F.col("_rank") - F.col("_slot.first")
    return (
        counted.withColumn("_at", F.row_number().over(inside))
        .join(offsets, ["length", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_at") - 1)
        .join(F.broadcast(slots), F.col("length") == F.col("_length"))
        .withColumn("_slot", F.element_at(F.filter("_slots", lambda s: s["first"] <= F.col("_rank")), -1))
        .select(
            *cut.columns,
            (F.col("_slot.sequence") + F.floor(place / F.col("_slot.times"))).alias("sequence_id"),
            (F.col("_slot.offset") + place % F.col("_slot.times") * F.col("length")).alias("offset"),
        )
    )


def packed_documents(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places; `with_ids` keeps their ids beside them.

    A NULL or empty text is a piece of one id. Repeated rows are packed each for itself; pieces of one length tie,
    and go to the places of that length by id and content. No rows give none.
    """
    return packed(staged(pieces(docs, with_ids=with_ids), "pack-pieces"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and where they go."""
    return packed_documents(table(spark, sf_dir, "documents"))
