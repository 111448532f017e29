"""Alignment of two tokenizers' tokens over the same texts, and how often two tokens meet.

Both tokenizers encode the whole text. The byte offsets where tokens of each end together cut a document
into groups; numpy finds them, their links and their text for many documents at once.

Counts of linked pairs cover all documents. The most frequent pairs, a bounded number, are broadcast to the
pass that sums them up by document; the rest is joined, so nothing is left out.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm.common import most_frequent, slices, staged, table, utf8

#: Most pairs that are broadcast, 13 bytes each.
HEAD = 1 << 20
#: Words a worker keeps, in two generations. Bounds memory, not results.
CACHE = 250_000
#: Links of a group beyond which its repeated pairs are counted at once.
MANY = 256
#: Pairs a task counts before it sends the counts on.
HELD = 1 << 21

#: How a byte-level vocabulary cuts words, fixed by the vocabulary.
WORD = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of the first scripts without the separators that not all patterns take for white space; one of these has two bytes.
PLAIN = bytes(b for b in range(0xC9) if not 0x1C <= b <= 0x1F)
NEXT_LINE = "\x85".encode()
#: White space, and bytes that may be part of it, as blanks: long runs of them are not left out.
BLANKS = bytes(0x20 if b in b"\t\n\v\f\r\x85\xa0\xc2" else b for b in range(256))
LONG = b" " * 1000


#: Words between single blanks.
SINGLE = re.compile("(?<=[^ ]) (?=[^ ])").split


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_of() -> dict[str, int]:
    """The bytes behind the characters of a byte-level vocabulary: printable ones stand for themselves, others for 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Kept(dict):
    """What was worked out lately; a full generation becomes the older one."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def trim(self) -> None:
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key):
        value = self.older.get(key)
        if value is not None:
            self[key] = value
        return value


class ByteTokens:
    """Ids of a byte-level vocabulary as little-endian 16-bit bytes.

    The same merges, as ranks of the entries they make, are applied by a faster library. It is asked where both cut
    a text into words alike for certain: texts of letters and marks of the first scripts. Other texts, whose
    characters their Unicode tables may tell differently, and very long runs of white space go to the vocabulary's own.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        bytes_of, vocabulary = byte_of(), self.tokenizer.get_vocab()
        self.values = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.values[i] = bytes(bytes_of[c] for c in entry)
        self.spaced = np.array([v.startswith(b" ") for v in self.values])
        self.lengths = [len(v) for v in self.values]
        self.size = np.array(self.lengths, np.int64)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(bytes_of[c] for c in entry): i for entry, i in vocabulary.items() if entry not in special}
        self.quick = tiktoken.Encoding("ranks", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        raws = map(str.encode, texts)
        other = [bool(r.translate(None, PLAIN)) or NEXT_LINE in r or LONG in r.translate(BLANKS) for r in raws]
        found = [b"" if o else array("H", self.quick.encode_ordinary(t)).tobytes() for t, o in zip(texts, other, strict=True)]
        others = [i for i, o in enumerate(other) if o]
        for i, e in zip(others, self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False), strict=True):
            found[i] = array("H", e.ids).tobytes()
        return found


class PieceTokens:
    """Ids of a vocabulary of pieces with single bytes to fall back on.

    No piece goes on behind a blank that follows another character, so a text's ids are those of its words in
    turn, each with the blank before it. Words met before are looked up.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.values = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(n)
        ]
        self.apart = not any(b" " in value.lstrip(b" ") for value in self.values)
        self.known = Kept()
        self.spaced = np.array([v.startswith(b" ") for v in self.values])
        self.lengths = [len(v) for v in self.values]
        self.size = np.array(self.lengths, np.int64)

    def words(self, text: str) -> list[str]:
        if "▁" in text or not self.apart:
            return [text]
        return SINGLE(text) if "  " in text or text[:1] == " " or text[-1:] == " " else text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        self.known.trim()
        split = [self.words(t) for t in texts]
        fresh = [w for w in set().union(*split) if self.known[w] is None]
        for word, ids in zip(fresh, self.model.encode(fresh, num_threads=1), strict=True):
            self.known[word] = array("H", ids).tobytes()
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


class Window(NamedTuple):
    """The groups of a text as text, how many, and their links: pairs a << 16 | b ascending as 32-bit bytes, how often each is linked as 64-bit ones."""

    groups: int
    links: int
    text: bytes
    pairs: bytes
    times: bytes


def same(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the values that two ascending arrays have in common."""
    at = np.minimum(np.searchsorted(b, a), max(len(b) - 1, 0))
    hit = b[at] == a if len(b) else np.zeros(len(a), bool)
    return np.flatnonzero(hit), at[hit]


def steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on, up to each count in turn."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Aligner:
    def __init__(self, first: str, second: str):
        self.first, self.second = ByteTokens(first), PieceTokens(second)
        # Ids as decimal digits, filled up with zero bytes; the last of the eight is for what stands behind.
        self.digits = np.array([b"%d" % i for i in range(1 << 16)], "S8").view("<u8")
        self.width = np.char.str_len(self.digits.view("S8")).astype(np.int64) + 1

    def windows(self, one: bytes, two: bytes, counts: list[int] | None = None, others: list[int] | None = None) -> list[Window]:
        """The groups of texts whose ids follow one another, as many of each side as `counts` and `others` say, else one text.

        Both sides of a text have the same bytes, so its last group ends with it.
        """
        a, b = np.frombuffer(one, "<u2"), np.frombuffer(two, "<u2")
        n_a, n_b = np.array(counts or [len(a)]), np.array(others or [len(b)])
        at, bt = same(np.cumsum(self.first.size[a]), np.cumsum(self.second.size[b]))
        from_a, from_b = np.concatenate([[0], at[:-1] + 1]), np.concatenate([[0], bt[:-1] + 1])
        own, their = at + 1 - from_a, bt + 1 - from_b
        links = own * their
        last = np.searchsorted(at, np.cumsum(n_a) - 1) + 1
        first = np.concatenate([[0], last[:-1]])
        # The ids of a group stand one side behind the other.
        place_a = np.arange(len(a)) + np.repeat(from_b, own)
        place_b = np.arange(len(b)) + np.repeat(from_a + own, their)
        ids, behind = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint64)
        ids[place_a], ids[place_b] = a, b
        behind[place_a[at]], behind[place_b[bt]] = ord("|"), ord(";")
        text = (self.digits[ids] | behind << np.uint64(56)).tobytes().translate(None, b"\0")
        stops = np.cumsum(np.add.reduceat(self.width[ids], np.concatenate([[0], np.cumsum(n_a + n_b)[:-1]]))).tolist()
        keys, times = self.linked(a, b, from_a, from_b, own, their, np.repeat(np.arange(len(n_a)), last - first))
        cuts = np.searchsorted(keys, np.arange(len(n_a) + 1) << 32).tolist()
        pairs = (keys & 0xFFFFFFFF).astype("<u4")
        return [
            Window(n, k, text[p : q - 1], pairs[r:s].tobytes(), times[r:s].tobytes())
            for n, k, p, q, r, s in zip(
                (last - first).tolist(), np.add.reduceat(links, first).tolist(), [0, *stops], stops, cuts, cuts[1:], strict=False
            )
        ]

    def linked(self, a: np.ndarray, b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray, own: np.ndarray, their: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The linked pairs of groups, text << 32 | a << 16 | b ascending, and how often each is linked."""
        links = own * their
        single, several = np.flatnonzero(links == 1), np.flatnonzero((links > 1) & (links <= MANY))
        k, group = steps(links[several]), np.repeat(several, links[several])
        left = np.concatenate([from_a[single], from_a[group] + k // their[group]])
        right = np.concatenate([from_b[single], from_b[group] + k % their[group]])
        near = text[np.concatenate([single, group])]
        keys, times = np.unique(near << 32 | a[left].astype(np.int64) << 16 | b[right], return_counts=True)
        # Repeated ids of a long group are counted, not paired one by one.
        more, often = [keys], [times]
        for g in np.flatnonzero(links > MANY).tolist():
            x, n = np.unique(a[from_a[g] : from_a[g] + own[g]], return_counts=True)
            y, m = np.unique(b[from_b[g] : from_b[g] + their[g]], return_counts=True)
            more.append((text[g] << 32 | x.astype(np.int64)[:, None] << 16 | y).ravel())
            often.append((n[:, None] * m).ravel())
        if len(more) > 1:
            keys, place = np.unique(np.concatenate(more), return_inverse=True)
            times = np.bincount(place, np.concatenate(often)).astype(np.int64)
        return keys, times.astype("<i8")

    def align(self, raws: list[bytes]) -> Iterator[tuple | None]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text, None without tokens."""
        texts = [raw.decode("utf-8", "replace") for raw in raws]
        ones, twos = self.first.encode([" " + t for t in texts]), self.second.encode(texts)
        # A vocabulary of bytes gives back the text it was given; the text is `raw` if the other side says so.
        kept = [
            i for i, (raw, two) in enumerate(zip(raws, twos, strict=True))
            if raw and b"".join(map(self.second.values.__getitem__, memoryview(two).cast("H").tolist())) == b" " + raw
        ]
        counts, others = [len(ones[i]) // 2 for i in kept], [len(twos[i]) // 2 for i in kept]
        found = self.windows(b"".join(ones[i] for i in kept), b"".join(twos[i] for i in kept), counts, others) if kept else []
        rows: list[tuple | None] = [None] * len(raws)
        for i, n_a, n_b, window in zip(kept, counts, others, found, strict=True):
            rows[i] = (n_a, n_b, *window)
        yield from rows


@cache
def aligner(first: str, second: str) -> Aligner:
    """One for all tasks of a worker process."""
    return Aligner(first, second)


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, first: str, second: str, with_groups: bool = False) -> DataFrame:
    """Each row's numbers of tokens, groups and links, its linked pairs and how often; `with_groups` adds the groups as text.

    A group is written a1,a2|b1,b2; groups are joined by a semicolon. Pairs are a << 16 | b, ascending, as
    little-endian 32-bit bytes, and their times as 64-bit ones.
    """
    fields = DOCUMENT + ", groups string" * with_groups

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(first, second)
        for batch in batches:
            for part in slices(batch, 1):
                rows = []
                found = own.align(part.column(1).to_pylist())
                for doc_id, row in zip(part.column(0).to_pylist(), found, strict=True):
                    n_a, n_b, n_groups, n_links, groups, pairs, times = row or (0, 0, 0, 0, b"", b"", b"")
                    digest = hashlib.sha256(groups).hexdigest() if row else ""
                    rows.append((doc_id, n_a, n_b, n_groups, n_links, digest, pairs, times, groups))
                kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()] + [pa.string()] * with_groups
                names = [f.split()[0] for f in fields.split(", ")]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("text"))
    return read.mapInArrow(work, fields)


def pair_counts(documents: DataFrame) -> DataFrame:
    """(pair, n, best): in how many rows a pair is linked, and whether no pair of its first id has more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, 0, 4 << 20):
                own = [np.frombuffer(raw, "<u4") for raw in part.column(0).to_pylist()]
                held, place = np.unique(np.concatenate([held, *own]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([counts, np.ones(len(place) - len(counts))])).astype(np.int64)
                if len(held) > HELD:
                    yield sent(held, counts)
                    held, counts = held[:0], counts[:0]
        yield sent(held, counts)

    def sent(held: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["pair", "n"])

    counts = staged(
        documents.select("pairs").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")),
        "alignment-pairs",
    )
    # At most as many rows as the first vocabulary has ids, so it may be broadcast.
    most = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("n").alias("most"))
    joined = counts.join(F.broadcast(most), F.shiftright("pair", 16) == F.col("a"))
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def summed(documents: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """Adds n_best and count_sum to rows with `row`, `pairs` and `times`; these three go.

    The most frequent pairs, at most `head`, are broadcast; the pairs of a row that are not among them
    are joined with all the others.
    """
    often = most_frequent(counts, head)
    known = often.toArrow()
    order = np.argsort(known["pair"].to_numpy())
    sent = documents.sparkSession.sparkContext.broadcast(
        (known["pair"].to_numpy()[order].astype(np.uint32), known["n"].to_numpy()[order], known["best"].to_numpy(zero_copy_only=False)[order])
    )
    least = int(sent.value[1].min()) if len(order) else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_pairs, n, best = sent.value
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                best_of, sums, rest, rest_times = [], [], [], []
                for raw, raw_times in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    pairs, times = np.frombuffer(raw, "<u4"), np.frombuffer(raw_times, "<i8")
                    at, place = same(pairs, head_pairs)
                    sums.append(int((times[at] * n[place]).sum()))
                    best_of.append(int(times[at][best[place]].sum()))
                    tail = np.ones(len(pairs), bool)
                    tail[at] = False
                    rest.append(pairs[tail].astype(np.int64))
                    rest_times.append(times[tail])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(best_of, pa.int64()), pa.array(sums, pa.int64()),
                        pa.array(rest, pa.list_(pa.int64())), pa.array(rest_times, pa.list_(pa.int64())),
                    ],
                    names=["row", "n_best", "count_sum", "rest", "rest_times"],
                )

    kept = [c for c in documents.columns if c not in ("row", "pairs", "times")]
    rows = documents.select(F.struct("row", *kept).alias("row"), "pairs", "times")
    kind = rows.schema["row"].dataType.simpleString()
    done = staged(
        rows.mapInArrow(work, f"row {kind}, n_best long, count_sum long, rest array<long>, rest_times array<long>").select(
            "row.*", "n_best", "count_sum", "rest", "rest_times"
        ),
        "alignment-sums",
    )
    others = counts if least is None else counts.filter(F.col("n") < least)
    left = (
        done.filter(F.size("rest") > 0)
        .select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("link"))
        .select(F.col("row").alias("_row"), F.col("link.rest").alias("pair"), F.col("link.rest_times").alias("times"))
        .join(others, "pair")
        .groupBy("_row")
        .agg(F.sum(F.col("times") * F.col("n")).alias("_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"))
    )
    return done.join(left, F.col("row") == F.col("_row"), "left").select(
        *kept,
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def alignment(docs: DataFrame, first: str | None = None, second: str | None = None, head: int = HEAD) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row of `docs`.

    Only doc_id and text are read. A NULL or empty text, and one whose tokens do not give back its bytes,
    has no tokens: zeros and an empty digest. Every row counts as a document of its own, repeated rows and
    rows without an id too. Very long texts are encoded whole; a group without a shared end inside is as
    long as the tokenizers make it. Equal counts of an id's pairs are all its best.
    """
    own = paths()
    documents = staged(
        aligned(docs, first or own[0], second or own[1]).withColumn("row", F.monotonically_increasing_id()), "alignment-documents"
    )
    return summed(documents, staged(pair_counts(documents), "alignment-counts"), head)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links between both tokenizers."""
    return alignment(table(spark, sf_dir, "documents"))
