"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs, each of which has a 64-bit digest. A sketch has CELLS cells in three parts;
a digest goes into one cell of each part, which holds a count, the exclusive-or of its digests and that of
their checks. This sketch is the fingerprint that is published. Sketches of two texts subtract cell by cell:
what they share is gone, and peeling recovers the digests that differ. The published sketches are tried first.
Where peeling stops short, sketches GROWTH times as large are made, of as many tables of CELLS cells to which the
digests are dealt, and so on up to what holds; only the digests of the tables that stop short go on.

All of it is SQL functions. A text is shuffled once, to meet the text that follows it; after that only
digests are, and a text's digests stay in one partition through each round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged, table
from ratelake.llm.spans import let

#: A published sketch surely holds two differing digests and often up to eight; beyond, two fingerprints alone do not tell how many differ.
PARTS, WIDTH = 3, 4
CELLS = PARTS * WIDTH
#: How much larger a retry is than the try before.
GROWTH = 16
#: A line is a paragraph; a longer one ends at the first end of a sentence behind LONG characters, or, where
#: none comes within LONGEST, behind the word that stands there; a word counts up to LONG characters more.
LONG, LONGEST = 100, 200
PARAGRAPH = rf"(?:[^\n]{{{LONG},{LONGEST}}}?[.!?](?=\s)|[^\n]{{{LONGEST}}}\S{{0,{LONG}}}+|[^\n]++)"
#: Rows of a bucket of ids in which the next document is looked for, and most buckets.
ROWS, BUCKETS = 256, 1 << 16
#: A round's sketch has CELLS * GROWTH ** round cells.
ROUNDS = 8
#: The bits of a check that are published.
HALF = 0xFFFFFFFF
KEY = ["_bucket", "_row"]


def digests(text: Column) -> Column:
    """The distinct digests of a text's paragraphs; white space around one does not count, blank ones neither."""
    trimmed = F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.trim(p))
    return F.array_distinct(F.transform(F.filter(trimmed, lambda p: p != ""), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def _cell(digest: Column, salt: Column, part: int) -> Column:
    """The cell of a digest in a part, 0 to WIDTH - 1. Not by the digest alone: each round deals anew."""
    return F.pmod(F.shiftright(F.xxhash64(digest, salt), 8 * part), F.lit(WIDTH))


def sketch(salt: Column) -> list[Column]:
    """Aggregates over `digest` that make the cells n0, k0, c0, n1 and so on."""
    made = []
    for part in range(PARTS):
        for i in range(WIDTH):
            here = F.col(f"_at{part}") == i
            at = part * WIDTH + i
            made += [
                F.sum(F.when(here, 1).otherwise(0)).alias(f"n{at}"),
                F.bit_xor(F.when(here, F.col("digest")).otherwise(F.lit(0).cast("long"))).alias(f"k{at}"),
                F.bit_xor(F.when(here, F.col("check")).otherwise(F.lit(0).cast("long"))).alias(f"c{at}"),
            ]
    return made


def with_cells(digests_: DataFrame, salt: Column) -> DataFrame:
    """Adds a digest's check and its place in each part."""
    return digests_.withColumns(
        {"check": _check(F.col("digest"))} | {f"_at{p}": _cell(F.col("digest"), salt, p) for p in range(PARTS)}
    )


def subtract(sign: Column) -> list[Column]:
    """Aggregates over two sketches of opposite sign: their difference, as n0, k0, c0 and so on."""
    return [
        made
        for at in range(CELLS)
        for made in (
            F.sum(F.col(f"n{at}") * sign).alias(f"n{at}"),
            F.bit_xor(f"k{at}").alias(f"k{at}"),
            F.bit_xor(f"c{at}").alias(f"c{at}"),
        )
    ]


def peel(salt: Column) -> Column:
    """Peels the difference in n0, k0, c0 and so on."""
    cells = [F.struct(F.col(f"n{i}").alias("n"), F.col(f"k{i}").alias("k"), F.col(f"c{i}").alias("c")) for i in range(CELLS)]
    return _peel(F.array(*cells), salt)


def _peel(cells: Column, salt: Column, bits: int = -1) -> Column:
    """Peels a difference: struct(found: number of digests recovered, left: cells that are not empty).

    A cell with one digest (count 1 or -1, and the check fits) gives it up, and it is taken from its
    cells in all parts. The parts take turns, so no digest is given up twice in a step; PARTS turns
    without a find mean that nothing more comes, and end the work on a table that holds too many; 3 turns for each
    two digests a sketch can hold do.
    `bits` are those of a check that the cells hold.
    """
    cell = "struct<n:bigint,k:bigint,c:bigint>"
    start = F.struct(cells.cast(f"array<{cell}>").alias("cells"), F.lit(0).alias("found"), F.lit(0).alias("idle"))
    turns = F.array(*[F.lit(p) for _ in range(CELLS // 2) for p in range(PARTS)])

    def check(digest: Column) -> Column:
        return _check(digest).bitwiseAND(F.lit(bits).cast("long"))

    def pure(x: Column) -> Column:
        return (F.abs(x["n"]) == 1) & (x["c"] == check(x["k"]))

    def without(cells: Column, x: Column) -> Column:
        spots = F.array(*[_cell(x["k"], salt, p).cast("int") + p * WIDTH for p in range(PARTS)])
        gone = F.struct(spots.alias("spots"), check(x["k"]).alias("check"))

        def taken(y: Column, i: Column, g: Column) -> Column:
            rest = F.struct((y["n"] - x["n"]).alias("n"), y["k"].bitwiseXOR(x["k"]).alias("k"), y["c"].bitwiseXOR(g["check"]).alias("c"))
            return F.when(F.array_contains(g["spots"], i), rest).otherwise(y)

        return let(gone, lambda g: F.transform(cells, lambda y, i: taken(y, i, g)))

    def step(acc: Column, own: Column) -> Column:
        cells = F.aggregate(own, acc["cells"].cast(f"array<{cell}>"), without)
        idle = F.when(F.size(own) > 0, 0).otherwise(acc["idle"] + 1)
        return F.struct(cells.alias("cells"), (acc["found"] + F.size(own)).alias("found"), idle.alias("idle"))

    def turn(acc: Column, part: Column) -> Column:
        own = F.filter(F.slice(acc["cells"], part * WIDTH + 1, F.lit(WIDTH)), pure)
        going = (acc["idle"] < PARTS) & F.exists(acc["cells"], lambda y: y["n"] != 0)
        return F.when(going, let(own, lambda o: step(acc, o))).otherwise(acc)

    return F.aggregate(
        turns,
        start,
        turn,
        lambda acc: F.struct(
            acc["found"].alias("found"),
            F.size(F.filter(acc["cells"], lambda y: (y["n"] != 0) | (y["k"] != 0))).alias("left"),
        ),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next, _bucket, _row): each row with the text that follows in ascending doc_id.

    Behind the last row comes the first. NULL ids come first; equal ids go by a hash of their text. Ids
    are cut at their quantiles into buckets of about ROWS rows, so that uneven ids make even buckets, and one
    row of each crosses to the one before. A row finds its bucket in two steps, among groups of bounds and in one.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = max(2, min(BUCKETS, math.ceil(read.count() / ROWS)))
    cuts = F.lit([i / buckets for i in range(1, buckets)])
    bounds = sorted(set(read.agg(F.percentile_approx("doc_id", cuts, F.lit(10 * buckets))).first()[0] or []))
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col("doc_id")))

    group = below(F.lit([own[0] for own in groups]).cast("array<long>"))
    listed = F.lit(groups).cast("array<array<long>>") if groups else F.array().cast("array<array<long>>")
    numbered = F.when(group == 0, 0).otherwise((group - 1) * step + below(F.get(listed, group - 1)))
    bucketed = read.withColumn("_bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(numbered))
    order = F.struct("doc_id", F.xxhash64("text"), "text")
    inside = Window.partitionBy("_bucket").orderBy("doc_id", F.xxhash64("text"), "text")
    across = Window.orderBy("_bucket")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = bucketed.groupBy("_bucket").agg(F.min(order).alias("_first")).withColumn("_text", F.col("_first.text"))
    after = firsts.select("_bucket", F.coalesce(F.lead("_text").over(across), F.first("_text").over(whole)).alias("_after"))
    return (
        bucketed.withColumn("_row", F.row_number().over(inside))
        .withColumn("_next", F.lead("text").over(inside))
        .join(after, "_bucket")
        .select("doc_id", "text", F.coalesce("_next", "_after").alias("next"), *KEY)
    )


def edited(text: Column, after: Column) -> Column:
    """The text with its last half replaced by the beginning of the one after it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(after, F.lit(1), half))


def _differences(pairs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(_bucket, _row, other, found): how many digests differ, for rows of (KEY, other, ours, theirs).

    `ours` and `theirs` are the arrays of digests of two texts whose published sketches do not peel. Each round
    deals the digests that are left to the tables of a sketch GROWTH times as large as the one before, subtracts
    and peels; the digests of the tables that fail go on.
    """
    keys = [*KEY, "other"]
    done, left = None, pairs
    for number in range(1, rounds + 1):
        salt, tables = F.lit(number), F.lit(GROWTH**number)
        dealt = F.pmod(F.xxhash64("digest", salt, F.lit("dealt")), tables)
        sides = F.array(
            F.struct(F.lit(1).alias("sign"), F.col("ours").alias("digests")),
            F.struct(F.lit(-1).alias("sign"), F.col("theirs").alias("digests")),
        )
        flat = (
            left.repartition(*KEY)
            .select(*keys, F.explode(sides).alias("_side"))
            .select(*keys, "_side.sign", F.explode("_side.digests").alias("digest"))
            .select(*keys, "sign", "digest", dealt.alias("_deal"))
        )
        sketches = with_cells(flat, salt).groupBy(*keys, "_deal", "sign").agg(*sketch(salt))
        peeled = (
            sketches.groupBy(*keys, "_deal").agg(*subtract(F.col("sign"))).select(*keys, "_deal", peel(salt).alias("_peeled"))
        )
        fits = F.col("_peeled.left") == 0
        result = staged(
            peeled.groupBy(*keys).agg(
                F.sum(F.when(fits, F.col("_peeled.found")).otherwise(0)).alias("found"),
                F.collect_list(F.when(~fits, F.col("_deal"))).alias("_failed"),
            ),
            "fingerprint-peeled",
        )
        own = result.select(*keys, "found")
        done = own if done is None else done.unionByName(own)
        failed = result.filter(F.size("_failed") > 0).select(*keys, "_failed")
        if failed.isEmpty():
            break

        def again(side: str) -> Column:
            deal = lambda d: F.pmod(F.xxhash64(d, salt, F.lit("dealt")), tables)  # noqa: E731, B023
            return F.filter(side, lambda d: F.array_contains(F.col("_failed"), deal(d)))

        left = staged(
            left.join(failed, keys)
            .select(*keys, again("ours").alias("ours"), again("theirs").alias("theirs")),
            "fingerprint-left",
        )
    else:
        raise RuntimeError(f"sketches don't peel after {rounds} rounds")
    return done.groupBy(*keys).agg(F.sum("found").alias("found"))


def peeled(one: Column, other: Column) -> Column:
    """struct(found, left) of two published fingerprints: how many paragraphs differ, where no cell is left.

    A published check is half a check, which is enough for a table of so few cells. No digests, no text: "".
    """
    def cells(text: Column) -> Column:
        parts = F.filter(F.split(text, ";"), lambda c: c != "")
        number = lambda c, i: F.conv(F.element_at(F.split(c, "[.]"), i), 16, -10).cast("long")
        read = F.transform(parts, lambda c: F.struct(number(c, 1).alias("n"), number(c, 2).alias("k"), number(c, 3).alias("c")))
        none = F.transform(F.sequence(F.lit(1), F.lit(CELLS)), lambda _: F.struct(*[F.lit(0).cast("long").alias(x) for x in "nkc"]))
        return F.when(F.size(parts) == 0, none).otherwise(read)

    gone = F.zip_with(
        cells(one), cells(other),
        lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")),
    )
    return _peel(gone, F.lit(0), HALF)


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_*.

    fingerprint is the sketch of all a text's digests: of each cell the count, the digests and half the
    checks in hexadecimal. Two fingerprints whose texts differ in a few paragraphs can be subtracted and
    peeled by whoever has them, see `peeled`; beyond, sketches of the texts grow until they hold. Likeness is the share of digests in both texts among those in either, from the
    number that peeling recovers; two texts without digests are alike. Reads doc_id and text; a NULL text
    is empty. A single row follows itself. An empty table gives an empty result.
    """
    cut = with_next(docs)
    prepared = staged(
        cut.withColumn("edited", edited(F.col("text"), F.col("next"))).select(
            "doc_id",
            *KEY,
            F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"),
            digests(F.col("edited")).alias("edited"),
            digests(F.col("next")).alias("next"),
        ),
        "fingerprint-digests",
    )
    salt = F.lit(0)
    sides = ("own", "edited", "next")
    texts = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("digests")) for i, c in enumerate(sides)])
    flat = (
        prepared.repartition(*KEY)
        .select(*KEY, F.explode(texts).alias("_text"))
        .select(*KEY, "_text.side", F.explode("_text.digests").alias("digest"))
    )
    whole = staged(with_cells(flat, salt).groupBy(*KEY, "side").agg(*sketch(salt)), "fingerprint-sketches")
    written = F.concat(
        *[
            F.lower(F.concat(F.hex(F.col(f"n{i}")), F.lit("."), F.hex(f"k{i}"), F.lit("."), F.hex(F.col(f"c{i}").bitwiseAND(F.lit(HALF))), F.lit(";")))
            for i in range(CELLS)
        ]
    )
    printed = whole.filter("side < 2").select(*KEY, "side", written.alias("_print")).groupBy(*KEY).agg(
        *[F.max(F.when(F.col("side") == i, F.col("_print"))).alias(name) for i, name in enumerate(("fingerprint", "edited_fingerprint"))]
    )
    # The published sketches: a text's own against each of the two others.
    signed = F.when(F.col("side") == 0, F.array(*[F.struct(F.lit(c).alias("other"), F.lit(1).alias("sign")) for c in sides[1:]]))
    for i, c in enumerate(sides[1:], 1):
        signed = signed.when(F.col("side") == i, F.array(F.struct(F.lit(c).alias("other"), F.lit(-1).alias("sign"))))
    cells = [c for c in whole.columns if c not in (*KEY, "side")]
    first = staged(
        whole.select(*KEY, F.explode(signed).alias("_s"), *cells)
        .groupBy(*KEY, F.col("_s.other").alias("other"))
        .agg(*subtract(F.col("_s.sign")))
        .select(*KEY, "other", peel(salt).alias("_peeled")),
        "fingerprint-first",
    )
    both = F.array(*[F.struct(F.lit(c).alias("other"), F.col(c).alias("theirs")) for c in sides[1:]])
    pairs = prepared.select(*KEY, F.col("own").alias("ours"), F.explode(both).alias("_pair")).select(*KEY, "ours", "_pair.*")
    stuck = pairs.join(first.filter("_peeled.left > 0").select(*KEY, "other"), [*KEY, "other"], "left_semi")
    found = first.filter("_peeled.left = 0").select(*KEY, "other", "_peeled.found").unionByName(_differences(stuck))
    wide = found.groupBy(*KEY).agg(
        *[F.sum(F.when(F.col("other") == c, F.col("found")).otherwise(0)).alias(f"_{c}") for c in ("edited", "next")]
    )

    def likeness(other: str) -> Column:
        total, differ = F.size("own") + F.size(other), F.coalesce(F.col(f"_{other}"), F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise((total - differ) / (total + differ))

    return (
        prepared.join(printed, KEY, "left")
        .join(wide, KEY, "left")
        .select(
            "doc_id",
            "n_chars",
            "edited_sha256",
            F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
            F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
            likeness("edited").alias("near_edited"),
            likeness("next").alias("near_next"),
        )
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, beside the one of its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))
