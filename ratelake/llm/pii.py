"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Matches of the fixed patterns are the seeds, whatever tokens they cover. Every token with a digit or with a
mark between letters, and every run of tokens of digits and marks, is a candidate. The words beside a seed or
candidate make up its lexical patterns, with its exact shape, with its rough shape, and more words without
one. Patterns and values form a graph that is scored in rounds: a pattern is trusted as far as its values are
known, and a value as far as its best pattern. Values of trusted patterns that no fixed pattern matches are
added. All of it is SQL functions; texts are read once and never shuffled, only candidates are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratelake.llm.common import staged, table
from ratelake.llm.spans import around

KINDS = ("email", "ip", "card", "phone")
#: The patterns as given, written so that no text takes more than linear time: a match begins where a run
#: begins (or where the last match ended), and what can't be given back is possessive.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a match to be possible.
HINTS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}
#: A token with a digit, or with a mark between letters that is neither a hyphen nor an apostrophe.
CANDIDATE = (
    r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
    r"|[^\x20\x09-\x0D]*?\p{L}(?!['\u2019-])[^\x20\x09-\x0D\p{L}]++\p{L}[^\x20\x09-\x0D]*+)"
)
#: Two or more tokens of digits and marks with one blank between them.
RUN = (
    r"(?<![^\x20\x09-\x0D\"'<{,;:\[])[+(]?[0-9][0-9().+/-]*+(?![\p{L}@_=])"
    r"(?:\x20[(]?[0-9][0-9().+/-]*+(?![\p{L}@_=]))++"
)
#: Characters to either side from which the neighbouring words are taken.
BESIDE = 48
MARKS = "\"'(<{,.;:!?)>}]["
#: A pattern counts from so many known values on, and is trusted from this share of known values on.
SUPPORT, CONFIDENCE = 5, 0.8
ROUNDS = 3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        small = "0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{small}(\.{small}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """The matches of one fixed pattern that pass its test, as structs (start, end, value, before, after)."""
    hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(HINTS[kind])
    return F.filter(around(text, PATTERNS[kind], BESIDE, hint), lambda s: _valid(kind, s["value"]))


def _of_kind(spans: Column, kind: int) -> Column:
    fields = ("start", "end", "value", "before", "after")
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), *[s[f].alias(f) for f in fields]))


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def shape(value: Column) -> Column:
    """Runs of letters as a, runs of up to three digits by their length and longer ones as 9."""
    form = F.regexp_replace(value, r"\p{L}+", "a")
    for run, name in (("[0-9]{4,}", "L"), ("[0-9]{3}", "T"), ("[0-9]{2}", "D"), ("[0-9]", "S")):
        form = F.regexp_replace(form, run, name)
    return F.translate(form, "SDTL", "1239")


def rough_shape(value: Column) -> Column:
    """Runs of letters, digits and . _ - that hold a letter as a, other runs of digits as 9."""
    words = F.regexp_replace(value, r"(?<![\p{L}0-9._-])[0-9._-]*+\p{L}[\p{L}0-9._-]*+", "a")
    return F.regexp_replace(words, "[0-9]+", "9")


def _trimmed(s: Column, left: str, right: str) -> Column:
    """A candidate without the marks around it."""
    rest = F.ltrim(s["value"], F.lit(left))
    value = F.rtrim(rest, F.lit(right))
    start = s["start"] + F.length(s["value"]) - F.length(rest)
    return F.struct(
        start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
        s["before"].alias("before"), s["after"].alias("after"),
    )


def candidates(text: Column) -> Column:
    """Tokens, and runs of tokens of digits, without the marks around them: start, end, value, before, after."""
    hint = text.rlike(r"[0-9]|\p{L}(?!['\u2019-])[^\x20\x09-\x0D\p{L}]++\p{L}")
    tokens = F.transform(around(text, CANDIDATE, BESIDE, hint), lambda s: _trimmed(s, MARKS, MARKS))
    runs = F.transform(around(text, RUN, BESIDE, text.rlike(r"[0-9][)./-]*\x20[(]?[0-9]")), lambda s: _trimmed(s, "", "().+/-"))
    return F.filter(F.concat(tokens, runs), lambda s: F.length(s["value"]) >= 6)


def _patterns(c: Column) -> Column:
    """The lexical patterns of a seed or candidate: words beside it, with a shape or more words."""
    plain = {n: F.lower(F.regexp_replace(c[n], r"[\x20\x09-\x0D]+", " ")) for n in ("before", "after")}
    b = F.rtrim(plain["before"], F.lit(MARKS + " "))
    a = F.ltrim(plain["after"], F.lit(MARKS + " "))
    b1, a1 = F.substring_index(b, " ", -1), F.substring_index(a, " ", 1)
    b2, a2 = F.substring_index(b, " ", -2), F.substring_index(a, " ", 2)
    form, rough, bar = shape(c["value"]), rough_shape(c["value"]), F.lit("|")
    all_of = [
        F.concat(F.lit("before|"), b1, bar, form),
        F.concat(F.lit("after|"), a1, bar, form),
        F.when(b1 != "", F.concat(F.lit("before~"), b1, bar, rough)),
        F.when(a1 != "", F.concat(F.lit("after~"), a1, bar, rough)),
        F.when(F.ltrim(b2).contains(" "), F.concat(F.lit("before2|"), b2)),
        F.when(F.rtrim(a2).contains(" "), F.concat(F.lit("after2|"), a2)),
        F.when((b1 != "") & (a1 != ""), F.concat(F.lit("between|"), b1, bar, a1)),
    ]
    return F.array_compact(F.array(*all_of))


def extract(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, candidates) for every row: matches of the fixed patterns, and what else may be one.

    key tells texts apart. Rows of `docs` map one to one; NULL texts are empty. No exchange.
    """
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = read.select(
        "doc_id",
        F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("length")).alias("key"),
        *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS],
        candidates(F.col("text")).alias("candidates"),
    )
    return found.select(
        "doc_id",
        "key",
        F.concat(*[_of_kind(F.col(k), i) for i, k in enumerate(KINDS)]).alias("base"),
        "candidates",
    )


def _graph(found: DataFrame) -> DataFrame:
    """One row per seed and free candidate of a distinct text: key, start, end, value, patterns, seed kind.

    A candidate is free if no fixed pattern matches a part of it.
    """
    one = found.filter((F.size("candidates") > 0) | (F.size("base") > 0)).dropDuplicates(["key"])
    free = F.filter(
        "candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"]))
    )
    unnamed = F.transform(
        free,
        lambda c: F.struct(F.lit(None).cast("int").alias("kind"), *[c[f].alias(f) for f in ("start", "end", "value", "before", "after")]),
    )
    rows = one.select("key", F.explode(F.concat("base", unnamed)).alias("c"))
    return rows.select(
        "key",
        "c.start",
        "c.end",
        F.col("c.value").alias("value"),
        F.col("c.kind").alias("seed"),
        F.col("c.kind").isNull().alias("free"),
        _patterns(F.col("c")).alias("patterns"),
    )


def discover(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(key, added): spans that trusted patterns add to a text, from the rows of `extract`.

    A pattern's score for a kind is the sum of its values' scores over the number of its values plus one;
    a value's score is 1 for a seed, else that of its best trusted pattern. Values are counted once a
    pattern however often they occur. Without candidates the result is empty.
    """
    graph = staged(_graph(found), "pii-graph")
    edges = staged(
        graph.select("value", F.explode("patterns").alias("pattern")).distinct(), "pii-edges"
    )
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("values")).filter(F.col("values") >= support)
    edges = staged(edges.join(sizes, "pattern"), "pii-edges")
    seeds = graph.filter("seed is not null").groupBy("value").agg(F.min("seed").alias("kind")).withColumn("score", F.lit(1.0))
    known = staged(seeds, "pii-known")
    for _ in range(rounds):
        trusted = (
            edges.join(known, "value")
            .groupBy("pattern", "kind", "values")
            .agg(F.sum("score").alias("sum"), F.count(F.lit(1)).alias("hits"))
            .withColumn("trust", F.col("sum") / (F.col("values") + 1))
            .filter((F.col("hits") >= support) & (F.col("trust") >= confidence))
            .select("pattern", "kind", "trust")
        )
        best = (
            edges.join(trusted, "pattern")
            .groupBy("value")
            .agg(F.max(F.struct(F.col("trust"), -F.col("kind"))).alias("best"))
            .select("value", (-F.col("best")["col2"]).cast("int").alias("kind"), F.col("best.trust").alias("score"))
        )
        known = staged(
            known.filter("score = 1").unionByName(best.join(seeds, "value", "left_anti")), "pii-known"
        )
    # Of a run and a token in it, the run is added.
    inside = Window.partitionBy("key").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        graph.filter("free")
        .join(known.select("value", "kind"), "value")
        .withColumn("reach", F.coalesce(F.max("end").over(inside), F.lit(0)))
        .filter(F.col("end") > F.col("reach"))
        .groupBy("key")
        .agg(F.collect_set(F.struct("kind", "start", "end", "value")).alias("added"))
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) for every row of `docs`: spans as arrays of (kind, start, end, value).

    kind counts KINDS from 0. Reads doc_id and text. A NULL or empty text has no spans; equal texts have
    equal spans, and rows repeat as given.
    """
    found = staged(extract(docs), "pii-found")
    added = discover(found).withColumnRenamed("key", "_key")
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    return found.join(added, F.col("key") == F.col("_key"), "left").select(
        "doc_id",
        F.transform("base", lambda b: F.struct(*[b[f].alias(f) for f in ("kind", "start", "end", "value")])).alias("base"),
        F.coalesce("added", none).alias("added"),
    )


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, digest and spans."""
    found = personal_data(table(spark, sf_dir, "documents"))
    counts = [_count(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "added")).alias("spans"),
    )
