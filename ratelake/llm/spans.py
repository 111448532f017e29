"""Matches of a pattern with their places, in plain SQL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches gathered before they are set aside, so that a text with very many costs no square of them.
FLUSH = 64


def pieces(text: Column, pattern: str, cheap: Column | None = None) -> tuple[Column, Column]:
    """(gaps, hits): what lies between the matches of `pattern`, one more than the matches, and the matches.

    `cheap` says where a match is possible at all; elsewhere both are empty.
    """
    regex = F.lit(pattern)
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, regex, F.lit(0))
    if cheap is None:
        return gaps, hits
    none = F.array().cast("array<string>")
    return F.when(cheap, gaps).otherwise(none), F.when(cheap, hits).otherwise(none)


def placed(gaps: Column, hits: Column, more: dict[str, Column] | None = None) -> Column:
    """Structs (start, end, value) of the hits in code points, end exclusive; and more fields by gap.

    A field of `more` is an array as long as the hits.
    """
    more = more or {}
    rows = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), *[c.alias(n) for n, c in more.items()])
    rows = F.filter(rows, lambda r: r["hit"].isNotNull())
    kind = "array<struct<start:int,end:int,value:string" + "".join(f",{n}:string" for n in more) + ">>"
    none = F.array().cast(kind)

    def add(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.length(row["gap"])
        end = start + F.length(row["hit"])
        fields = [start.alias("start"), end.alias("end"), row["hit"].alias("value"), *[row[n].alias(n) for n in more]]
        now = F.concat(acc["now"], F.array(F.struct(*fields)))
        full = F.size(acc["now"]) >= FLUSH - 1
        return F.struct(
            end.alias("at"),
            F.when(full, none).otherwise(now).alias("now"),
            F.when(full, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"),
        )

    start = F.struct(
        F.lit(0).alias("at"), none.alias("now"), F.array().cast(f"array<{kind}>").alias("done")
    )
    return F.aggregate(rows, start, add, lambda acc: F.concat(F.flatten(acc["done"]), acc["now"]))


def let(value: Column, body) -> Column:
    """`body` of `value`, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def around(text: Column, pattern: str, size: int, cheap: Column | None = None) -> Column:
    """Structs (start, end, value, before, after) of the matches: up to `size` characters to either side.

    They are those of the text at the match's own place, so earlier and later matches are part of them.
    """
    n = F.lit(size)

    def strips(v: Column, cut) -> Column:
        """Gap, match, gap, match and so on, each cut to what can be within `size` characters."""
        pairs = F.arrays_zip(v["gaps"].alias("gap"), v["hits"].alias("hit"))
        return F.flatten(F.transform(pairs, lambda r: F.array(cut(r["gap"]), cut(F.coalesce(r["hit"], F.lit(""))))))

    def before(left: Column, i: Column) -> Column:
        first = F.greatest(F.lit(1), 2 * i + 1 - 2 * size)
        return F.right(F.array_join(F.slice(left, first, 2 * i + 2 - first), ""), n)

    def after(right: Column, i: Column) -> Column:
        return F.left(F.array_join(F.slice(right, 2 * i + 3, F.lit(2 * size + 1)), ""), n)

    def of(v: Column) -> Column:
        more = {
            "before": let(strips(v, lambda s: F.right(s, n)), lambda a: F.transform(v["hits"], lambda _, i: before(a, i))),
            "after": let(strips(v, lambda s: F.left(s, n)), lambda a: F.transform(v["hits"], lambda _, i: after(a, i))),
        }
        return placed(v["gaps"], v["hits"], more)

    gaps, hits = pieces(text, pattern, cheap)
    return let(F.struct(gaps.alias("gaps"), hits.alias("hits")), of)
