"""Keys that come out the same on every run: ids, plan and price hashes, code buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "\u001f"


def blank(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def surrogate_id(prefix: str, *parts: Column) -> Column:
    """`prefix_` and 24 hex digits drawn from the parts, so a rerun gives the same id."""
    digest = F.sha2(F.concat_ws(UNIT, *[blank(part) for part in parts]), 256)
    return F.concat(F.lit(f"{prefix}_"), F.substring(digest, 1, 24))


def packed(text: Column, digits: int, prefix: str = "") -> Column:
    """The bytes of `prefix` and so many lower-case hexadecimal digits, half as long; any other text behind zeros, as it is."""
    rest = F.substring(text, len(prefix) + 1, 2**31 - 1) if prefix else text
    found = F.unhex(rest)
    whole = F.startswith(text, F.lit(prefix)) & (F.octet_length(found) == digits // 2) & (F.lower(F.hex(found)) == rest)
    return F.when(whole, found).otherwise(F.concat(F.lit(bytes(digits // 2 + 1)), text.cast("binary")))


def unpacked(found: Column, digits: int, prefix: str = "") -> Column:
    """The text that `packed` gave these bytes for."""
    whole = F.octet_length(found) == digits // 2
    other = F.substring(found, digits // 2 + 2, 2**31 - 1).cast("string")
    return F.when(whole, F.concat(F.lit(prefix), F.lower(F.hex(found)))).otherwise(other)


#: Columns that pass exchanges as bytes: their digits and what stands before these.
PACKED = {"procedure_hash": (64, ""), "provider_group_id": (24, "group_")}


def pack(rows: DataFrame) -> DataFrame:
    """Rows with hashes and ids of groups as bytes, for an exchange; in the same order of columns."""
    return rows.select(*[packed(F.col(c), *PACKED[c]).alias(c) if c in PACKED else c for c in rows.columns])


def unpack(rows: DataFrame) -> DataFrame:
    return rows.select(*[unpacked(F.col(c), *PACKED[c]).alias(c) if c in PACKED else c for c in rows.columns])


def group_id(file_id: Column, number: Column) -> Column:
    """Id of a provider group, whose number counts within its file only."""
    return surrogate_id("group", file_id, number)


def member_text(member: Column) -> Column:
    """What makes a member of a provider group the same member: its NPIs, in any order, and its tax id."""
    tax = F.coalesce(member["tins"], member["tin"])
    npi = F.array_sort(F.array_distinct(F.coalesce(member["npi"], F.array().cast("array<bigint>"))))
    return F.to_json(F.struct(npi.alias("npi"), blank(tax["type"]).alias("type"), blank(tax["value"]).alias("value")))


def _halves(text: Column) -> tuple[Column, Column]:
    """The SHA-256 of a member's text as two numbers, which can be added up in any order."""
    digest = F.sha2(text, 256)
    return tuple(F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("bigint") for i in (0, 1))


def content_number(members: Column) -> Column:
    """The number of a group by its distinct members, whatever their order: the same wherever the group stands."""
    texts = F.array_distinct(F.transform(members, member_text))
    zero = F.lit(0).cast("bigint")

    def both(acc: Column, text: Column) -> Column:
        return F.struct(*[acc[n].bitwiseXOR(half).alias(n) for n, half in zip("ab", _halves(text), strict=True)])

    sums = F.aggregate(texts, F.struct(zero.alias("a"), zero.alias("b")), both)
    return F.concat_ws("-", F.lit("members"), F.size(texts).cast("string"), F.hex(sums["a"]), F.hex(sums["b"]))


def content_number_of_rows(text: Column) -> Column:
    """The same as an aggregate over the distinct texts of a group's members, a row each."""
    a, b = _halves(text)
    return F.concat_ws("-", F.lit("members"), F.count(text).cast("string"), F.hex(F.bit_xor(a)), F.hex(F.bit_xor(b)))


def plan_hash(company: Column, plan_id: Column, market: Column, name: Column, id_type: Column) -> Column:
    """One argument order for every caller: company, plan id, market, name, id type."""
    parts = [blank(company), blank(plan_id), blank(market), blank(name), F.upper(blank(id_type))]
    return F.sha2(F.concat_ws("-", *parts), 256)


def price_hash(code_type: Column, code: Column, price: Column) -> Column:
    """Hash of what makes a price the same price; the order inside its arrays does not count.

    Arrays go in as JSON, so that no member can be taken for two. The code's version and the negotiation
    arrangement are no part of it: the rate table has no column for them, so prices that differ in these alone
    are one row there.
    """
    return F.sha2(
        F.concat_ws(
            UNIT,
            blank(code_type),
            blank(code),
            blank(price["negotiated_type"]),
            blank(price["negotiated_rate"]),
            blank(price["expiration_date"]),
            blank(F.to_json(F.sort_array(price["service_code"]))),
            blank(price["billing_class"]),
            blank(price["setting"]),
            blank(F.to_json(F.sort_array(price["billing_code_modifier"]))),
        ),
        256,
    )


def code_bucket(code: Column) -> Column:
    """One of 256 buckets, even over the codes: the first byte of their SHA-256."""
    return F.conv(F.substring(F.sha2(code, 256), 1, 2), 16, 10).cast("int")
