"""In-network items: rate messages, prices, the rate dimension and the provider fact.

An item row is (file_id, item_no, fields of one in_network element). Prices and providers
stay in arrays for as long as possible: the fact is the only table at price × provider grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import session
from ratelake import values as V
from ratelake.functions.keys import blank, content_number, group_id, pack, price_hash, surrogate_id, unpack
from ratelake.functions.text import array_or_empty, encode, encode_services, or_empty, to_date
from ratelake.sources.shred import place_in

PROCEDURE_FIELDS = (
    "negotiation_arrangement",
    "name",
    "billing_code_type",
    "billing_code_type_version",
    "billing_code",
    "description",
)
SEEN = ("first_seen_date", "last_seen_date")
CODED = ("billing_class", "setting")
NUMBERED = ("file_id", "number")
FACT_KEY = ("insurance_plan_id", "billing_code_id", "provider_group_id", "procedure_hash")
CODE_FIELDS = ("billing_code_type", "billing_code_type_version", "billing_code", "description")


def rate_messages(items: DataFrame, *carried: str) -> DataFrame:
    """One message per item and negotiated rate, with the item's `carried` columns; its severity of illness is not passed on.

    `provider_ids` are the provider references of the rate and, where it brings members of its own, the number
    of the group they make, see `keys.content_number`.
    """
    rate = items.schema["negotiated_rates"].dataType.elementType
    named = array_or_empty(F.col("rate.provider_references"), "bigint").cast("array<string>")
    if "provider_groups" in rate.names:
        members = F.col("rate.provider_groups")
        named = F.when(F.coalesce(F.size(members), F.lit(0)) > 0, F.concat(named, F.array(content_number(members)))).otherwise(named)
    procedure = F.struct(*[or_empty(F.col(field)).alias(field) for field in PROCEDURE_FIELDS])
    return items.select(
        "file_id",
        "item_no",
        *carried,
        procedure.alias("procedure"),
        place_in(items, "negotiated_rates", F.lit(0)).alias("first_rate"),
        F.posexplode("negotiated_rates").alias("rate_no", "rate"),
    ).select(
        *carried,
        "file_id",
        "item_no",
        (F.col("first_rate") + F.col("rate_no")).alias("rate_no"),
        "procedure",
        named.alias("provider_ids"),
        F.col("rate.negotiated_prices").alias("negotiated_prices"),
    )


def wire_messages(messages: DataFrame) -> DataFrame:
    """The three published fields; absent values become the defaults of the wire format."""

    def price(p: Column) -> Column:
        extra = p["additional_information"]
        return F.struct(
            or_empty(p["negotiated_type"]).alias("negotiated_type"),
            F.coalesce(p["negotiated_rate"].cast("double"), F.lit(0.0)).alias("negotiated_rate"),
            or_empty(p["expiration_date"]).alias("expiration_date"),
            array_or_empty(p["service_code"], "string").alias("service_code"),
            or_empty(p["billing_class"]).alias("billing_class"),
            or_empty(p["setting"]).alias("setting"),
            array_or_empty(p["billing_code_modifier"], "string").alias("billing_code_modifier"),
            F.when(extra.isNotNull(), F.array(extra))
            .otherwise(F.array().cast("array<string>"))
            .alias("additional_information"),
        )

    return messages.select(
        "procedure", "provider_ids", F.transform("negotiated_prices", price).alias("negotiated_prices")
    )


def _canonical(price: Column) -> Column:
    """A price with its arrays as the hash sees them: NULL is empty, without NULL and empty members, in order."""
    for field in ("service_code", "billing_code_modifier"):
        members = F.filter(array_or_empty(price[field], "string"), lambda x: x.isNotNull() & (x != ""))
        price = price.withField(field, F.sort_array(members))
    return price


def prices(messages: DataFrame, *carried: str) -> DataFrame:
    """One row per negotiated price, providers still in their array, with the `carried` columns.

    Arrays are made canonical first, so prices of one hash have one set of attributes.
    """
    code_type, code = F.col("procedure.billing_code_type"), F.col("procedure.billing_code")
    return (
        messages.select(
            *carried,
            "file_id",
            "item_no",
            code_type.alias("billing_code_type"),
            code.alias("billing_code"),
            "provider_ids",
            F.explode("negotiated_prices").alias("price"),
        )
        .withColumn("price", _canonical(F.col("price")))
        .withColumn("procedure_hash", price_hash(F.col("billing_code_type"), F.col("billing_code"), F.col("price")))
    )


def dimension_rows(priced: DataFrame, seen_date: Column) -> DataFrame:
    """Rows of the rate dimension, one per price, still to be merged.

    All attributes follow from the hash. They are grouping columns of the merge, so its buffers
    hold two dates only and it stays a hash aggregation.
    """
    price = F.col("price")
    return priced.select(
        "procedure_hash",
        price["negotiated_rate"].alias("negotiated_rate"),
        to_date(price["expiration_date"]).alias("expiration_date"),
        "billing_code",
        encode_services(price["service_code"]).alias("service_code"),
        encode(price["billing_class"], V.BILLING_CLASS_CODES).alias("billing_class"),
        encode(price["setting"], V.SETTING_CODES).alias("setting"),
        F.sort_array(array_or_empty(price["billing_code_modifier"], "string")).alias("billing_code_modifier"),
        seen_date.alias("first_seen_date"),
        seen_date.alias("last_seen_date"),
    )


def merge(rows: DataFrame, packed: bool = False) -> DataFrame:
    """Rows of the dimension or the fact, each once, with its first and last seen date.

    An upsert is the merge of the stored table and the new rows in one union: rows are summed up
    before the shuffle, and one exchange carries both sides. A join would need one exchange for
    the sums and one more for each side.

    Encoded words are no part of the key: a price stored before its word had a code is the same price, and
    takes the code. Hashes and ids travel as bytes; rows that are `packed` have them so before and behind. Rows
    that carry NUMBERED and are dealt by file are merged where they lie.
    """
    coded = [column for column in rows.columns if column in CODED]
    key = [column for column in rows.columns if column not in (*SEEN, *CODED)]
    merged = (rows if packed else pack(rows)).groupBy(*key).agg(
        *[F.max(column).alias(column) for column in coded], F.min(SEEN[0]).alias(SEEN[0]), F.max(SEEN[1]).alias(SEEN[1])
    )
    return merged.select(*rows.columns) if packed else unpack(merged.select(*rows.columns))


def unknown_codes(priced: DataFrame) -> DataFrame:
    """Words without a small-int code, counted: they are NULL in the dimension."""
    price = F.col("price")

    def word(field: str, value: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), value.alias("word"))

    words = F.concat(
        F.array(word("billing_class", price["billing_class"]), word("setting", price["setting"])),
        F.transform(array_or_empty(price["service_code"], "string"), lambda code: word("service_code", code)),
    )
    code = (
        F.when(F.col("field") == "setting", encode(F.col("word"), V.SETTING_CODES))
        .when(F.col("field") == "billing_class", encode(F.col("word"), V.BILLING_CLASS_CODES))
        .otherwise(F.col("word").try_cast("tinyint"))
    )
    return (
        priced.select(F.inline(words))
        .where(F.col("word").isNotNull() & code.isNull())
        .groupBy("field", "word")
        .agg(F.count(F.lit(1)).alias("n_prices"))
    )


def fact(priced: DataFrame, plans_of_files: DataFrame, *carried: str, numbered: bool = False) -> DataFrame:
    """The provider fact of some files: one row per price, provider and plan, with its first and last seen date.

    `priced` carries `seen_date`; `plans_of_files` is (file_id, insurance_plan_id), each pair once. Fields of the
    price named in `carried` come along. A group is (file, number) until the rows are merged: the file is then
    part of the key, so where the join deals rows by file, the merge needs no further exchange, and the id is
    made once a row. Hashes travel as bytes. `numbered` rows keep NUMBERED, so that what else is known by file
    and number joins where they lie.
    """
    key = ("insurance_plan_id", "billing_code", "file_id", "number", "hash")
    rows = priced.select(
        "file_id",
        "billing_code",
        F.unhex("procedure_hash").alias("hash"),
        F.explode(F.array_distinct("provider_ids")).alias("number"),
        "seen_date",
        *[F.col("price")[field].alias(field) for field in carried],
    )
    return (
        rows.join(plans_of_files, "file_id")
        .groupBy(*key)
        .agg(F.min("seen_date").alias(SEEN[0]), F.max("seen_date").alias(SEEN[1]), *[F.min(c).alias(c) for c in carried])
        .select(
            "insurance_plan_id",
            F.col("billing_code").alias("billing_code_id"),
            group_id(F.col("file_id"), F.col("number")).alias("provider_group_id"),
            F.lower(F.hex("hash")).alias("procedure_hash"),
            *SEEN,
            *carried,
            *(NUMBERED if numbered else ()),
        )
    )


def _by_number(fact: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """Join what is known by file and number to a fact that carries NUMBERED. No number is one, as in the ids of groups."""
    known = known.withColumnsRenamed({"file_id": "_file", "number": "_number"})
    on = [F.col("file_id") == F.col("_file"), blank(F.col("number")) == blank(F.col("_number"))]
    return fact.join(known, on, how).drop("_file", "_number")


def by_content(fact: DataFrame, identities: DataFrame, *carried: str, staging: str | None = None) -> DataFrame:
    """The fact with one id for equal groups of all files, from `providers.identities`.

    `carried` columns of the identities, which follow from the content, come along. A fact that carries NUMBERED
    joins by it, where its rows lie, and loses it. Rows not merged yet are written to the folder `staging`, if
    given: what dealt them can go before the merge deals them anew.
    """
    columns = [c for c in fact.columns if c not in NUMBERED]
    if {*NUMBERED} <= {*fact.columns}:
        rows = _by_number(fact, identities.select(*NUMBERED, "content_id", *carried), "inner")
    else:
        same = identities.select(F.col("group_id").alias("provider_group_id"), "content_id", *carried)
        rows = fact.join(same, "provider_group_id")
    rows = rows.withColumn("provider_group_id", F.col("content_id")).select(*columns, *carried)
    return merge(session.staged(rows, staging) if staging else rows)


def with_locations(fact: DataFrame, locations: DataFrame) -> DataFrame:
    """Add zip code and region of the provider group, after the merge, when the rows are fewest.

    `locations` is (provider_group_id, zip_code, region_code), each group once. Where both sides carry NUMBERED,
    these join, as rows that are dealt by file need no exchange then; else ids pass it as bytes.
    """
    if {*NUMBERED} <= {*fact.columns} & {*locations.columns}:
        joined = _by_number(fact, locations.select(*NUMBERED, "zip_code", "region_code"), "left")
    else:
        places = locations.select("provider_group_id", "zip_code", "region_code")
        joined = unpack(pack(fact).join(pack(places), "provider_group_id", "left"))
    return joined.select(
        "provider_group_id",
        "zip_code",
        "region_code",
        "insurance_plan_id",
        "billing_code_id",
        "procedure_hash",
        *SEEN,
        *[c for c in fact.columns if c not in (*FACT_KEY, *SEEN)],
    )


def item_codes(items: DataFrame) -> DataFrame:
    """Bundled codes and covered services of the items, one row each."""

    def tagged(column: str, kind: str) -> Column:
        return F.transform(
            F.coalesce(F.col(column), F.array().cast(items.schema[column].dataType)),
            lambda c, i: F.struct(
                F.lit(kind).alias("kind"), place_in(items, column, i).alias("pos"), *[or_empty(c[f]).alias(f) for f in CODE_FIELDS]
            ),
        )

    codes = F.concat(tagged("bundled_codes", "bundled_code"), tagged("covered_services", "covered_service"))
    return items.select(
        "file_id", "item_no", F.col("billing_code").alias("item_billing_code"), F.inline(codes)
    )


def summary_by_code(messages: DataFrame) -> DataFrame:
    """What a code costs: number of prices and their span."""
    rate = F.col("price.negotiated_rate")
    return (
        messages.select(
            F.col("procedure.billing_code_type").alias("billing_code_type"),
            F.col("procedure.billing_code").alias("billing_code"),
            F.explode("negotiated_prices").alias("price"),
        )
        .groupBy("billing_code_type", "billing_code")
        .agg(
            F.count(F.lit(1)).alias("n_prices"),
            F.count(rate).alias("n_rates"),
            F.min(rate).alias("min_rate"),
            F.max(rate).alias("max_rate"),
            F.sum(rate).alias("sum_rate"),
        )
        .withColumn("avg_rate", F.col("sum_rate").cast("double") / F.col("n_rates"))
    )


def procedure_codes(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Code types and codes of the items, each once, with ids that follow from their text."""
    named = items.where(F.col("billing_code").isNotNull())
    types = named.select(F.col("billing_code_type").alias("type")).distinct().select(
        surrogate_id("code_type", F.col("type")).alias("id"), "type"
    )
    codes = (
        named.groupBy("billing_code_type", F.col("billing_code").alias("code"))
        .agg(F.min("description").alias("description"))
        .select(
            surrogate_id("code", F.col("billing_code_type"), F.col("code")).alias("id"),
            "code",
            surrogate_id("code_type", F.col("billing_code_type")).alias("type_id"),
            "description",
        )
    )
    return types, codes
