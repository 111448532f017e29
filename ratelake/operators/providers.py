"""Provider references: members, providers, and the join with the rates that name them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.functions.keys import content_number, content_number_of_rows, group_id, member_text, surrogate_id
from ratelake.functions.text import or_empty
from ratelake.sources.shred import place_in


def members(references: DataFrame) -> DataFrame:
    """One row per provider group, member and NPI, with the member's tax id (`tins`, else `tin`)."""
    tax = F.coalesce("group.tins", "group.tin")
    return (
        references.select(
            "file_id",
            "provider_group_id",
            group_id(F.col("file_id"), F.col("provider_group_id")).alias("group_id"),
            or_empty(F.col("network_name")).alias("network_name"),
            place_in(references, "provider_groups", F.lit(0)).alias("first_member"),
            F.posexplode("provider_groups").alias("place", "group"),
        )
        .withColumn("member_no", F.col("first_member") + F.col("place"))
        .select("file_id", "provider_group_id", "group_id", "network_name", "member_no", tax.alias("tax"), F.explode("group.npi").alias("npi"))
        .select(
            "file_id",
            "provider_group_id",
            "group_id",
            "network_name",
            "member_no",
            "npi",
            or_empty(F.col("tax.type")).alias("tax_id_type"),
            or_empty(F.col("tax.value")).alias("tax_id"),
            F.col("tax.business_name").alias("business_name"),
        )
    )


def inline_references(items: DataFrame) -> DataFrame:
    """The groups that rates bring with them as provider references, each once a file: (file_id, number, provider_groups)."""
    rates = items.select("file_id", F.explode("negotiated_rates").alias("rate"))
    members = F.col("rate.provider_groups")
    groups = rates.where(F.size(members) > 0).select("file_id", content_number(members).alias("number"), members.alias("provider_groups"))
    return groups.dropDuplicates(["file_id", "number"])


def identities(references: DataFrame, inline: DataFrame | None = None) -> DataFrame:
    """(group_id, content_id, file_id, number): groups with the same members have one content id, in whatever file and form they stand.

    Members are added up row by row, so a group of any number of them, and one in parts, is never gathered. One
    exchange deals them by group.
    """
    listed = references.select("file_id", F.col("provider_group_id").cast("string").alias("number"), "provider_groups")
    if inline is not None:
        listed = listed.unionByName(inline.select("file_id", "number", "provider_groups"))
    texts = listed.select("file_id", "number", F.explode("provider_groups").alias("member")).select(
        "file_id", "number", member_text(F.col("member")).alias("text")
    )
    return (
        texts.repartition("file_id", "number")
        .distinct()
        .groupBy("file_id", "number")
        .agg(content_number_of_rows(F.col("text")).alias("content"))
        .select(group_id(F.col("file_id"), F.col("number")).alias("group_id"), surrogate_id("group", F.col("content")).alias("content_id"), "file_id", "number")
    )


def bridge(member_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, NPI) and NPIs, each once."""
    pairs = member_rows.select("group_id", "npi").distinct()
    return pairs, pairs.select("npi").distinct()


def join_rates(messages: DataFrame, references: DataFrame) -> DataFrame:
    """Rate messages by the provider reference they name, within the file; unknown references stay, as NULL.

    A rate gets its group's id, name and number of members; the members themselves stay apart, see `members`,
    as a group that very many rates name would be copied onto each of them. A group is one row on its side,
    whether its reference came whole or in parts, so its rates can be split over tasks.
    """
    key = ["file_id", "number"]
    numbered = references.withColumn("number", F.col("provider_group_id").cast("string"))
    groups = numbered.groupBy(*key).agg(
        F.max("network_name").alias("network_name"), F.sum(F.coalesce(F.size("provider_groups"), F.lit(0))).alias("n_members")
    )
    named = messages.select(
        "file_id",
        "item_no",
        "rate_no",
        "procedure",
        "negotiated_prices",
        F.explode("provider_ids").alias("number"),
    )
    return named.join(groups, key, "left").withColumns(
        {"provider_group_id": F.col("number").try_cast("bigint"), "group_id": group_id(F.col("file_id"), F.col("number"))}
    )
