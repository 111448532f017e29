"""Large JSON documents to one row per element of their top-level arrays.

A landed file is one JSON object with a few very long arrays. Reading it as one row would put
it into one task, so it is cut into byte blocks that tasks read on their own:

1. A block cannot tell whether it begins inside a string, nor how deep. Each block but a
   file's last is summarized for both cases: quotes, change of depth, what was opened where.
2. Windows over these small summaries give every block its true entry state.
3. Each block yields what begins in it, reading on past its end for the last of it. What can begin is an
   element, and a member of an array inside an element: one element larger than a block, with all the rates
   of a code or all the groups of a network, is cut before such members and read by many tasks.

Packed files cannot be entered in the middle; a task streams each of them, and each entry of an archive. A task never holds more than
PART_BYTES of an element and one member. Rows hold text only. `parse` turns it into columns after the rows
are spread over tasks, and gives every part of an element the scalars that stand in any of them.

Nothing is passed over in silence: what stands in a wanted array and is no object becomes a row of its
own, which `parse` marks as bad, and a file that ends too early is a failed file.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ratelake.schemas import HEADER
from ratelake.sources.files import READ_BYTES, UNPACK_ERRORS, by_bytes, is_packed, list_entries, open_entry, open_file, packed
from ratelake.sources.scan import (
    BETWEEN_SECTION, FAILED_SECTION, HEADER_SECTION, NO_SECTION, PART_BYTES, State, chunks_of, cut, lead_before, look_back_from,
    safe_offset, summarize,
)

BLOCK_BYTES = 64 << 20

OPENS = "ARRAY<STRUCT<d: BIGINT, n: BIGINT, name: STRING>>"
SUMMARY = (
    "file_id STRING, block_no BIGINT, quotes BIGINT, "
    f"delta_out BIGINT, opens_out {OPENS}, delta_in BIGINT, opens_in {OPENS}"
)
RAW = "archive STRING, file_id STRING, section STRING, item_no BIGINT, part BIGINT, whole BOOLEAN, text STRING"


def _frames(archive: str, file_id: str, items: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    columns = ["archive", "file_id", "section", "item_no", "part", "whole", "text"]
    rows, size = [], 0
    for *place, text in items:
        rows.append((archive, file_id, *place, text.decode("utf-8", "replace")))
        size += len(text)
        if size > READ_BYTES or len(rows) >= 4096:
            yield pd.DataFrame(rows, columns=columns)
            rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def _entry_states(blocks: DataFrame, block_bytes: int) -> DataFrame:
    """State in which each block but a file's first is entered."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_id, block_no, size in zip(batch["file_id"], batch["block_no"], batch["file_size"]):
                with open_file(file_id) as stream:
                    start = safe_offset(stream, int(block_no) * block_bytes, int(size))
                    end = safe_offset(stream, (int(block_no) + 1) * block_bytes, int(size))
                    stream.seek(start)
                    data = stream.read(end - start)
                    row = summarize(look_back_from(stream, start), data)
                yield pd.DataFrame([{"file_id": file_id, "block_no": block_no, **row}])

    inner = blocks.where((F.col("block_no") + 1) * block_bytes < F.col("file_size"))
    summaries = by_bytes(inner, F.lit(block_bytes), "file_id", "block_no").mapInPandas(run, SUMMARY)
    through = Window.partitionBy("file_id").orderBy("block_no").rowsBetween(Window.unboundedPreceding, 0)

    def opened(depth: int):
        return F.get(F.filter("opens", lambda o: o["d"] == depth - F.col("depth_before")), F.lit(0))

    begins_inside = (F.col("quotes_through") - F.col("quotes")) % 2 == 1
    return (
        summaries.withColumn("quotes_through", F.sum("quotes").over(through))
        .withColumn("delta", F.when(begins_inside, F.col("delta_in")).otherwise(F.col("delta_out")))
        .withColumn("opens", F.when(begins_inside, F.col("opens_in")).otherwise(F.col("opens_out")))
        .withColumn("depth_through", F.sum("delta").over(through))
        .withColumn("depth_before", F.col("depth_through") - F.col("delta"))
        .withColumn("at_one", opened(1))
        .withColumn("at_two", opened(2))
        .withColumn("at_three", opened(3))
        .select(
            "file_id",
            (F.col("block_no") + 1).alias("block_no"),
            (F.col("quotes_through") % 2).cast("int").alias("in_string"),
            F.col("depth_through").cast("int").alias("depth"),
            F.last("at_one.name", ignorenulls=True).over(through).alias("section"),
            F.sum(F.coalesce("at_two.n", F.lit(0))).over(through).alias("next_item"),
            F.last("at_three.name", ignorenulls=True).over(through).alias("inner"),
        )
    )


def shred(
    files: DataFrame, sections: Sequence[str], block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(file_id, section, item_no, part, whole, text) for the elements of the named top-level arrays.

    `files` is (file_id, file_size). `item_no` rises in document order within a file. An element that is not
    `whole` comes in parts, which rise with their place. Section
    HEADER_SECTION asks for the scalar members, see `headers`. Entries of a zip get the id `file!entry`.
    A file that ends too early and an archive that cannot be unpacked give a row of FAILED_SECTION, see
    `failed_files`; items may have come before it. `archive` is the landed file itself.
    """
    wanted = frozenset(sections)
    last = F.greatest(F.ceil(F.col("file_size") / block_bytes) - 1, F.lit(0))
    plain = files.where(~packed())
    blocks = plain.select(
        "file_id", "file_size", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("block_no")
    )
    states = blocks.join(_entry_states(blocks, block_bytes), ["file_id", "block_no"], "left").select(
        "file_id",
        "file_size",
        "block_no",
        F.coalesce("in_string", F.lit(0)).alias("in_string"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("section", F.lit(NO_SECTION)).alias("section"),
        F.coalesce("next_item", F.lit(0)).alias("next_item"),
        F.when((F.col("depth") >= 4) & (F.col("inner") != ""), F.col("inner")).otherwise(NO_SECTION).alias("inner"),
    )

    def of_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                with open_file(row.file_id) as stream:
                    size = int(row.file_size)
                    start = safe_offset(stream, int(row.block_no) * block_bytes, size)
                    end = safe_offset(stream, (int(row.block_no) + 1) * block_bytes, size)
                    lead = lead_before(look_back_from(stream, start), bool(row.in_string)) if row.depth in (1, 3) else b""
                    stream.seek(start)
                    state = State(int(row.in_string), int(row.depth), row.section, int(row.next_item), row.inner, lead, start)
                    items = cut(chunks_of(stream), state, end, wanted, part_bytes, to_end=end == size)
                    yield from _frames(row.file_id, row.file_id, items)

    def failed(reason: str) -> list[tuple]:
        return [(FAILED_SECTION, 0, 0, True, reason.encode())]

    def of_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.error is not None:
                    yield from _frames(row.file_id, row.file_id, failed(row.error))
                    continue
                zipped = not pd.isna(row.entry_no)
                inner = f"{row.file_id}!{row.entry}" if zipped else row.file_id
                try:
                    with open_entry(row.file_id, int(row.entry_no) if zipped else None) as (name, entry):
                        if is_packed(name):
                            items = failed("an archive inside an archive")
                        else:
                            items = cut(chunks_of(entry), State(), float("inf"), wanted, part_bytes, to_end=True)
                        yield from _frames(row.file_id, inner, items)
                except UNPACK_ERRORS as error:
                    yield from _frames(row.file_id, row.file_id, failed(str(error)))

    own = F.least(F.col("file_size"), F.lit(block_bytes))
    entries = list_entries(files.where(packed()))
    return (
        by_bytes(states, own, "file_id", "block_no")
        .mapInPandas(of_blocks, RAW)
        .unionByName(by_bytes(entries, F.col("size"), "file_id", "entry_no").mapInPandas(of_entries, RAW))
    )


def parse(raw: DataFrame, section: str, schema: str) -> DataFrame:
    """Columns of one section. `bad` marks elements with a value that does not fit the schema, and what is no object.

    An element in parts is a row each: numbered by `part` from 0, all with the element's scalars, and each with
    its own members of the arrays; `earlier` tells for each array how many members the parts before have. Its
    parts are bad together. Whole elements are part 0 and pass by without an exchange.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    rows = raw.where(F.col("section").isin(section, section + BETWEEN_SECTION)).withColumn(
        "item", F.from_json("text", f"{schema}, _corrupt STRING", options)
    )
    bad = (F.col("section") != section) | F.col("item._corrupt").isNotNull() | ~F.col("text").startswith("{")
    rows = rows.select("file_id", "item_no", "part", "whole", "item.*", "text", bad.alias("bad")).drop("_corrupt")
    fields = StructType.fromDDL(schema)
    arrays = [f.name for f in fields if isinstance(f.dataType, ArrayType)]
    scalars = [f.name for f in fields if f.name not in arrays]
    shape = ["file_id", "item_no", "part", "earlier", *fields.names, "text", "bad"]
    kind = f"struct<{','.join(f'{name}:bigint' for name in arrays)}>"
    whole = rows.where("whole").withColumns({"part": F.lit(0).cast("bigint"), "earlier": F.lit(None).cast(kind)})

    item = ["file_id", "item_no"]
    parts = rows.where(~F.col("whole"))
    # A part has some megabytes, so an element has few of them.
    in_order = Window.partitionBy(*item).orderBy("part")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)

    def so_far(name: str):
        n = F.when(F.col(name).isNotNull(), F.size(name)).otherwise(0).cast("bigint")
        return F.coalesce(F.sum(n).over(before), F.lit(0)).alias(name)

    shared = parts.groupBy(*item).agg(*[F.max(name).alias(name) for name in [*scalars, "bad"]])
    placed = parts.withColumns(
        {"earlier": F.struct(*[so_far(name) for name in arrays]), "part": (F.row_number().over(in_order) - 1).cast("bigint")}
    )
    return whole.select(*shape).unionByName(placed.drop(*scalars, "bad").join(shared, item).select(*shape))


def place_in(df: DataFrame, array: str, position: Column) -> Column:
    """The place of an array's member in its whole element, from its place in a part."""
    if "earlier" not in df.columns:
        return position
    return (position + F.coalesce(F.col("earlier")[array], F.lit(0))).cast("int")


def land(parsed: DataFrame, folder: str) -> DataFrame:
    """Write parsed elements once, good and bad apart; the text stays only with the bad ones."""
    kept = parsed.withColumn("text", F.when(F.col("bad"), F.col("text")))
    kept.write.mode("overwrite").partitionBy("bad").parquet(folder)
    return parsed.sparkSession.read.schema(kept.schema).parquet(folder)


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("bad")).drop("bad", "text")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where("bad").select("file_id", "item_no", "text")


def failed_files(raw: DataFrame) -> DataFrame:
    """Files that end too early and archives that could not be unpacked, with the reason."""
    return raw.where(F.col("section") == FAILED_SECTION).select(F.col("archive").alias("file_id"), F.col("text").alias("reason"))


def of_whole_files(raw: DataFrame, failed: DataFrame) -> DataFrame:
    """Without the rows of failed files."""
    return raw.join(failed.select(F.col("file_id").alias("archive")), "archive", "left_anti")


def headers(raw: DataFrame) -> DataFrame:
    """Scalar members of each file. Each piece of its header is parsed by itself; where a name comes twice, the greater value stays."""
    members = F.regexp_replace("text", r"^[,\s]+|[,\s]+$", "")
    fields = StructType.fromDDL(HEADER).names
    return (
        raw.where(F.col("section") == HEADER_SECTION)
        .select("file_id", F.from_json(F.concat(F.lit("{"), members, F.lit("}")), HEADER).alias("header"))
        .groupBy("file_id")
        .agg(*[F.max(F.col("header")[name]).alias(name) for name in fields])
    )
