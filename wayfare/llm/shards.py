"""Shards by fixed virtual slots, near equal in bytes.  DataFrame functions only.

Every record hashes into one of ``SLOTS`` virtual slots, a number that no
rebalancing changes.  Bytes are added up per slot, and a slot map gives each
slot to a shard: largest slots first, each to the shard with the fewest bytes
so far.  The map is a small table, stored in numbered versions; rebalancing
edits it, moving as few bytes as the new sizes ask for.

A record is its id, size and text checksum, so equal texts with unlike ids
spread over the slots.  A slot that one record repeated many times makes too
heavy (more than ``1 / PIECES`` of a shard) is given out in parts: its rows are
numbered and dealt to the parts in turn, each part being placed like a slot.

Rows are numbered without a window over a group: they are sorted by slot over
range partitions, which split a hot slot, written with
``monotonically_increasing_id`` and corrected by the counts of each slot in
each partition.  The map has at most ``slots + PIECES * shards`` rows, however
many rows are placed.

A null id hashes as an empty one, a null text has no bytes.  Rows that repeat
id, size and checksum are told apart by their number only.  An empty table
gives an empty map and no rows.  Added columns replace columns of the same
name; others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wayfare.llm.anchors import written

SLOTS = 8192
#: Parts of a shard's bytes that no slot part should exceed.
PIECES = 32
#: Bytes that a record costs besides its text.
RECORD_BYTES = 8

MAP = ["virtual_slot", "part", "parts", "n_rows", "bytes", "shard"]


def measured(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Documents with ``size`` and ``text_crc32``."""
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit("").cast("binary"))
    return docs.withColumns({"size": (F.octet_length(raw) + RECORD_BYTES).cast("long"), "text_crc32": F.crc32(raw)})


def record_digest(key: str, size: str, checksum: str) -> Column:
    parts = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (key, size, checksum))
    return F.md5(F.concat_ws(":", *parts))


def virtual_slot(digest: Column, slots: int) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")


def numbered(rows: DataFrame, *, key: str, size: str, checksum: str, slots: int = SLOTS) -> DataFrame:
    """The rows as ``_row`` with ``_size``, ``_slot`` and ``_seat``, gapless from 0 in every slot."""
    digest = record_digest(key, size, checksum)
    packed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("_row"), F.col(f"`{size}`").alias("_size"), digest.alias("_digest"),
        virtual_slot(digest, slots).alias("_slot"), F.xxhash64(F.monotonically_increasing_id()).alias("_spread"),
    )
    order = ["_slot", "_digest", "_spread"]
    ordered = packed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ordered.select("_row", "_size", "_slot", F.monotonically_increasing_id().alias("_at")), "slots")
    placed = placed.withColumn("_block", F.shiftright("_at", 33))
    blocks = placed.groupBy("_slot", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_slot").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_slot", "_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    seated = placed.join(offsets, ["_slot", "_block"])
    return seated.select("_row", "_size", "_slot", (F.col("_at") + F.col("_shift")).alias("_seat"))


def _with_parts(seats: DataFrame, shards: int) -> DataFrame:
    """Seats with ``_parts``, the parts that the row's slot is given out in."""
    loads = seats.groupBy("_slot").agg(F.count("*").alias("_n"), F.sum("_size").alias("_bytes"))
    fair = F.sum("_bytes").over(Window.partitionBy()) / (shards * PIECES)  # over one row a slot
    parts = F.least(F.col("_n"), F.ceil(F.col("_bytes") / fair)).cast("int")
    return seats.join(F.broadcast(loads.select("_slot", parts.alias("_parts"))), "_slot")  # a row a slot: bounded


def units(seats: DataFrame) -> DataFrame:
    """Rows and bytes of every slot part that has rows; ``seats`` have ``_parts``."""
    part = F.pmod(F.col("_seat"), F.col("_parts")).cast("int")
    return seats.groupBy(F.col("_slot").alias("virtual_slot"), part.alias("part")).agg(
        F.first("_parts").alias("parts"), F.count("*").alias("n_rows"), F.sum("_size").alias("bytes"))


def _dealt(loose: DataFrame, loads: Column) -> DataFrame:
    """A shard for each unit: the largest first, each to the shard with the fewest bytes; ``loads`` are there already.

    One row holds all units: a slot map is bounded by the number of slots.
    """
    fields = ["bytes", *(c for c in MAP if c not in ("bytes", "shard"))]
    gathered = loose.groupBy().agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("_less"), *fields))).alias("units"))

    def give(state: Column, unit: Column) -> Column:
        def to(least: Column) -> Column:
            added = F.transform(state["loads"], lambda x, i: F.when(i == least, x + unit["bytes"]).otherwise(x))
            return F.struct(added.alias("loads"), F.concat(state["shards"], F.array(least)).alias("shards"))

        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        return F.transform(F.array(least), to)[0]  # names the least filled shard once, not for every element

    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("shards"))
    found = gathered.select("units", F.aggregate("units", start, give)["shards"].alias("shards"))
    pairs = found.select(F.explode(F.arrays_zip("units", "shards")).alias("unit"))
    return pairs.select(*(F.col(f"unit.units.{c}").alias(c) for c in MAP[:-1]), F.col("unit.shards").alias("shard"))


def slot_map(sizes: DataFrame, shards: int) -> DataFrame:
    """A first map: which shard has which slot part."""
    return _dealt(sizes, F.array_repeat(F.lit(0).cast("long"), shards))


def rebalanced(known: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The map edited for new sizes or another number of shards.

    A slot part stays where it was unless its shard is gone or holds more than
    its share without it: of each shard the parts that fit in come first,
    largest first.  The others, and parts the map doesn't know, are dealt anew.
    """
    fair = F.ceil(F.sum("bytes").over(Window.partitionBy()) / shards)
    there = sizes.join(F.broadcast(known.select("virtual_slot", "part", "shard")), ["virtual_slot", "part"], "left")
    filled = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot", "part"))
    there = there.select(*MAP, fair.alias("_fair"), filled.alias("_filled"))
    stays = (F.col("shard") < shards) & (F.col("_filled") <= F.col("_fair"))
    there = written(there.withColumn("_stays", F.coalesce(stays, F.lit(False))), "slot-map")
    held = {r["shard"]: r["bytes"] for r in there.where("_stays").groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    moved = _dealt(there.where("not _stays"), F.array(*(F.lit(held.get(i, 0)).cast("long") for i in range(shards))))
    return there.where("_stays").select(*MAP).unionByName(moved)


def placed(seats: DataFrame, slots: DataFrame) -> DataFrame:
    """Rows with ``virtual_slot``, ``shard`` and ``slot``, their gapless place in the shard."""
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = slots.select(
        F.col("virtual_slot").alias("_slot"), F.col("part").alias("_part"), "shard",
        F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_start"))
    seats = seats.withColumn("_part", F.pmod(F.col("_seat"), F.col("_parts")).cast("int"))
    found = seats.join(F.broadcast(starts), ["_slot", "_part"])  # the map: bounded
    place = F.col("_start") + F.floor(F.col("_seat") / F.col("_parts"))
    names = seats.schema["_row"].dataType.names
    own = [F.col("_row")[c].alias(c) for c in names if c not in ("virtual_slot", "shard", "slot")]
    return found.select(*own, F.col("_slot").alias("virtual_slot"), "shard", place.cast("long").alias("slot"))


def assign(
    rows: DataFrame, shards: int, *, key: str = "doc_id", size: str = "size", checksum: str = "text_crc32",
    slots: int = SLOTS, known: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their place, and the slot map that gives it; a ``known`` map is edited, else one is made."""
    seats = _with_parts(numbered(rows, key=key, size=size, checksum=checksum, slots=slots), shards)
    sizes = written(units(seats), "slot-sizes")
    made = written(slot_map(sizes, shards) if known is None else rebalanced(known, sizes, shards), "slot-map")
    return placed(seats, made), made


def save_map(slots: DataFrame, path: str, version: int) -> None:
    """Keep a map as a version of its own; a version that is there is never written again."""
    slots.coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The map of a version, or of the last one."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).drop("version")


def write_shards(placed_rows: DataFrame, path: str) -> None:
    """One folder a shard, its rows in the order of their slots; a large shard gets several files."""
    placed_rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
