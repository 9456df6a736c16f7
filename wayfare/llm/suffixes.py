"""Exact substring deduplication by seeds and one comparison, in place of prefix doubling over byte positions.

Every byte of a ``length``-byte string that also starts anywhere else, in the
same document or another, is removed.  There are no doubling rounds: positions
are ranked by a short prefix, the seed, and once more by the whole length, a
rank being the fingerprint of the prefix, and Spark brings equal ranks together:

1. The first rank covers ``grain`` bytes.  Only sampled positions take part
   (``anchors.py``): one lies in every ``length``-byte string, at a place that
   the string alone decides, so a string whose sampled rank is unique is unique.
2. Positions that share it get the rank pair of everything that their strings
   reach to the left and to the right.  An equal pair settles all strings of
   the position at once, for any number of copies.
3. What is left are positions at the edge of a repeat.  One position of each
   rank pair is ranked at every byte: the pair of the two half-length ranks
   that start there and half a length on.  Strings unique at this length stay.

Bytes travel only in step 3, as the surroundings of one position per rank pair.
Groups of up to ``group_rows`` positions are ranked inside the task that their
first rank leads them to; larger ones as one Spark row per byte position.
Both ways give the same strings.

Null counts as empty; texts shorter than ``length`` bytes lose nothing.
Repeated rows are copies of each other.  Added columns replace columns of the
same name; others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from wayfare.llm import anchors, carried, flat
from wayfare.llm.anchors import SEED_FIELDS, written

LENGTH = 200
GRAIN = 40

#: Positions of one rank that a task ranks by itself; more are spread over tasks byte by byte.
GROUP_ROWS = 16_384


def repeated(
    docs: DataFrame, text: str, length: int = LENGTH, grain: int = GRAIN, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Strings found at two places or more, as ``_row``, ``_copy`` and ``owners``."""
    spark = docs.sparkSession
    keys = [docs.schema["_row"], docs.schema["_copy"]]
    ranked = docs.mapInArrow(
        anchors.emit(anchors.of_bytes, text, ["_row", "_copy"], length, grain), T.StructType([*keys, *SEED_FIELDS])
    )
    alike = ranked.groupBy("seed").agg(F.count("*").alias("_n")).where("_n > 1").select("seed")
    shared = written(ranked.join(anchors.anew(alike, "seed"), "seed"), "ranks")

    pairs = shared.groupBy("seed", "span").agg(
        F.count("*").alias("_n"), *(F.first(c).alias(c) for c in ("_row", "_copy", "owners"))
    )
    settled = shared.join(anchors.anew(pairs.where("_n > 1").select("seed", "span"), "seed"), ["seed", "span"])
    settled = settled.select("_row", "_copy", "owners")

    open_ = pairs.groupBy("seed").agg(F.count("*").alias("_rows"), F.min("_n").alias("_least"))
    open_ = open_.where("_rows > 1 and _least = 1").drop("_least")
    asked = pairs.join(anchors.anew(open_, "seed"), "seed").select(
        "_row", "_copy",
        F.struct("owners", "seed", (F.col("_n") > 1).alias("many"), (F.col("_rows") > group_rows).alias("wide"))
        .alias("_asked"),
    )
    asked = anchors.anew(asked.groupBy("_row", "_copy").agg(F.collect_set("_asked").alias("_asked")), "_row")
    around = written(
        docs.join(asked, ["_row", "_copy"]).mapInArrow(_surroundings(text, length), T.StructType([*keys, *AROUND])),
        "surroundings",
    )

    small = around.where(~F.col("wide")).drop("wide")
    small = small.repartition("seed").sortWithinPartitions("seed")
    near = small.mapInArrow(_rank_groups(length), T.StructType([*keys, SEED_FIELDS[-1]]))

    wide = around.where("wide").drop("wide").mapInArrow(
        _rank_bytes(length),
        T.StructType([*keys, *SEED_FIELDS, T.StructField("times", T.LongType(), False)]),
    )
    times = wide.groupBy("seed", "span").agg(F.sum("times").alias("_n")).where("_n > 1").select("seed", "span")
    far = wide.where("times = 1").join(anchors.anew(times, "seed"), ["seed", "span"]).select("_row", "_copy", "owners")
    return settled.unionByName(near).unionByName(far)


AROUND = [
    T.StructField("seed", T.LongType(), False), T.StructField("owners", T.LongType(), False),
    T.StructField("many", T.BooleanType(), False), T.StructField("wide", T.BooleanType(), False),
    T.StructField("bytes", T.BinaryType(), False),
]


def _surroundings(text: str, length: int):
    """All bytes of the strings that own each asked position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(anchors.unlike_neighbours(batches, ["_row", "_copy"]), text):
            raw, at = flat.flat_bytes(rows.column(text))
            asked = rows.column("_asked")
            row = np.repeat(np.arange(rows.num_rows), np.diff(asked.offsets.to_numpy()))
            parts = asked.flatten()
            first, last = anchors.unpack(parts.field("owners").to_numpy())
            size = last - first + length
            offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
            data = raw[flat.ragged_arange(at[row] + first, size)]
            taken = [rows.column(k).take(pa.array(row)) for k in ("_row", "_copy")]
            yield pa.record_batch(
                [*taken, *(parts.field(k) for k in ("seed", "owners", "many", "wide")),
                 pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])],
                names=["_row", "_copy", *(f.name for f in AROUND)],
            )

    return run


def _rank_all(rows: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every string in the surroundings: its row, its start in it, and its rank pair as one number."""
    raw, at = flat.flat_bytes(rows.column("bytes"))
    windows = flat.Windows(flat.BYTE_VALUES[raw])
    count = np.diff(at) - length + 1
    row = np.repeat(np.arange(rows.num_rows), count)
    start = flat.ragged_arange(np.zeros(len(count), np.int64), count)
    half = length // 2
    begin = at[row] + start
    pair = flat.mix(windows.of(begin, begin + half) * np.uint64(0x9FB21C651E98DF25)
                    + windows.of(begin + half, begin + length))
    return row, start, pair


def _rank_groups(length: int):
    """Rank the strings of whole groups, which follow each other in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(flat.chunks(batches, "bytes", flat.CHUNK_BYTES // 2)):
            row, start, pair = _rank_all(rows, length)
            seed = rows.column("seed").to_numpy().view(np.uint64)
            many = rows.column("many").to_numpy(zero_copy_only=False)
            first, _ = anchors.unpack(rows.column("owners").to_numpy())
            _, back = np.unique(flat.mix(pair + flat.mix(seed)[row]), return_inverse=True)
            times = np.bincount(back, weights=np.where(many[row], 2, 1))
            found = np.flatnonzero((times[back] > 1) & ~many[row])
            row, start = row[found], start[found] + first[row[found]]
            # neighbouring strings of one row become one range
            opens = np.ones(len(row), bool)
            opens[1:] = (np.diff(row) != 0) | (np.diff(start) != 1)
            closes = np.append(opens[1:], True) if len(row) else opens
            taken = [rows.column(k).take(pa.array(row[opens])) for k in ("_row", "_copy")]
            yield pa.record_batch([*taken, pa.array(anchors.pack(start[opens], start[closes]))],
                                  names=["_row", "_copy", "owners"])

    return run


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the sorted rows only between groups."""
    held: list[pa.RecordBatch] = []
    for rows in batches:
        seed = rows.column("seed").to_numpy()
        cuts = np.flatnonzero(seed[1:] != seed[:-1]) + 1
        if held and held[-1].column("seed")[-1].as_py() != seed[0]:
            yield _joined(held)
            held = []
        if len(cuts):
            yield _joined([*held, rows.slice(0, cuts[-1])])
            held, rows = [], rows.slice(cuts[-1])
        held.append(rows)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def _rank_bytes(length: int):
    """One row for each string in the surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, "bytes", 1 << 18):
            row, start, pair = _rank_all(rows, length)
            first, _ = anchors.unpack(rows.column("owners").to_numpy())
            start = start + first[row]
            picked = pa.array(row)
            times = pc.if_else(rows.column("many"), 2, 1).cast(pa.int64())
            yield pa.record_batch(
                [*(rows.column(k).take(picked) for k in ("_row", "_copy", "seed")), pa.array(pair.view(np.int64)),
                 pa.array(anchors.pack(start, start)), times.take(picked)],
                names=["_row", "_copy", "seed", "span", "owners", "times"],
            )

    return run


def deduplicate(
    docs: DataFrame, *, text: str = "text", length: int = LENGTH, grain: int = GRAIN, group_rows: int = GROUP_ROWS,
    kept: str = "kept_bytes",
) -> DataFrame:
    """Documents with ``n_bytes``, ``n_removed``, ``n_spans`` and the remaining bytes in ``kept``."""
    own = docs.drop(*({"n_bytes", "n_removed", "n_spans", kept} - {text}))
    text_ = carried.TEXT
    # Rows with one text lose the same bytes, so a text's two hashes name its rows.
    rows = carried.packed(own, text, text).withColumns({"_row": F.xxhash64(text_), "_copy": F.hash(text_)})
    spans = repeated(rows.select("_row", "_copy", text_), text_, length, grain, group_rows)
    spans = anchors.anew(spans.groupBy("_row", "_copy").agg(F.collect_set("owners").alias("_owners")), "_row")
    packed = [text_, carried.REST]
    joined = rows.join(spans, ["_row", "_copy"], "left").select(*packed, "_owners")
    added = [*(T.StructField(c, T.LongType(), False) for c in ("_n_bytes", "_n_removed", "_n_spans")),
             T.StructField("_kept", T.BinaryType(), False)]
    cut = joined.mapInArrow(_cut(packed, text_, length, added), T.StructType([*(rows.schema[c] for c in packed), *added]))
    return cut.select(*carried.columns(own, text, text), *(F.col(f"_{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")),
                      F.col("_kept").alias(kept))


def _cut(columns: list[str], text: str, length: int, added: list[T.StructField]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            raw, at = flat.flat_bytes(rows.column(text))
            gone = anchors.removed(rows.column("_owners"), at, length)
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            opens[at[:-1][at[:-1] < len(raw)]] = gone[at[:-1][at[:-1] < len(raw)]]
            gone_before, opened = (np.concatenate(([0], np.cumsum(x))) for x in (gone, opens))
            offsets = (at - gone_before[at]).astype(np.int32)
            data = np.ascontiguousarray(raw[~gone])
            new = [pa.array(np.diff(at)), pa.array(np.diff(gone_before[at])), pa.array(np.diff(opened[at])),
                   pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])]
            yield pa.record_batch([*(rows.column(c) for c in columns), *new], names=[*columns, *(f.name for f in added)])

    return run
