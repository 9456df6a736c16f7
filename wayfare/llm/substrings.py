"""Substring deduplication by seed and extend.

Seeds are winnowed anchors (``anchors.py``): documents join on equal ones.
Each seed is extended both ways over all stretches of ``length`` words that
own it.  Where the whole extension of two documents is equal, one comparison
settles all its stretches; where it breaks off inside (the edge of a repeat)
each stretch of the documents concerned is compared.  Overlapping repeated
stretches together are the maximal repeats, and their words are removed from
every document but the one with the smallest id.

Exact copies, however many, stay one row each per seed and are counted before
they are shuffled; nothing pairs the members of a group.

Null or empty texts and texts shorter than ``length`` words lose nothing.  A
row without an id loses nothing and takes nothing from others.  Rows with the
same id never take words from each other.  Added columns replace columns of
the same name; others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from wayfare.llm import anchors, carried, flat
from wayfare.llm.anchors import SEED_FIELDS, written

LENGTH = 50
GRAIN = 10

#: Columns that name a row beside its id: 96 bits of its text's hashes.
ROW = ["_row", "_copy"]


def repeated(docs: DataFrame, key: str, text: str, length: int = LENGTH, grain: int = GRAIN) -> DataFrame:
    """Stretches that also start in a document with a smaller id: key, two hashes of the text, and ``owners``."""
    name = [key, *ROW]
    seeds = docs.select(*name, text).mapInArrow(
        anchors.emit(anchors.of_words, text, name, length, grain),
        T.StructType([*(docs.schema[c] for c in name), *SEED_FIELDS]),
    )
    spread = seeds.groupBy("seed").agg(F.min(key).alias("_least"), F.max(key).alias("_most"))
    spread = spread.where("_least < _most").drop("_most")
    shared = written(seeds.join(anchors.anew(spread, "seed"), "seed"), "seeds")

    classes = shared.groupBy("seed", "span").agg(F.min(key).alias("_first"), F.first("_least").alias("_least"))
    # A group whose documents agree all the way needs no look at single stretches.
    mixed = classes.groupBy("seed").agg((F.count("*") > 1).alias("_mixed"))
    members = written(
        shared.drop("_least").join(anchors.anew(classes.select("seed", "span", "_first"), "seed"), ["seed", "span"])
        .join(anchors.anew(mixed, "seed"), "seed"),
        "members",
    )
    later = members.where(F.col(key) > F.col("_first")).select(*name, "owners")
    edges = members.where(F.col("_mixed") & (F.col(key) == F.col("_first")))
    asked = anchors.anew(edges.groupBy(*name).agg(F.collect_set(F.struct("owners", "seed")).alias("_asked")), "_row")
    stretches = docs.join(asked, name).mapInArrow(
        _stretches(name, text, length), T.StructType([*(docs.schema[c] for c in name), *SEED_FIELDS]),
    )
    first = stretches.groupBy("seed", "span").agg(F.min(key).alias("_first"))
    single = stretches.join(anchors.anew(first, "seed"), ["seed", "span"])
    single = single.where(F.col(key) > F.col("_first")).select(*name, "owners")
    return later.unionByName(single)


def _stretches(name: list[str], text: str, length: int):
    """One row for each stretch of the asked owners, with the hash of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(anchors.unlike_neighbours(batches, name), text):
            values, at = anchors.of_words(rows.column(text))
            asked = rows.column("_asked")
            sizes = np.diff(asked.offsets.to_numpy())
            row = np.repeat(np.arange(rows.num_rows), sizes)
            parts = asked.flatten()
            first, last = anchors.unpack(parts.field("owners").to_numpy())
            seed = parts.field("seed").to_numpy()
            count = last - first + 1
            row, seed = np.repeat(row, count), np.repeat(seed, count)
            start = flat.ragged_arange(first, count)
            span = flat.Windows(values).of(at[row] + start, at[row] + start + length).view(np.int64)
            for part in range(0, len(row), 1 << 18):
                piece = slice(part, part + (1 << 18))
                taken = [rows.column(k).take(pa.array(row[piece])) for k in name]
                yield pa.record_batch(
                    [*taken, pa.array(seed[piece]), pa.array(span[piece]),
                     pa.array(anchors.pack(start[piece], start[piece]))],
                    names=[*name, "seed", "span", "owners"],
                )

    return run


def deduplicate(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, grain: int = GRAIN,
    kept: str = "kept_text",
) -> DataFrame:
    """Documents with ``n_words``, ``n_removed`` and the kept words, joined by one space, in ``kept``."""
    own = docs.drop(*({"n_words", "n_removed", kept} - {key, text}))
    key_, text_ = carried.KEY, carried.TEXT
    rows = carried.packed(own, key, text).withColumns({"_row": F.xxhash64(text_), "_copy": F.hash(text_)})
    known, unknown = rows.where(F.col(key_).isNotNull()), rows.where(F.col(key_).isNull())
    # The same rows join the seeds' edges and the spans, so that their texts are shuffled once.
    found = repeated(known, key_, text_, length, grain)
    spans = anchors.anew(found.groupBy(key_, *ROW).agg(F.collect_set("owners").alias("_owners")), "_row")
    packed = [key_, text_, carried.REST]
    joined = known.join(spans, [key_, *ROW], "left").select(*packed, "_owners")
    joined = joined.unionByName(unknown.select(*packed, F.lit(None).cast("array<bigint>").alias("_owners")))
    added = [T.StructField("_n_words", T.LongType(), False), T.StructField("_n_removed", T.LongType(), False),
             T.StructField("_kept", T.StringType(), False)]
    cut = joined.mapInArrow(_cut(packed, text_, length, added), T.StructType([*(rows.schema[c] for c in packed), *added]))
    return cut.select(*carried.columns(own, key, text), F.col("_n_words").alias("n_words"),
                      F.col("_n_removed").alias("n_removed"), F.col("_kept").alias(kept))


def _cut(columns: list[str], text: str, length: int, added: list[T.StructField]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            raw, at = flat.flat_bytes(rows.column(text))
            starts, ends, first = flat.word_spans(raw, at, flat.PLAIN_WORD)
            gone = anchors.removed(rows.column("_owners"), first, length)
            gone_before = np.concatenate(([0], np.cumsum(gone)))
            new = [pa.array(np.diff(first)), pa.array(np.diff(gone_before[first])),
                   joined_words(raw, starts[~gone], ends[~gone], (first - gone_before[first]))]
            yield pa.record_batch([*(rows.column(c) for c in columns), *new], names=[*columns, *(f.name for f in added)])

    return run


def joined_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """The words of each row with one space between them; ``first`` has the number of each row's first word."""
    sizes = ends - starts + 1  # a space behind every word
    stop = np.concatenate(([0], np.cumsum(sizes)))
    place = flat.ragged_arange(starts, sizes)
    taken = raw[np.minimum(place, len(raw) - 1)] if len(raw) else np.zeros(0, np.uint8)
    taken[stop[1:] - 1] = 0x20
    last = stop[1:][first[1:][first[1:] > first[:-1]] - 1] - 1  # but not behind the last one of a row
    keep = np.ones(len(taken), bool)
    keep[last] = False
    size = stop[first[1:]] - stop[first[:-1]] - (first[1:] > first[:-1])
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(taken[keep])])


def cleaned(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents with their own columns, the repeated words taken out of ``text``.

    A text that loses nothing stays as it is; of others the kept words are
    joined by one space.  A document that loses all its words goes.
    """
    cut = deduplicate(carried.packed(docs, key, text), key=carried.KEY, text=carried.TEXT, kept="_kept", **options)
    cut = cut.where("n_removed = 0 or n_removed < n_words")
    new = F.when(F.col("n_removed") > 0, F.col("_kept")).otherwise(F.col(carried.TEXT))
    return carried.unpacked(cut, docs, key, text, new)
