"""Winnowed anchors: the sampled places that every stretch of a given length shares with its copies.

Every stretch of ``length`` symbols owns one anchor, the place inside it whose
``grain`` symbols have the smallest hash.  The choice depends on the stretch
alone, so two equal stretches own anchors with equal hashes at equal offsets:
whoever compares anchors misses no repeat of ``length`` symbols.  Consecutive
stretches share their anchors, which leaves about ``2 / (length - grain)`` of
all places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame, functions as F, types as T

from wayfare.llm import flat
from wayfare.scratch import fresh_path

SEED_FIELDS = [T.StructField(name, T.LongType(), False) for name in ("seed", "span", "owners")]


#: Rows of a file of an intermediate table whose size is known.
FILE_ROWS = 20_000


def written(frame: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and not lost with an executor.

    Where the number of ``rows`` is known, a small table gets few files.
    """
    path = fresh_path(frame.sparkSession, name)
    if rows is not None:
        frame = frame.coalesce(max(1, rows // FILE_ROWS))
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def anew(frame: DataFrame, column: str) -> DataFrame:
    """The same rows with a number column computed anew.

    A join on it then shuffles these rows although an aggregate has just placed
    them; only between two plain shuffles can Spark split a hot key.
    """
    return frame.withColumn(column, F.bitwise_not(F.bitwise_not(column)))


Symbols = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def of_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every byte a symbol; where each row starts."""
    raw, at = flat.flat_bytes(texts)
    return flat.BYTE_VALUES[raw], at


def of_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every word a symbol; where each row starts."""
    raw, at = flat.flat_bytes(texts)
    starts, ends, first = flat.word_spans(raw, at, flat.PLAIN_WORD)
    return flat.word_hashes(raw, starts, ends), first


def whole(at: np.ndarray, length: int) -> np.ndarray:
    """True for each place whose next ``length`` symbols lie in one row."""
    n = int(at[-1])
    inner = at[1:]
    count = max(0, n - length + 1)
    return ~flat.covered(np.clip(inner - length + 1, 0, count), np.minimum(inner, count), count)


def anchors(values: np.ndarray, at: np.ndarray, length: int, grain: int) -> dict[str, np.ndarray]:
    """For each anchor: its row, the first and last stretch that owns it (from the row's start), and two hashes.

    ``seed`` names the anchor's own symbols, ``span`` everything from the first
    owner's start to the last owner's end and where in it the anchor is.
    """
    windows = flat.Windows(values)
    hashes = windows.all(grain)
    place = flat.minimizers(hashes, length - grain + 1)
    starts = np.flatnonzero(whole(at, length)) if len(place) else np.zeros(0, np.int64)
    place = place[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = (np.diff(starts) != 1) | (np.diff(place) != 0)
    first = starts[opens]
    last = starts[np.append(opens[1:], True)] if len(starts) else starts
    place = place[opens]
    row = np.searchsorted(at, first, "right") - 1
    span = flat.mix(windows.of(first, last + length) + (place - first).astype(np.uint64))
    return {
        "row": row, "first": first - at[row], "last": last - at[row],
        "seed": hashes[place].view(np.int64), "span": span.view(np.int64),
    }


def emit(symbols: Symbols, text: str, keys: list[str], length: int, grain: int, chunk: int = flat.CHUNK_BYTES):
    """A function for mapInArrow: one row of keys, seed, span and the packed range of owners for each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text, chunk):
            found = anchors(*symbols(rows.column(text)), length, grain)
            taken = [rows.column(k).take(pa.array(found["row"])) for k in keys]
            yield pa.record_batch(
                [*taken, pa.array(found["seed"]), pa.array(found["span"]), pa.array(pack(found["first"], found["last"]))],
                names=[*keys, "seed", "span", "owners"],
            )

    return run


OWNER_BITS = 16


def pack(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First owner and number of further owners in one number."""
    return (first << OWNER_BITS) | (last - first)


def unpack(owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last owner."""
    first = owners >> OWNER_BITS
    return first, first + (owners & ((1 << OWNER_BITS) - 1))


def lists(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in a column of lists, and the row that each belongs to; null counts as an empty list."""
    sizes = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)
    return array.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(array)), sizes)


def removed(owners: pa.Array, at: np.ndarray, length: int) -> np.ndarray:
    """True for each symbol that a listed stretch of ``length`` symbols covers."""
    packed, row = lists(owners)
    first, last = unpack(packed.astype(np.int64))
    return flat.covered(at[row] + first, at[row] + last + length, int(at[-1]))


def unlike_neighbours(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Without the rows whose keys equal those of the row before; in sorted rows one of each key stays per task."""
    before: tuple | None = None
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.ones(rows.num_rows, bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        new[0] = before != tuple(c[0] for c in columns)
        before = tuple(c[-1] for c in columns)
        yield rows.filter(pa.array(new))
