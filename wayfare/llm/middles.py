"""Fill-in-the-middle training texts: cut in three, marked, and put in another order.

A text is cut at two places between its units (lines, characters or bytes) and
written as prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``)
behind three marks; some texts stay ``plain``.  All draws come from the digest
of a seed and the row's id, so a retried task cuts alike.

Cuts are kept in bytes and reported in characters.  A sparse exception index
converts them: for every chunk of texts it has the places of the characters
longer than one byte and the running sum of their excess bytes, nothing for
ASCII.  One binary search in it turns a byte into a character place or back;
between exceptions the two differ by a constant.

A null text is empty.  An empty text, one that contains a mark, and one that
the draw leaves alone is plain, with null lengths.  A null id draws as an
empty one; rows with equal ids and texts are cut alike.  A cut in bytes moves
to the start of the character it falls into.  Added columns replace columns of
the same name; others pass through.  One text is held in a task three times
at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfare.llm import carried, flat

SEED = 7
UNITS = ("lines", "characters", "bytes")


@dataclass(frozen=True)
class Marks:
    """What stands before each part."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Exceptions:
    """Where characters of several bytes start in a flat byte array, and how many bytes they exceed one by."""

    def __init__(self, raw: np.ndarray):
        self.place = np.flatnonzero(raw >= 0xC0)
        lead = raw[self.place]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.size = excess + 1
        self.before = np.concatenate(([0], np.cumsum(excess)))
        #: Character place of each exception.
        self.character = self.place - self.before[:-1]

    def characters(self, at: np.ndarray) -> np.ndarray:
        """Characters before each byte place, a character's first byte."""
        return at - self.before[np.searchsorted(self.place, at)]

    def bytes(self, character: np.ndarray) -> np.ndarray:
        """First byte of each character place."""
        return character + self.before[np.searchsorted(self.character, character)]

    def starts(self, at: np.ndarray) -> np.ndarray:
        """Each byte place, or the start of the character it lies inside."""
        if not len(self.place):
            return at
        last = np.searchsorted(self.place, at, "right") - 1
        inside = (last >= 0) & (at < self.place[last] + self.size[last])
        return np.where(inside, self.place[last], at)


def unit_counts(raw: np.ndarray, at: np.ndarray, unit: str, index: Exceptions) -> np.ndarray:
    """How many units each text has."""
    if unit == "bytes":
        return np.diff(at)
    if unit == "characters":
        return np.diff(index.characters(at))
    breaks = np.flatnonzero(raw == 0x0A)
    inside = np.diff(np.searchsorted(breaks, at))
    filled = np.diff(at) > 0
    unended = filled.copy()
    unended[filled] = raw[at[1:][filled] - 1] != 0x0A
    return inside + unended


def unit_places(raw: np.ndarray, at: np.ndarray, unit: str, index: Exceptions, number: np.ndarray) -> np.ndarray:
    """The byte place behind so many units of each text."""
    if unit == "bytes":
        return index.starts(at[:-1] + number)
    if unit == "characters":
        return index.bytes(index.characters(at[:-1]) + number)
    breaks = np.flatnonzero(raw == 0x0A)
    first = np.searchsorted(breaks, at)
    which = first[:-1] + number - 1
    ended = (number > 0) & (which < first[1:])
    out = np.where(number > 0, at[1:], at[:-1])
    out[ended] = breaks[which[ended]] + 1
    return out


def draws(key: Column, seed: int) -> Column:
    """Four numbers below 2**32 of the sha256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)))


ADDED = [
    T.StructField("n_units", T.LongType(), False), T.StructField("form", T.StringType(), False),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("fim_text", T.StringType(), False),
]


def _cut(text: str, draw: str, kept: list[str], unit: str, marks: Marks, fim_percent: int, spm_percent: int):
    p, s, m = (mark.encode() for mark in marks.all())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            texts = pc.fill_null(rows.column(text).cast(pa.large_string()), "")
            raw, at = flat.flat_bytes(texts)
            index = Exceptions(raw)
            count = unit_counts(raw, at, unit, index)
            drawn = rows.column(draw).flatten().to_numpy().reshape(-1, 4)
            ends = np.sort(drawn[:, :2] % (count + 1)[:, None], axis=1)
            first, second = (unit_places(raw, at, unit, index, ends[:, k]) for k in (0, 1))
            marked = np.zeros(len(texts), bool)
            for mark in marks.all():
                marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
            plain = (np.diff(at) == 0) | marked | (drawn[:, 2] % 100 >= fim_percent)
            spm = drawn[:, 3] % 100 < spm_percent
            seen = [index.characters(x) for x in (at[:-1], first, second)]
            view, out = memoryview(np.ascontiguousarray(raw)), []
            for i in range(len(texts)):
                a, b, c, d = at[i], first[i], second[i], at[i + 1]
                if plain[i]:
                    parts = (view[a:d],)
                elif spm[i]:
                    parts = (s, view[c:d], p, view[a:b], m, view[b:c])
                else:
                    parts = (p, view[a:b], s, view[c:d], m, view[b:c])
                out.append(b"".join(parts))
            yield pa.record_batch(
                [*(rows.column(k) for k in kept), pa.array(count),
                 pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).astype(object), pa.string()),
                 pa.array(seen[1] - seen[0], mask=plain), pa.array(seen[2] - seen[1], mask=plain),
                 pa.array(out, pa.binary()).cast(pa.string())],
                names=[*kept, *(f.name for f in ADDED)],
            )

    return run


def transform(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", unit: str = "lines", seed: int = SEED,
    fim_percent: int = 100, spm_percent: int = 50, marks: Marks = Marks(),
) -> DataFrame:
    """Documents with ``fim_text``, its ``form``, ``n_units``, and ``prefix_chars`` and ``middle_chars``."""
    if unit not in UNITS:
        raise ValueError(f"units are {', '.join(UNITS)}")
    rows = carried.packed(docs, key, text).withColumn("_draws", draws(F.col(carried.KEY), seed))
    kept = [carried.KEY, carried.TEXT, carried.REST]
    cut = rows.mapInArrow(
        _cut(carried.TEXT, "_draws", kept, unit, marks, fim_percent, spm_percent),
        T.StructType([*(rows.schema[c] for c in kept), *ADDED]),
    )
    new = {f.name for f in ADDED}
    old = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in new or c in (key, text)))
    own = carried.columns(old, key, text)
    return cut.select(*own, *(f.name for f in ADDED if f.name not in (key, text)))


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that was cut, from what was written and its form."""

    def after(value: Column, mark: str, part: int) -> Column:
        return F.split(value, rf"\Q{mark}\E", -1)[part]

    p, s, m = marks.all()
    middle = after(output, m, 1)
    body = after(output, m, 0)
    psm = F.concat(after(after(body, p, 1), s, 0), middle, after(body, s, 1))
    spm = F.concat(after(body, p, 1), middle, after(after(body, s, 1), p, 0))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
