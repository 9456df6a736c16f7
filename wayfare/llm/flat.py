"""Texts of an Arrow batch as one flat byte array: words, hashes and windows without a loop over rows.

Everything here runs inside a task on one bounded chunk of rows.  Hashes of
windows are polynomials modulo 2**64 over random odd symbol values.  Such sums
have constructed collisions from 1,024 symbols on (Thue-Morse sequences), so
windows stay within a few hundred symbols, and words, which have no bound, are
hashed by another function where they are longer than ``LONG_WORD`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Rows of a chunk hold about so many bytes of text; one longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

#: Bytes of a word up to which its hash is a polynomial.
LONG_WORD = 256

U64 = np.uint64
_RANDOM = np.random.default_rng(20240229)
BYTE_VALUES = _RANDOM.integers(0, 2**64, 256, dtype=U64) | U64(1)
BASE = 0x9E3779B97F4A7C13
BACK = pow(BASE, -1, 2**64)

SPACES = b" \t\n\v\f\r"
UPPER = slice(0x41, 0x5B)

#: True for the bytes of a word: anything but a space and \t to \r.
PLAIN_WORD = np.ones(256, bool)
PLAIN_WORD[list(SPACES)] = False

#: True for ASCII digits, ASCII letters and every byte of a longer character.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True

#: Byte values that make A-Z equal to a-z.
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[UPPER] = BYTE_VALUES[0x61:0x7B]


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in pieces whose texts hold about ``size`` bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts; null counts as empty."""
    array = pc.fill_null(array.cast(pa.large_binary() if pa.types.is_binary(array.type) else pa.large_string()),
                         b"" if pa.types.is_binary(array.type) else "")
    _, offsets, data = array.buffers()
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_spans(raw: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each row (one more at the end)."""
    if not len(raw):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(len(at), np.int64)
    inside = is_word[raw]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(raw)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends_of_rows = at[1:][at[1:] > 0] - 1
    after[ends_of_rows] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits (a bijection)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1), kept for the next call."""
    known = _powers.get(base, np.ones(1, U64))
    if len(known) < n:
        known = np.full(max(n, 2 * len(known)), base, U64)
        known[0] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[:n]


class Windows:
    """Hashes of any stretches of a flat array of symbol values."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.back = powers(BACK, self.n + 1)  # moves a sum to place 0, so equal stretches have equal hashes anywhere
        self.total = np.zeros(self.n + 1, U64)
        np.cumsum(values * powers(BASE, self.n), out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each stretch; the length takes part."""
        sums = (self.total[ends] - self.total[starts]) * self.back[starts]
        return mix(sums + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))

    def all(self, length: int) -> np.ndarray:
        """Hash of the stretch of this length that starts at each symbol; for the last ones, too short, none."""
        if self.n < length:
            return np.zeros(0, U64)
        count = self.n - length + 1
        sums = (self.total[length:] - self.total[:count]) * self.back[:count]
        return mix(sums + U64(length * 0xD6E8FEB86659FD93 % 2**64))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of every word, equal for words whose bytes have equal ``values``."""
    if not len(starts):
        return np.zeros(0, U64)
    hashes = Windows(values[raw]).of(starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(values[raw[starts[i] : ends[i]]])
    return hashes


def ragged_arange(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True for each of n places inside any of the stretches."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, ends, 1)
    return np.cumsum(change[:-1]) > 0


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` hashes, the place of its smallest one, the leftmost among equals.

    The choice depends on the hashes inside the run alone: they are compared
    by their upper 32 bits, then by place, whatever array they lie in.
    """
    count = len(hashes) - window + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    place_bits = U64(32)
    least = (hashes >> place_bits << place_bits) | np.arange(len(hashes), dtype=U64)
    length = 1
    while 2 * length <= window:
        least = np.minimum(least[: len(least) - length], least[length:])
        length *= 2
    rest = window - length
    least = np.minimum(least[:count], least[rest : rest + count])
    return (least & U64(0xFFFFFFFF)).astype(np.int64)
