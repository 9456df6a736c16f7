"""SentencePiece encoding and decoding by vectorised merge rounds.

A task cuts its texts into words (a run of word marks and what follows up to
the next one; no piece crosses that border), looks each distinct word up among
those it has met, and encodes all new ones together: their characters lie in
one flat array, every round finds the best pair of each stretch, merges its
leftmost places in all stretches at once and closes the gaps, until no pair is
left.  A stretch ends where no piece holds both neighbours, so its merges
depend on nothing outside.

One round merges every place of a stretch's best pair only where no piece that
the merge could lead to comes before it; else the leftmost place alone.  That
gives the library's order exactly.  Stretches of more than ``LONG`` characters
(one character repeated for pages) take the same merges from a heap instead.

Null and empty texts give the end id alone and decode to the empty text.
Repeated rows are encoded each by itself.  Added columns replace columns of
the same name; others pass through.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from wayfare.llm import flat

MARK = "▁"
NEVER = np.iinfo(np.int64).max

#: Characters of a stretch beyond which merges come from a heap.
LONG = 1024

#: Characters of words that a task remembers, at most.
REMEMBERED = 4 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Normal pieces with their scores, and what stands for single bytes."""

    pieces: tuple[str, ...]  # all ids in order
    scores: np.ndarray
    normal: np.ndarray
    byte_ids: np.ndarray  # 256 ids
    end: int
    control: frozenset[int]

    @staticmethod
    def load(path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        form, kind = model.normalizer_spec, model.trainer_spec
        plain = not form.precompiled_charsmap and form.add_dummy_prefix and form.escape_whitespaces
        if not plain or form.remove_extra_whitespaces or kind.model_type != 2 or not kind.byte_fallback:
            raise ValueError("only byte-fallback BPE models without text normalisation can be used")
        types = np.array([p.type for p in model.pieces])
        if (types >= 4).any() and not set(types[types >= 4]) <= {6}:
            raise ValueError("models with user-defined or unused pieces can't be used")
        pieces = tuple(p.piece for p in model.pieces)
        if any(MARK in p.lstrip(MARK) or "\n" in p for p, t in zip(pieces, types) if t == 1):
            raise ValueError("a piece goes over the end of a word")
        number = {p: i for i, p in enumerate(pieces)}
        return Vocabulary(
            pieces, np.array([p.score for p in model.pieces]), types == 1,
            np.array([number[f"<0x{b:02X}>"] for b in range(256)]), number[kind.eos_piece],
            frozenset(np.flatnonzero(types == 3).tolist()),
        )

    # Symbols are the ids, then characters that are in pieces but no pieces
    # themselves, then (from ``unknown`` on) every other character.

    @cached_property
    def symbols(self) -> dict[str, int]:
        own = {p: i for i, p in enumerate(self.pieces) if self.normal[i]}
        for c in sorted({c for p in own for c in p} - own.keys()):
            own[c] = len(self.pieces) + len(own)
        return own

    @cached_property
    def unknown(self) -> int:
        return max(len(self.pieces), *self.symbols.values()) + 1

    @cached_property
    def width(self) -> int:
        return self.unknown + 0x110000

    @cached_property
    def rank(self) -> np.ndarray:
        """Order of merges; pieces with one score share a rank."""
        return np.unique(-self.scores, return_inverse=True)[1]

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted pairs of symbols that make a piece, and the piece."""
        found = {}
        for piece, i in self.symbols.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    found[left * self.width + right] = i
        keys = np.array(sorted(found), np.int64)
        return keys, np.array([found[k] for k in keys.tolist()], np.int64)

    @cached_property
    def alone(self) -> np.ndarray:
        """Pieces after whose making a pair could come up that is merged before their other places."""
        keys, made = self.pairs
        alone = np.zeros(self.unknown, bool)
        for part in (keys // self.width, keys % self.width):
            inner = part < len(self.pieces)
            alone[part[inner][self.rank[made[inner]] <= self.rank[part[inner]]]] = True
        return alone

    @cached_property
    def neighbours(self) -> np.ndarray:
        """Sorted pairs of characters that are next to each other in a piece."""
        found = {(ord(a) << 21) | ord(b) for p in self.symbols for a, b in zip(p, p[1:])}
        return np.array(sorted(found), np.int64)

    @cached_property
    def of_character(self) -> tuple[np.ndarray, np.ndarray]:
        single = sorted((ord(p), i) for p, i in self.symbols.items() if len(p) == 1)
        return tuple(np.array(x, np.int64) for x in zip(*single))

    @cached_property
    def piece_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that every id decodes to, one after another, and where each starts."""
        of_byte = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        parts = [
            of_byte[i] if i in of_byte else b"" if i in self.control
            else p.replace(MARK, " ").encode() if self.normal[i] else " ⁇ ".encode()
            for i, p in enumerate(self.pieces)
        ]
        return (np.frombuffer(b"".join(parts), np.uint8),
                np.concatenate(([0], np.cumsum([len(p) for p in parts]))))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def encode_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and where each word starts (one more at the end)."""
    text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    at = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    characters, numbers = vocabulary.of_character
    place, known = _find(characters, text)
    symbols = np.where(known, numbers[place], vocabulary.unknown + text)
    opens = np.ones(len(text), bool)
    opens[1:] = ~_find(vocabulary.neighbours, (text[:-1] << 21) | text[1:])[1]
    opens[at[:-1][at[:-1] < len(text)]] = True
    stretch = np.cumsum(opens) - 1
    sizes = np.bincount(stretch) if len(stretch) else np.zeros(0, np.int64)

    long = np.flatnonzero(sizes > LONG)
    places, made = _rounds(symbols, stretch, np.arange(len(text)), vocabulary, sizes)
    parts = [(places, made)]
    starts = np.flatnonzero(opens)
    for number in long.tolist():
        parts.append(_heap(symbols[starts[number] : starts[number] + sizes[number]].tolist(), starts[number], vocabulary))
    places, made = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(places, kind="stable")
    places, made = places[order], made[order]

    # characters without a piece become their bytes
    plain = made < len(vocabulary.pieces)
    code = text[places]
    count = np.where(plain, 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
    ids = np.repeat(made, count)
    other = np.repeat(~plain, count)
    if other.any():
        raw = np.frombuffer("".join(map(chr, code[~plain].tolist())).encode("utf-8", "surrogatepass"), np.uint8)
        ids[other] = vocabulary.byte_ids[raw]
    stop = np.concatenate(([0], np.cumsum(count)))
    return ids, stop[np.searchsorted(places, at)]


def _rounds(symbol, stretch, place, vocabulary: Vocabulary, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Merge rounds over all stretches that aren't too long; places of the first character, and symbols."""
    keep = sizes[stretch] <= LONG
    symbol, stretch, place = symbol[keep], stretch[keep], place[keep]
    keys, made = vocabulary.pairs

    def look(at: np.ndarray) -> None:
        """Piece and rank of the pairs that begin at these symbols."""
        at = at[at < len(symbol) - 1]
        at = at[stretch[at] == stretch[at + 1]]
        found, joined = _find(keys, symbol[at] * vocabulary.width + symbol[at + 1])
        piece[at] = np.where(joined, made[found], 0)
        rank[at] = np.where(joined, vocabulary.rank[piece[at]], NEVER)

    piece, rank = np.zeros(len(symbol), np.int64), np.full(len(symbol), NEVER)
    look(np.arange(len(symbol)))
    done_places, done_symbols = [], []
    while len(symbol):
        opens = np.append(0, np.flatnonzero(stretch[1:] != stretch[:-1]) + 1)
        index = np.zeros(len(symbol), np.int64)
        index[opens[1:]] = 1
        index = np.cumsum(index)
        best = np.minimum.reduceat(rank, opens)[index]
        finished = best == NEVER
        done_places.append(place[finished])
        done_symbols.append(symbol[finished])
        chosen = (rank == best) & ~finished
        # where a merge could bring up an earlier pair, only the first place of the stretch
        lonely = np.logical_or.reduceat(chosen & vocabulary.alone[piece], opens)[index]
        if lonely.any():
            spots = np.flatnonzero(chosen)
            first = np.ones(len(spots), bool)
            first[1:] = index[spots][1:] != index[spots][:-1]
            chosen[spots[~first & lonely[spots]]] = False
        # of places that overlap, every other one from the left
        spots = np.flatnonzero(chosen)
        run = np.ones(len(spots), bool)
        run[1:] = np.diff(spots) != 1
        start = spots[np.maximum.accumulate(np.where(run, np.arange(len(spots)), 0))]
        spots = spots[(spots - start) % 2 == 0]
        symbol[spots] = piece[spots]
        keep = ~finished
        keep[spots + 1] = False
        new = np.cumsum(keep)[spots] - 1
        symbol, stretch, place, piece, rank = (x[keep] for x in (symbol, stretch, place, piece, rank))
        # only the pairs beside a merged symbol are new
        changed = np.union1d(new, np.maximum(new - 1, 0))
        rank[changed] = NEVER
        look(changed)
    if not done_places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(done_places), np.concatenate(done_symbols)


def _heap(symbols: list[int], first: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The same merges for one long stretch."""
    keys, made = vocabulary.pairs
    table = vocabulary.__dict__.setdefault("_table", dict(zip(keys.tolist(), made.tolist())))
    n = len(symbols)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    queue: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j >= 0 and (piece := table.get(symbols[i] * vocabulary.width + symbols[j])) is not None:
            heapq.heappush(queue, (int(vocabulary.rank[piece]), i, symbols[i], symbols[j]))

    for i in range(n):
        offer(i)
    while queue:
        _, i, left, right = heapq.heappop(queue)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:
            continue
        symbols[i], symbols[j] = table[left * vocabulary.width + right], -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    left_over = [i for i in range(n) if symbols[i] >= 0]
    return np.array(left_over, np.int64) + first, np.array([symbols[i] for i in left_over], np.int64)


# No piece holds a line feed (``load`` checks), so words end before one as well.
_WORD = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")


class Encoder:
    """Encodes chunk after chunk, remembering the words it has met up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.at, self.size = [], [np.zeros(1, np.int64)], 0

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and where each text starts."""
        if self.size > REMEMBERED:
            self._forget()
        words = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        index = self.index
        new = list(dict.fromkeys(w for row in words for w in row if w not in index))
        if new:
            ids, at = encode_words(new, self.vocabulary)
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self.ids = [np.concatenate([*self.ids, ids])]
            self.at = [np.concatenate([*self.at, at[1:] + self.at[-1][-1]])]
            self.size += sum(map(len, new))
        starts = self.at[0]
        counts = np.array([len(row) for row in words], np.int64)
        met = np.fromiter((index[w] for row in words for w in row), np.int64, int(counts.sum()))
        sizes = starts[met + 1] - starts[met]
        body = self.ids[0][flat.ragged_arange(starts[met], sizes)] if len(met) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)]
        # an end id behind every text
        out = np.full(len(body) + len(texts), self.vocabulary.end, np.int32)
        inner = np.ones(len(out), bool)
        inner[ends + np.arange(len(texts))] = False
        out[inner] = body
        return out, np.concatenate(([0], ends + np.arange(1, len(texts) + 1)))


def decode(ids: np.ndarray, at: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the decoded rows of ids, and where each row starts."""
    data, starts = vocabulary.piece_bytes
    sizes = starts[ids + 1] - starts[ids]
    out = data[flat.ragged_arange(starts[ids], sizes)]
    stops = np.concatenate(([0], np.cumsum(sizes)))[at]
    first = stops[:-1][stops[:-1] < stops[1:]]
    marked = first[out[first] == 0x20]  # the space that encoding puts in front
    keep = np.ones(len(out), bool)
    keep[marked] = False
    gone = np.concatenate(([0], np.cumsum(~keep)))
    return out[keep], stops - gone[stops]


def encode(
    docs: DataFrame, model: str, *, text: str = "text", ids: str = "token_ids", decoded: str = "decoded_text",
) -> DataFrame:
    """Documents with the ids of their whole texts, an end id last, and the text these decode to.

    ``model`` is a path on the driver; tasks get the vocabulary, not the path.
    """
    vocabulary = Vocabulary.load(model)
    docs = docs.drop(ids, decoded)
    schema = T.StructType([
        *docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
        T.StructField(decoded, T.StringType(), False),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for rows in flat.chunks(batches, text, flat.CHUNK_BYTES // 2):
            found, at = encoder.encode(rows.column(text).to_pylist())
            data, stops = decode(found, at, vocabulary)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found, pa.int32()))
            texts = pa.Array.from_buffers(pa.string(), rows.num_rows, [
                None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
            yield rows.append_column(pa.field(ids, lists.type, False), lists).append_column(decoded, texts)

    return docs.mapInArrow(run, schema)
