"""Benchmark decontamination with suffix arrays of the training text.

Every task sorts the suffixes of its shard of training words and binary-
searches every suffix of the benchmark items in them: the interval at the
window length holds all places of that window.  Rows that have one are searched
once more, each in its own part of the array, for the suffixes whose windows it
has: where such a suffix stops narrowing are its longest verbatim matches.
Hits are counted by covered places, so a text that repeats a window costs what
its length costs, however often the item repeats it too.  No training text is shuffled; the
items reach the tasks in blocks of a checked size, one pass each.

Words are runs of ASCII digits, ASCII letters (lower-cased) and characters
beyond ASCII.  A window is ``window`` consecutive words of an item; an item
with fewer words, but not none, is one window.  Null or empty texts have no
words, so nothing is found in them and by them.  Items without an id carry the
empty string.  Repeated rows are searched each by itself.  Other columns of
the documents pass through, but one named like an added column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfare.llm import carried, flat
from wayfare.scratch import fresh_path

WINDOW = 10

#: Text of the items that one pass over the documents takes to every task, at most.
BLOCK_BYTES = 8 << 20

#: Slots in which the items' bytes are counted.
ITEM_SLOTS = 4096

#: Training text whose suffixes are sorted together.
SHARD_BYTES = 16 << 20

FOUND = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False),
    ]), False), False),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType(), False), T.StructField("item_word", T.LongType(), False),
        T.StructField("word", T.LongType(), False), T.StructField("length", T.LongType(), False),
    ]), False), False),
])


@dataclass(frozen=True)
class Block:
    """Benchmark suffixes as numbered words; word 0 ends an item."""

    vocabulary: np.ndarray  # sorted hashes; the word with the hash at i has number i + 1
    words: np.ndarray
    starts: np.ndarray  # of every suffix in words
    needs: np.ndarray  # words that a suffix must match to be a window; 0: it starts none
    texts: np.ndarray  # number of the distinct text of every suffix
    text_starts: np.ndarray
    ids: tuple[tuple[str, ...], ...]  # of the items with that text
    shortest: int


def block_of(rows: list[tuple[str, str]], window: int) -> Block | None:
    """The suffixes of some (item id, text) rows; None if there are no words."""
    raw, at = flat.flat_bytes(pa.array([text for _, text in rows], pa.string()))
    starts, ends, first = flat.word_spans(raw, at, flat.ALNUM_WORD)
    hashes = flat.word_hashes(raw, starts, ends, flat.FOLDED_VALUES)
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    same: dict[bytes, list[str]] = {}
    for i, (item, _) in enumerate(rows):
        if first[i] < first[i + 1]:
            same.setdefault((numbers[first[i] : first[i + 1]] + 1).astype(np.int64).tobytes(), []).append(item)
    if not same:
        return None
    texts = [np.frombuffer(key, np.int64) for key in same]
    sizes = np.array([len(t) for t in texts])
    text_starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    words = np.concatenate([np.append(t, 0) for t in texts])
    of = np.repeat(np.arange(len(texts)), sizes)
    suffixes = flat.ragged_arange(text_starts, sizes)
    left = np.repeat(sizes, sizes) - (suffixes - text_starts[of])
    needs = np.where(left >= window, window, np.where((sizes[of] < window) & (suffixes == text_starts[of]), left, 0))
    return Block(vocabulary, words, suffixes, needs, of, text_starts, tuple(map(tuple, same.values())),
                 int(needs[needs > 0].min()))


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in order of their first ``depth`` words, by doubling ranks."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    length = 1
    order = np.argsort(rank, kind="stable")
    while length < depth:
        following = np.zeros(n, np.int64)
        following[: n - length] = rank[length:] + 1
        pair = rank * (n + 1) + following
        order = np.argsort(pair, kind="stable")
        step = np.empty(n, np.int64)
        step[0] = 0
        step[1:] = np.cumsum(pair[order][1:] != pair[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if n == 0 or step[-1] == n - 1:
            break
        length *= 2
    return order


def _bound(words, order, low, high, depth, wanted, right: bool) -> np.ndarray:
    """Binary search in every interval at once: the first place whose word at ``depth`` isn't before ``wanted``."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        there = words[order[np.minimum(middle, len(order) - 1)] + depth]
        up = open_ & ((there <= wanted) if right else (there < wanted))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)
    return low


def search(
    words: np.ndarray, order: np.ndarray, block: Block, suffixes: np.ndarray, low: np.ndarray, high: np.ndarray,
    depth: int | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every asked suffix of the block, within its interval of ``order``: how many words match at most, and where.

    The places are an interval of ``order`` again.  With a ``depth`` the search
    ends where a suffix's window is whole, and gives no interval to others.
    """
    longest = np.zeros(len(suffixes), np.int64)
    met_low, met_high = np.zeros(len(suffixes), np.int64), np.zeros(len(suffixes), np.int64)
    active = np.arange(len(suffixes))
    padded = np.append(words, np.zeros(len(block.words) + 1, words.dtype))
    at = 0
    while len(active) and at != depth:
        wanted = block.words[block.starts[suffixes[active]] + at]
        new_low = _bound(padded, order, low, high, at, wanted, False)
        new_high = _bound(padded, order, new_low, high, at, wanted, True)
        goes_on = (wanted > 0) & (new_low < new_high)
        active, low, high = active[goes_on], new_low[goes_on], new_high[goes_on]
        at += 1
        longest[active] = at
        told = block.needs[suffixes[active]] == at if depth is not None else slice(None)
        met_low[active[told]], met_high[active[told]] = low[told], high[told]
    return longest, met_low, met_high


def find(texts: pa.Array, block: Block | None) -> tuple[np.ndarray, list[list], list[list]]:
    """Words of each text, its hit spans (in words), and the longest match of every item that has a window there."""
    counts, numbers = [], []
    for part in flat.chunks(iter([pa.record_batch([texts], ["t"])]), "t"):
        raw, at = flat.flat_bytes(part.column("t"))
        starts, ends, first = flat.word_spans(raw, at, flat.ALNUM_WORD)
        counts.append(np.diff(first))
        if block is not None:
            hashes = flat.word_hashes(raw, starts, ends, flat.FOLDED_VALUES)
            place = np.minimum(np.searchsorted(block.vocabulary, hashes), len(block.vocabulary) - 1)
            numbers.append(np.where(block.vocabulary[place] == hashes, place + 1, 0).astype(np.int64))
    n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    spans: list[list] = [[] for _ in n_words]
    matches: list[list] = [[] for _ in n_words]
    if block is None or not n_words.sum():
        return n_words, spans, matches
    known = np.concatenate(numbers)
    row_of = np.repeat(np.arange(len(n_words)), n_words)
    first = np.concatenate(([0], np.cumsum(n_words)))

    # Only runs of benchmark words as long as the shortest window can hold one:
    # the suffix array leaves out all others, with a 0 behind each run.
    ends_run = np.ones(len(known), bool)
    ends_run[:-1] = (known[:-1] == 0) | (known[1:] == 0) | (row_of[1:] != row_of[:-1])
    stop = np.flatnonzero(ends_run) + 1
    start = np.concatenate(([0], stop[:-1]))
    long = (known[start] > 0) & (stop - start >= block.shortest)
    start, size = start[long], (stop - start)[long]
    if not len(start):
        return n_words, spans, matches
    source = flat.ragged_arange(start, size + 1)  # the place behind a run stands for its 0
    words = known[np.minimum(source, len(known) - 1)]
    words[np.cumsum(size + 1) - 1] = 0

    order = suffix_array(words, int(np.diff(np.append(block.text_starts, len(block.words))).max()))
    everywhere = np.zeros(len(block.starts), np.int64)
    asked = np.arange(len(block.starts))
    _, low, high = search(words, order, block, asked, everywhere, everywhere + len(order), int(block.needs.max()))
    # Windows of one length that are equal have one interval, others have disjoint ones: each place counts once.
    hits = np.flatnonzero((block.needs > 0) & (high > low))
    if not len(hits):
        return n_words, spans, matches
    _, one, window_of = np.unique(np.stack([block.needs[hits], low[hits]]), axis=1, return_index=True, return_inverse=True)
    windows = hits[one]
    count = high[windows] - low[windows]
    place = order[flat.ragged_arange(low[windows], count)]
    begin = source[place]
    hit = flat.covered(begin, begin + np.repeat(block.needs[windows], count), len(known))
    _list_spans(spans, hit, first)

    # Which rows have which windows, and so which suffixes each row is searched for.
    pairs = np.unique(np.stack([np.repeat(np.arange(len(windows)), count), row_of[begin]]), axis=1)
    by_window = np.argsort(window_of, kind="stable")
    stops = np.concatenate(([0], np.cumsum(np.bincount(window_of, minlength=len(windows)))))
    many = np.diff(stops)[pairs[0]]
    suffix = hits[by_window[flat.ragged_arange(stops[pairs[0]], many)]]
    rows = np.repeat(pairs[1], many)
    for i, text, length, word, item_word in zip(*_longest(words, order, block, suffix, rows, row_of[np.minimum(source, len(known) - 1)])):
        inner = int(source[word] - first[i])
        matches[i] += [
            {"item_id": item, "item_word": item_word, "word": inner, "length": length} for item in block.ids[text]]
    return n_words, spans, matches


def _longest(words, order, block: Block, suffix: np.ndarray, rows: np.ndarray, row_of: np.ndarray) -> list[list[int]]:
    """Row, text, length, place and item word of the longest match of each text in each row, by row, then text.

    Of equally long matches the first place in the row counts, then the first
    word of the item.  ``row_of`` has the row of each place in ``words``.
    """
    by_row = order[np.argsort(row_of[order], kind="stable")]
    row_starts = np.searchsorted(row_of[by_row], np.arange(int(row_of.max()) + 2))
    length, low, high = search(words, by_row, block, suffix, row_starts[rows], row_starts[rows + 1])
    text = block.texts[suffix]
    group = np.lexsort((text, rows))
    opens = np.ones(len(group), bool)
    opens[1:] = (np.diff(rows[group]) != 0) | (np.diff(text[group]) != 0)
    most = np.maximum.reduceat(length[group], np.flatnonzero(opens))
    best = group[length[group] == most[np.cumsum(opens) - 1]]
    # Equal matches share an interval, and unlike ones of a length have disjoint ones.
    _, one, of = np.unique(np.stack([low[best], high[best]]), axis=1, return_index=True, return_inverse=True)
    sizes = high[best[one]] - low[best[one]]
    places = by_row[flat.ragged_arange(low[best[one]], sizes)]
    least = np.minimum.reduceat(places, np.concatenate(([0], np.cumsum(sizes)[:-1])))[of]
    item_word = block.starts[suffix[best]] - block.text_starts[text[best]]
    ranked = np.lexsort((item_word, least, text[best], rows[best]))
    keep = np.ones(len(ranked), bool)
    keep[1:] = (np.diff(rows[best][ranked]) != 0) | (np.diff(text[best][ranked]) != 0)
    ranked = ranked[keep]
    return [x[ranked].tolist() for x in (rows[best], text[best], length[best], least, item_word)]


def _list_spans(spans: list[list], hit: np.ndarray, first: np.ndarray) -> None:
    """The stretches of hit words, for each row."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[first] = True
    before, after = np.append(False, hit), np.append(hit, False)
    opens = np.flatnonzero(after & (~before | edge))
    closes = np.flatnonzero(before & (~after | edge))
    row = np.searchsorted(first, opens, "right") - 1
    for i, start, end in zip(row.tolist(), (opens - first[row]).tolist(), (closes - first[row]).tolist()):
        spans[i].append({"start": start, "end": end})


def _join(spans: list, start: int, end: int) -> None:
    """Add a stretch that starts no earlier than the last one."""
    if spans and start <= spans[-1]["end"]:
        spans[-1]["end"] = max(spans[-1]["end"], end)
    else:
        spans.append({"start": start, "end": end})


def _union(a: list, b: list) -> list:
    joined: list = []
    for span in sorted([*a, *b], key=lambda s: s["start"]):
        _join(joined, span["start"], span["end"])
    return joined


def blocks_of(items: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> Iterator[Block | None]:
    """The distinct items in blocks whose texts are measured before any is collected.

    Bytes are counted in ``ITEM_SLOTS`` slots by hash, and blocks are made of
    whole slots, so only a slot that is larger than a block makes one larger.
    """
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    rows = rows.dropDuplicates().withColumn("slot", F.pmod(F.xxhash64("i", "t"), F.lit(ITEM_SLOTS)))
    sizes = rows.groupBy("slot").agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("size")).orderBy("slot").collect()
    begin, filled = 0, 0
    bounds = []
    for slot, size in sizes:
        if filled and filled + size > block_bytes:
            bounds.append((begin, slot))
            begin, filled = slot, 0
        filled += size
    for low, high in [*bounds, (begin, ITEM_SLOTS)]:
        part = rows.where(F.col("slot").between(low, high - 1)) if bounds else rows
        yield block_of([(r.i, r.t) for r in part.collect()], window)


def scan(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, out: str = "found", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add the struct ``out``: words, hit spans, and the longest match of each item found in the row."""
    spark: SparkSession = docs.sparkSession
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, FOUND, False)])
    for number, block in enumerate(blocks_of(items, item_id, item_text, window, block_bytes)):
        if number:  # one pass at a time
            path = fresh_path(spark, "contamination")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        docs = docs.mapInArrow(_searcher(block, text, out, again=number > 0), schema)
    return docs


def _searcher(block: Block | None, text: str, out: str, again: bool):
    arrow = None

    def search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal arrow
        for rows in flat.chunks(batches, text, SHARD_BYTES):
            n_words, spans, matches = find(rows.column(text), block)
            if again:
                for i, before in enumerate(rows.column(out).to_pylist()):
                    spans[i] = _union(before["spans"], spans[i])
                    matches[i] = before["matches"] + matches[i]
                rows = rows.drop_columns([out])
            arrow = arrow or _arrow_type()
            found = [{"n_words": int(n), "spans": s, "matches": m} for n, s, m in zip(n_words, spans, matches)]
            yield rows.append_column(out, pa.array(found, arrow))

    return search_all


def _arrow_type() -> pa.DataType:
    span = pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])
    match = pa.struct([pa.field("item_id", pa.string(), False), *(
        pa.field(name, pa.int64(), False) for name in ("item_word", "word", "length"))])
    return pa.struct([
        pa.field("n_words", pa.int64(), False), pa.field("spans", pa.list_(pa.field("element", span, False)), False),
        pa.field("matches", pa.list_(pa.field("element", match, False)), False),
    ])


def n_hit(found: str = "found") -> Column:
    """Words inside any occurrence of a window."""
    return F.aggregate(F.col(f"{found}.spans"), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def found_items(found: str = "found") -> Column:
    """Ids of the items that have a window in the row, sorted as strings."""
    return F.array_sort(F.array_distinct(F.col(f"{found}.matches.item_id")))


def remove_contaminated(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Documents without any window of any item, with their own columns."""
    scanned = scan(carried.packed(docs, key, text), items, text=carried.TEXT, out="_found", **options)
    return carried.unpacked(scanned.where(F.size("_found.spans") == 0), docs, key, text)
