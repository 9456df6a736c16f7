"""Periodic runs of words: a suffix automaton whose link tree is accessed once for every appended word.

A run is a stretch of words with smallest period q that repeats it
``exponent`` times or more, has ``min_words`` words at least, and that no
neighbouring word extends.

The states on the path from the state of a prefix to the root of the
automaton's link tree are the suffixes of that prefix.  Every state remembers
where it ended last.  States of equal memory form segments of such a path; a
link-cut tree keeps one preferred path for each segment, so appending word i
is one access: it meets the segments, and colours the whole path with i.  A
segment whose words ended last at i - d, and whose longest suffix has l words,
says that the l + d words up to i have period d: a square where d <= l, and a
run where the stretch is long enough.  The longest suffix of a segment can't be
lengthened to the left, and the last i at which a stretch is met is its end, so
the stretch is extended both ways without comparing words again.  That d was
the last end makes it the smallest period.

Only stretches that could hold a run enter an automaton: inside a run, every
three consecutive words occur ``exponent - 1`` times or more, so a text is cut
wherever three words do not occur so often within their stretch, again and
again until nothing is cut.  That loses no run and no word of one.

Null and empty texts have no words and no runs.  Rows are judged one by one;
rows may repeat.  Words are compared by 64-bit hashes.  A text is held by one
task, with some 0.5 KB for each word in a stretch that enters an automaton.
Added columns replace columns of the same name; others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from wayfare.llm import carried, flat
from wayfare.llm.substrings import joined_words

MIN_WORDS = 6
EXPONENT = 4

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


class Automaton:
    """The states of a suffix automaton that the link tree needs: links, longest suffixes, states of prefixes."""

    def __init__(self, words: list[int]):
        steps: list[dict[int, int]] = [{}]
        link, longest, prefixes = [-1], [0], []
        last = 0
        for word in words:
            state = len(link)
            longest.append(longest[last] + 1)
            steps.append({})
            link.append(0)
            at = last
            while at >= 0 and word not in steps[at]:
                steps[at][word] = state
                at = link[at]
            if at >= 0:
                to = steps[at][word]
                if longest[at] + 1 == longest[to]:
                    link[state] = to
                else:
                    copy = len(link)
                    longest.append(longest[at] + 1)
                    steps.append(steps[to].copy())
                    link.append(link[to])
                    while at >= 0 and steps[at].get(word) == to:
                        steps[at][word] = copy
                        at = link[at]
                    link[to] = link[state] = copy
            prefixes.append(state)
            last = state
        self.link, self.longest, self.prefixes = link, longest, prefixes


def runs(words: list[int], min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """Start, length and period of every run, by start, then period.

    ``above`` is the parent inside a splay tree, or for its top the state where
    the path goes on; ``lower`` and ``upper`` are children nearer to the root
    of the link tree and farther from it.  State 0, the root, stands for none.
    A path's colour is kept at the top of its splay tree.
    """
    automaton = Automaton(words)
    above, longest = automaton.link, automaton.longest
    above[0] = 0
    lower, upper = [0] * len(above), [0] * len(above)
    colour = [-1] * len(above)
    ends: dict[tuple[int, int], int] = {}
    more = exponent - 1

    for i, state in enumerate(automaton.prefixes):
        below, x = 0, state
        while x:
            # Splay x to the top of its path's tree.
            p = above[x]
            if lower[p] == x or upper[p] == x:
                while True:
                    g = above[p]
                    inner = lower[g] == p or upper[g] == p
                    if inner and (lower[g] == p) == (lower[p] == x):
                        # both steps go the same way: turn p over g first
                        top = above[g]
                        if lower[top] == g:
                            lower[top] = p
                        elif upper[top] == g:
                            upper[top] = p
                        else:
                            colour[p] = colour[g]
                        above[p] = top
                        if lower[g] == p:
                            b = lower[g] = upper[p]
                            upper[p] = g
                        else:
                            b = upper[g] = lower[p]
                            lower[p] = g
                        if b:
                            above[b] = g
                        above[g] = p
                        g = top
                    # turn x over p
                    g = above[p]
                    if lower[g] == p:
                        lower[g] = x
                    elif upper[g] == p:
                        upper[g] = x
                    else:
                        colour[x] = colour[p]
                    above[x] = g
                    if lower[p] == x:
                        b = lower[p] = upper[x]
                        upper[x] = p
                    else:
                        b = upper[p] = lower[x]
                        lower[x] = p
                    if b:
                        above[b] = p
                    above[p] = x
                    p = g
                    if lower[p] != x and upper[p] != x:
                        break
            before = colour[x]
            if before >= 0:
                period = i - before
                reach = longest[x]
                if reach >= more * period and reach + period >= min_words:
                    ends[i - reach - period + 1, period] = i
            rest = upper[x]
            if rest:
                colour[rest] = before
            upper[x] = below
            below, x = x, above[x]
        colour[below] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def stretches(words: np.ndarray, first: np.ndarray, min_words: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretches that could hold runs begin and end; ``first`` is where each text begins."""
    if len(words) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    often = min(exponent - 1, max(min_words, exponent) - 2)
    triple = flat.mix(flat.mix(words[:-2]) + words[1:-1]) + words[2:]
    begin, end = first[:-1], first[1:]
    while True:
        long = end - begin >= max(min_words, 3)
        begin, end = begin[long], end[long]
        count = end - begin - 2
        place = flat.ragged_arange(begin, count)
        piece = np.repeat(np.arange(len(begin)), count)
        key = flat.mix(triple[place] + piece.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        sorted_ = key[order]
        opens = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(key) else np.zeros(0, np.int64)
        times = np.empty(len(key), np.int64)
        times[order] = np.repeat(np.diff(np.append(opens, len(key))), np.diff(np.append(opens, len(key))))
        good = times >= often
        if good.all():
            return begin, end
        place, piece = place[good], piece[good]
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) != 1) | (np.diff(piece) != 0)
        begin = place[new]
        end = place[np.append(new[1:], True)] + 3 if len(place) else begin


def found(words: np.ndarray, first: np.ndarray, min_words: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs as rows of start (in the flat array), length and period, and the text that each is in; sorted."""
    known: dict[bytes, list[tuple[int, int, int]]] = {}
    out = []
    for a, b in zip(*(x.tolist() for x in stretches(words, first, min_words, exponent))):
        piece = words[a:b]
        name = piece.tobytes()
        if name not in known:
            known[name] = runs(piece.tolist(), min_words, exponent)
        out += [(a + start, length, period) for start, length, period in known[name]]
    found_ = np.array(out, np.int64).reshape(-1, 3)
    found_ = found_[np.lexsort((found_[:, 2], found_[:, 0]))]
    return found_, np.searchsorted(first, found_[:, 0], "right") - 1


def _scan(text: str, kept: list[str], min_words: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            raw, at = flat.flat_bytes(rows.column(text))
            starts, ends, first = flat.word_spans(raw, at, flat.PLAIN_WORD)
            all_, row = found(flat.word_hashes(raw, starts, ends), first, min_words, exponent)
            offsets = np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32)
            gone = flat.covered(all_[:, 0] + all_[:, 2], all_[:, 0] + all_[:, 1], len(starts))
            gone_before = np.concatenate(([0], np.cumsum(gone)))
            own = all_.copy()
            own[:, 0] -= first[row]
            structs = pa.StructArray.from_arrays([pa.array(own[:, k]) for k in range(3)], names=RUN.names)
            yield pa.record_batch(
                [*(rows.column(k) for k in kept), pa.array(np.diff(first)),
                 pa.ListArray.from_arrays(pa.array(offsets), structs),
                 joined_words(raw, starts[~gone], ends[~gone], first - gone_before[first])],
                names=[*kept, "n_words", "runs", "collapsed"],
            )

    return run


def scan(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, exponent: int = EXPONENT,
) -> DataFrame:
    """Documents with ``n_words``, their ``runs`` and ``collapsed``: the words that repeat no earlier period of a run."""
    if exponent < 2 or min_words < 1:
        raise ValueError("a run repeats its period twice at least")
    rows = carried.packed(docs, key, text)
    kept = [carried.KEY, carried.TEXT, carried.REST]
    added = [T.StructField("n_words", T.LongType(), False), T.StructField("runs", T.ArrayType(RUN, False), False),
             T.StructField("collapsed", T.StringType(), False)]
    out = rows.mapInArrow(
        _scan(carried.TEXT, kept, min_words, exponent), T.StructType([*(rows.schema[c] for c in kept), *added]))
    new = [f.name for f in added if f.name not in (key, text)]
    own = carried.columns(docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in new)), key, text)
    return out.select(*own, *new)


def strongest(runs_: str = "runs"):
    """The run with the greatest exact length / period; ties by start, then period.  Null without runs.

    Quotients of whole numbers below 2**26 are equal as doubles only if they
    are equal, so a double orders them exactly.
    """
    ranked = F.transform(runs_, lambda r: F.struct(
        (-r["length"] / r["period"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(ranked)
