"""Quality rules: a decision list learned from labelled statistics, applied as one Spark expression.

``with_statistics`` measures whole texts; ``learn`` grows and prunes threshold
conjunctions one after another (sequential covering) on a bounded sample of
labelled rows; ``DecisionList.rejects`` is the ordered ``CASE WHEN`` over the
statistics that Spark runs on every row.

Null text has no words and all counts are 0.  A document that fails the base
rule is rejected whatever the list says.  Without usable labels (none, or all
of one kind) the list is empty and rejects nothing.  Repeated rows are judged
each by itself.  Other columns pass through; a column that has the name of the
added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfare.llm import carried, flat

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_upper", "n_digits",
    "n_marks", "n_unlike_words",
)

#: Labelled rows that the list is learned from at most, the first by a hash of their id.
SAMPLE_ROWS = 20_000

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_KINDS = {
    "n_symbols": _SYMBOL,
    "n_upper": np.array([0x41 <= b <= 0x5A for b in range(256)], np.int64),
    "n_digits": np.array([0x30 <= b <= 0x39 for b in range(256)], np.int64),
    "n_marks": np.array([b in b"!?.,;:" for b in range(256)], np.int64),
}
_NOT_CONTINUED = (np.arange(256) & 0xC0) != 0x80


def with_statistics(docs: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """Add a struct of counts over the whole text of each row."""
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, _struct_type(), False)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            counts = counts_of(rows.column(text))
            yield rows.append_column(out, pa.StructArray.from_arrays([pa.array(counts[c]) for c in COUNTS], COUNTS))

    return docs.mapInArrow(measure, schema)


def _struct_type() -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType(), False) for name in COUNTS])


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """Every count of COUNTS, for each text of a bounded array."""
    raw, at = flat.flat_bytes(texts)
    starts, ends, first = flat.word_spans(raw, at, flat.PLAIN_WORD)

    def per_row(places: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(places, dtype=np.int64)))
        return total[at[1:]] - total[at[:-1]]

    counts = {name: per_row(table[raw]) for name, table in _KINDS.items()}
    counts["n_words"] = np.diff(first)
    counts["n_chars"] = per_row(_NOT_CONTINUED[raw])
    counts["word_chars"] = per_row(_NOT_CONTINUED[raw] & flat.PLAIN_WORD[raw])
    row_of = np.repeat(np.arange(len(texts)), counts["n_words"])
    words = flat.word_hashes(raw, starts, ends)
    counts["n_unlike_words"] = _unlike(words, row_of, len(texts))
    counts["n_repeat_words"] = _in_repeated_windows(words, row_of, len(texts), 3)
    lines = [_line_counts(t) for t in pc.fill_null(texts, "").to_pylist()]
    counts["n_lines"], counts["n_dup_lines"] = (np.array([x[i] for x in lines], np.int64) for i in (0, 1))
    return counts


def _line_counts(text: str) -> tuple[int, int]:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def _in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return flat.mix(hashes + rows.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def _unlike(words: np.ndarray, row_of: np.ndarray, n: int) -> np.ndarray:
    _, where = np.unique(_in_row(words, row_of), return_index=True)
    return np.bincount(row_of[where], minlength=n).astype(np.int64)


def _in_repeated_windows(words: np.ndarray, row_of: np.ndarray, n: int, length: int) -> np.ndarray:
    """For each row, its words inside a window of so many words that the row has at least twice."""
    keys = flat.Windows(words).all(length)
    if not len(keys):
        return np.zeros(n, np.int64)
    whole = row_of[: len(keys)] == row_of[length - 1 :]
    starts = np.flatnonzero(whole)
    _, back, times = np.unique(_in_row(keys[starts], row_of[starts]), return_inverse=True, return_counts=True)
    starts = starts[times[back] > 1]
    hit = flat.covered(starts, starts + length, len(words))
    return np.bincount(row_of[hit], minlength=n).astype(np.int64)


def features(statistics: str = "statistics") -> dict[str, Column]:
    """The measures that conditions are about, each a double."""
    c = {name: F.col(f"{statistics}.{name}").cast("double") for name in COUNTS}
    one = F.lit(1.0)
    words, chars, lines = (F.greatest(c[name], one) for name in ("n_words", "n_chars", "n_lines"))
    return {
        "words": c["n_words"],
        "word_length": c["word_chars"] / words,
        "symbols_per_word": c["n_symbols"] / words,
        "duplicate_lines": c["n_dup_lines"] / lines,
        "repeated_words": c["n_repeat_words"] / words,
        "words_per_line": c["n_words"] / lines,
        "upper_share": c["n_upper"] / chars,
        "digit_share": c["n_digits"] / chars,
        "marks_per_word": c["n_marks"] / words,
        "unlike_words": c["n_unlike_words"] / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        x = values[self.feature]
        return x >= self.threshold if self.above else x <= self.threshold

    def column(self, measures: dict[str, Column]) -> Column:
        x = measures[self.feature]
        return x >= F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


@dataclass(frozen=True)
class DecisionList:
    """The first rule whose conditions all hold rejects a row; a row that meets none is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def rejecting_rule(self, statistics: str = "statistics") -> Column:
        """Number of the first rule that rejects the row, from 1; 0 if none does."""
        measures = features(statistics)
        found = None
        for number, rule in enumerate(self.rules, 1):
            every = F.lit(True)
            for condition in rule:
                every = every & condition.column(measures)
            found = F.when(every, number) if found is None else found.when(every, number)
        return F.lit(0) if found is None else found.otherwise(0)

    def rejects(self, statistics: str = "statistics") -> Column:
        return self.rejecting_rule(statistics) > 0


def cover(
    values: dict[str, np.ndarray], bad: np.ndarray, *, min_precision: float = 0.9, min_rows: int = 5,
    max_rules: int = 16, max_conditions: int = 4, thresholds: int = 64,
) -> DecisionList:
    """Sequential covering: grow a conjunction on two thirds of the rows, prune it on the rest, take away what it covers."""
    n = len(bad)
    growing = np.arange(n) % 3 != 2
    left = np.ones(n, bool)
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < max_rules and (left & bad & growing).sum() >= min_rows:
        rule = _grow(values, bad, left & growing, max_conditions, thresholds)
        rule = _prune(rule, values, bad, left & ~growing)
        hit = _matches(rule, values, left)
        if not rule or (hit & bad).sum() < min_rows or (hit & bad).sum() < min_precision * hit.sum():
            break
        rules.append(tuple(rule))
        left &= ~hit
    return DecisionList(tuple(rules))


def _matches(rule: list[Condition], values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
    hit = among.copy()
    for condition in rule:
        hit &= condition.holds(values)
    return hit


def _grow(values, bad, among, max_conditions: int, thresholds: int) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < max_conditions and (among & ~bad).any():
        best, gain = None, 1e-9
        positive, total = (among & bad).sum(), among.sum()
        before = np.log2(positive / total) if positive else 0.0
        for name, x in values.items():
            cuts = np.unique(np.quantile(x[among & bad], np.linspace(0, 1, thresholds))) if positive else ()
            for cut in cuts:
                for above in (True, False):
                    hit = among & (x >= cut if above else x <= cut)
                    p = (hit & bad).sum()
                    if not p or hit.sum() == total:
                        continue
                    g = p * (np.log2(p / hit.sum()) - before)
                    if g > gain:
                        best, gain = Condition(name, above, float(cut)), g
        if best is None:
            break
        rule.append(best)
        among = among & best.holds(values)
    return rule


def _prune(rule, values, bad, among) -> list[Condition]:
    """Cut conditions off the end while the rest is worth no less on rows that it wasn't grown on."""

    def worth(part: list[Condition]) -> float:
        hit = _matches(part, values, among)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for keep in range(len(rule) - 1, 0, -1):
        if worth(rule[:keep]) >= worth(best):
            best = rule[:keep]
    return best


def learn(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, **options,
) -> DecisionList:
    """Learn a list that finds rows labelled 0, from at most ``sample_rows`` labelled rows."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    marked = marked.select(key, F.col(label).alias("_label")).dropDuplicates()
    # A row limit is the documented bound of the sample; the ids alone are broadcast.
    sample = marked.orderBy(F.xxhash64(key), F.col(key), "_label").limit(sample_rows)
    rows = docs.select(key, text).join(F.broadcast(sample), key)
    measured = with_statistics(rows, text, "_statistics").select(
        F.col(key).alias("_key"), "_label", *(x.alias(name) for name, x in features("_statistics").items())
    )
    # As many rows as labels at most, also if ids repeat among the documents.
    learned = measured.orderBy(F.xxhash64("_key"), *measured.columns).limit(sample_rows).toPandas()
    names = list(features())
    return cover({n: learned[n].to_numpy() for n in names}, learned["_label"].to_numpy() == 0, **options)


def base_failed(statistics: str = "statistics") -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    words, repeated = F.col(f"{statistics}.n_words"), F.col(f"{statistics}.n_repeat_words")
    return (words < 50) | (100 * repeated > 50 * words)


def judge(docs: DataFrame, decisions: DecisionList, text: str = "text", out: str = "statistics") -> DataFrame:
    """Documents with their statistics, ``base_failed``, the rule that rejects them, and ``kept``."""
    judged = with_statistics(docs.drop("base_failed", "rejecting_rule", "kept"), text, out)
    return (
        judged.withColumn("base_failed", base_failed(out))
        .withColumn("rejecting_rule", decisions.rejecting_rule(out))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rejecting_rule") == 0))
    )


def keep(docs: DataFrame, decisions: DecisionList, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that neither the base rule nor the list rejects, with their own columns."""
    judged = judge(carried.packed(docs, key, text), decisions, text=carried.TEXT)
    return carried.unpacked(judged.where("kept"), docs, key, text)
