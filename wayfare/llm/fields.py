"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad.  Its measures and those of the lines before and
after it speak for its own label, and each label for that of the next line.
The field is fitted to a sample of labelled documents, whose lines take the
document's label, whole and however long: tasks measure the sample's lines once
and add up every round's gradients, each document counting the same, so the
driver sees labels and gradients but no text.  A document's score is the mean of its lines'
forward-backward marginals, weighted by their lengths, put on the scale of the
labels by a logistic curve over held-out sample documents.

Scores depend on the text alone.  A null or empty text is one empty line, and
so has a score.  Without labels of both kinds every score is 0.5.  Repeated
rows have equal scores; other columns pass through, and a column named like
the added one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfare.llm import flat
from wayfare.scratch import fresh_path

#: Labelled documents that the field is fitted to at most, the first by a hash of their id.
SAMPLE_DOCUMENTS = 4000

#: Lines that follow one another in one pass; longer texts are passed in stretches, side by side.
STRETCH = 512

#: Measures of the sample's lines that a task has in memory, in bytes; one longer text is taken alone.
MEASURED_BYTES = 4 << 20

ROUNDS = 60
PENALTY = 1e-3

_COUNTED = np.zeros((7, 256), np.int64)
_COUNTED[0, 0x41:0x5B] = 1  # upper case
_COUNTED[1, 0x30:0x3A] = 1  # digits
_COUNTED[2, list(b"#*$%&|<>")] = 1
_COUNTED[3, list(b"!?.,;:'\"-()")] = 1
_COUNTED[4, list(b" \t\v\f\r")] = 1
_COUNTED[5, list(b"!")] = 1
_COUNTED[6] = (np.arange(256) & 0xC0) != 0x80  # characters

MEASURES = 12


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures of every line, the number of each text's first line (one more at the end), and line lengths."""
    raw, at = flat.flat_bytes(texts)
    breaks = raw == 0x0A
    # a line ends at a line feed or at the end of its text; every text has a last line
    feeds = np.flatnonzero(breaks)
    feed_row = np.searchsorted(at, feeds, "right") - 1
    per_row = np.bincount(feed_row, minlength=len(texts)) + 1
    first = np.concatenate(([0], np.cumsum(per_row)))
    row = np.repeat(np.arange(len(texts)), per_row)
    ends = np.empty(len(row), np.int64)
    last = first[1:] - 1
    inner = np.ones(len(row), bool)
    inner[last] = False
    ends[inner], ends[last] = feeds, at[1:]
    starts = np.empty(len(row), np.int64)
    starts[first[:-1]] = at[:-1]
    later = np.ones(len(row), bool)
    later[first[:-1]] = False
    starts[later] = ends[np.flatnonzero(later) - 1] + 1

    def counted(table: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(table[raw])))
        return (total[ends] - total[starts]).astype(np.float64)

    upper, digits, symbols, marks, spaces, bangs, chars = (counted(t) for t in _COUNTED)
    length = (ends - starts).astype(np.float64)
    word_starts, word_ends, _ = flat.word_spans(raw, at, flat.PLAIN_WORD)
    words = (np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)).astype(np.float64)
    whole = flat.Windows(flat.BYTE_VALUES[raw]).of(starts, ends) if len(raw) else np.zeros(len(row), np.uint64)
    hashes = flat.word_hashes(raw, word_starts, word_ends)
    some, many = np.maximum(chars, 1), np.maximum(words, 1)
    repeated = _met_before(hashes, word_starts, at, 3)
    seen = np.concatenate(([0], np.cumsum(repeated)))
    again = (seen[np.searchsorted(word_starts, ends)] - seen[np.searchsorted(word_starts, starts)]).astype(np.float64)
    same_line = _met_before(flat.mix(whole), starts, at, 1).astype(np.float64) * (words > 0)
    measures = np.stack([
        np.log1p(chars), np.log1p(words), (chars - spaces) / many / 10, upper / some, digits / some, symbols / many,
        marks / many, bangs / many, again / many, same_line, (words == 0).astype(float), (symbols > 0).astype(float),
    ], axis=1)
    return np.clip(measures, 0, 10), first, length


def lines_in_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for any number of texts, in the memory of a few."""
    parts = [lines_of(rows.column("t")) for rows in flat.chunks(iter([pa.record_batch([texts], ["t"])]), "t", 1 << 20)]
    starts = np.cumsum([0, *(first[-1] for _, first, _ in parts)])
    first = np.concatenate([f[:-1] + start for (_, f, _), start in zip(parts, starts)] + [starts[-1:]])
    return np.concatenate([m for m, _, _ in parts]), first, np.concatenate([n for _, _, n in parts])


def _met_before(hashes: np.ndarray, starts: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """True for each item inside a run of ``length`` items that its text had earlier."""
    n = len(hashes)
    if n < length:
        return np.zeros(n, bool)
    row = np.searchsorted(at, starts, "right") - 1
    keys = flat.Windows(hashes).all(length)
    own = row[: len(keys)]
    whole = own == row[length - 1 :]
    keys = flat.mix(keys + own.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    order = np.lexsort((np.arange(len(keys)), keys))
    later = np.zeros(len(keys), bool)
    later[order[1:]] = keys[order][1:] == keys[order][:-1]
    hit = np.flatnonzero(later & whole)
    return flat.covered(hit, hit + length, n)


def neighbouring(measures: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A line's measures, those of the lines before and after it, whether it is the first or last, and 1."""
    n = len(measures)
    opening, closing = np.zeros(n, bool), np.zeros(n, bool)
    opening[first[:-1]] = closing[first[1:] - 1] = True
    before, after = np.zeros_like(measures), np.zeros_like(measures)
    before[1:], after[:-1] = measures[:-1], measures[1:]
    before[opening], after[closing] = 0, 0
    return np.concatenate([measures, before, after, opening[:, None], closing[:, None], np.ones((n, 1))], axis=1)


def _steps(first: np.ndarray) -> list[np.ndarray]:
    """Lines that are first in their texts, second, and so on; long texts last longest."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    starts = first[:-1][order]
    return [starts[: np.searchsorted(-falling, -step, "left")] + step for step in range(falling[0] if len(falling) else 0)]


def _stretches(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each stretch of a text starts, and the number of each text's first stretch (one more at the ends)."""
    counts = -(-np.diff(first) // STRETCH)
    starts = np.repeat(first[:-1], counts) + STRETCH * flat.ragged_arange(np.zeros_like(counts), counts)
    return np.append(starts, first[-1]), np.concatenate(([0], np.cumsum(counts)))


def _transfers(own: np.ndarray, links: np.ndarray, starts: np.ndarray, sizes: np.ndarray, opening: np.ndarray) -> np.ndarray:
    """For each stretch, log weights from the label of the line before it to the label of its last line.

    A text's first stretch has no line before it; it is as if that line were bad and linked to nothing.
    """
    out = own[starts][:, None, :] + np.where(opening[:, None, None], np.array([[0, 0], [-np.inf, -np.inf]]), links)
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order]
    for step in range(1, falling[0] if len(falling) else 0):
        which = order[: np.searchsorted(-falling, -step, "left")]
        before = out[which]
        out[which] = own[starts[which] + step][:, None, :] + np.logaddexp(
            before[:, :, :1] + links[0], before[:, :, 1:] + links[1])
    return out


def _messages(own: np.ndarray, links: np.ndarray, cut: np.ndarray, of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each stretch hears from the last line before it, and its last line from the stretches behind it."""
    n = len(cut) - 1
    counts = np.diff(of_text)
    split = np.flatnonzero(np.repeat(counts > 1, counts))
    opening = np.zeros(n, bool)
    opening[of_text[:-1]] = True
    across = np.zeros((n, 2, 2))
    across[split] = _transfers(own, links, cut[split], np.diff(cut)[split], opening[split])
    heard, after = np.zeros((n, 2)), np.zeros((n, 2))
    heard[opening] = 0, -np.inf
    turns = _steps(of_text)
    for which in turns[1:]:
        before = heard[which - 1][:, :, None] + across[which - 1]
        heard[which] = np.logaddexp(before[:, 0], before[:, 1])
    for which in reversed(turns[1:]):
        behind = across[which] + after[which][:, None, :]
        after[which - 1] = np.logaddexp(behind[:, :, 0], behind[:, :, 1])
    return heard, after


def _passes(energy: np.ndarray, links: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of good, of each line's label and the one before (zeros for first lines), and each text's log-partition."""
    cut, of_text = _stretches(first)
    steps = _steps(cut)
    own = np.stack([np.zeros(len(energy)), energy], axis=1)
    ahead, behind = np.zeros_like(own), np.zeros_like(own)
    heard, after = _messages(own, links, cut, of_text)
    later = np.ones(len(cut) - 1, bool)
    later[of_text[:-1]] = False
    for number, lines in enumerate(steps):
        ahead[lines] = own[lines]
        if number:
            ahead[lines] += np.logaddexp(ahead[lines - 1, 0][:, None] + links[0], ahead[lines - 1, 1][:, None] + links[1])
        else:
            ahead[cut[:-1][later]] += np.logaddexp(heard[later, :1] + links[0], heard[later, 1:] + links[1])
    behind[cut[1:] - 1] = after
    for lines in reversed(steps[1:]):
        message = behind[lines] + own[lines]
        behind[lines - 1] = np.logaddexp(message[:, 0][:, None] + links[:, 0], message[:, 1][:, None] + links[:, 1])
    last = first[1:] - 1
    total = np.logaddexp(ahead[last, 0], ahead[last, 1])
    per_line = np.repeat(total, np.diff(first))
    marginal = np.exp(ahead[:, 1] + behind[:, 1] - per_line)
    inner = np.ones(len(energy), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    message = behind[at] + own[at]
    pairs = np.zeros((len(energy), 2, 2))
    pairs[at] = np.exp(ahead[at - 1][:, :, None] + links + message[:, None, :] - per_line[at][:, None, None])
    return marginal, pairs, total


def forward_backward(energy: np.ndarray, links: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of good, expected pairs of neighbouring labels over all texts, and the log-partition of each text.

    ``energy`` is what speaks for good over bad for each line, ``links`` the
    2 x 2 weights of neighbouring labels.
    """
    marginal, pairs, total = _passes(energy, links, first)
    return marginal, pairs.sum(axis=0), total


@dataclass(frozen=True)
class Field:
    """Weights of a fitted field, and the curve from marginals to scores."""

    weights: np.ndarray
    links: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    slope: float
    shift: float

    def raw_scores(self, texts: pa.Array) -> np.ndarray:
        """Length-weighted mean of the marginals, as log odds."""
        return self.raw_scores_of(*lines_in_chunks(texts))

    def raw_scores_of(self, measures: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        lines = (neighbouring(measures, first) - self.centre) / self.spread
        marginal, _, _ = _passes(lines @ self.weights, self.links, first)
        weight = length + 1
        total = np.concatenate(([0], np.cumsum(weight * marginal)))
        sizes = np.concatenate(([0], np.cumsum(weight)))
        mean = (total[first[1:]] - total[first[:-1]]) / (sizes[first[1:]] - sizes[first[:-1]])
        mean = np.clip(mean, 1e-9, 1 - 1e-9)
        return np.log(mean) - np.log1p(-mean)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.raw_scores(texts) + self.shift)))


#: From the measures of some texts' lines, their first lines and line lengths: one row of numbers for each text.
PerText = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over each text's lines."""
    return np.add.reduceat(values.reshape(len(values), -1), first[:-1], axis=0)


def fit(texts: pa.Array, labels: np.ndarray) -> Field | None:
    """A field for documents labelled 0 or 1; None if only one label occurs."""
    fitted = parts(labels)
    if fitted is None:
        return None
    measured = lines_in_chunks(texts)
    return learn(lambda work: work(*measured), labels, fitted.astype(int), (~fitted).astype(int))


def parts(labels: np.ndarray) -> np.ndarray | None:
    """True for the documents that weights are fitted to; the others set the curve.  None if only one label occurs."""
    if len(set(labels.tolist())) < 2:
        return None
    fitted = np.arange(len(labels)) % 5 != 0
    if len(set(labels[fitted].tolist())) < 2 or len(set(labels[~fitted].tolist())) < 2:
        fitted = np.ones(len(labels), bool)
    return fitted


def learn(over: Callable[[PerText], np.ndarray], labels: np.ndarray, fitted: np.ndarray, held: np.ndarray) -> Field:
    """The field of texts that ``over`` passes to a function, given each text's label and copies in either part."""
    def means(measures, first, length):
        sizes = np.diff(first)
        return np.column_stack([per_text(neighbouring(measures, first), first) / sizes[:, None], sizes])

    def squares(measures, first, length):
        return per_text((neighbouring(measures, first) - centre) ** 2, first) / np.diff(first)[:, None]

    # every document counts the same, however many lines it has
    share = fitted / fitted.sum()
    own, sizes = np.split(over(means), [-1], axis=1)
    centre = share @ own
    spread = np.sqrt(share @ over(squares)) + 1e-6
    centre[-1], spread[-1] = 0, 1
    weights, links = np.zeros(len(centre)), np.zeros((2, 2))
    same = np.zeros((2, 2))
    pairs_of = (sizes[:, 0] - 1) / sizes[:, 0] * share
    same[1, 1], same[0, 0] = pairs_of @ labels, pairs_of @ (1 - labels)
    wanted = (share * labels) @ ((own - centre) / spread)

    def expected(measures, first, length):
        """Means over each text of its lines times their marginals, of the marginals, and of its pairs."""
        lines, slopes = neighbouring(measures, first), weights / spread
        marginal, pairs, _ = _passes(lines @ slopes - centre @ slopes, links, first)
        met = np.stack([marginal[a:b] @ lines[a:b] for a, b in zip(first[:-1], first[1:])])
        return np.concatenate([met, per_text(marginal, first), per_text(pairs, first)], axis=1) / np.diff(first)[:, None]

    # gradient steps with momentum per weight (Adam)
    state = np.zeros((2, len(weights) + 4))
    for step in range(1, ROUNDS + 1):
        met, marginal, pairs = np.split(over(expected), [len(weights), len(weights) + 1], axis=1)
        gradient = np.concatenate([
            wanted - share @ ((met - marginal * centre) / spread) - PENALTY * weights,
            same.ravel() - share @ pairs - PENALTY * links.ravel(),
        ])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights, links = weights + move[:-4], links + move[-4:].reshape(2, 2)
    field = Field(weights, links, centre, spread, 1.0, 0.0)
    raw = over(lambda *measured: field.raw_scores_of(*measured)[:, None])[:, 0]
    counted = held if held.any() else fitted
    slope, shift = _curve(np.repeat(raw, counted), np.repeat(labels, counted).astype(float))
    return Field(weights, links, centre, spread, slope, shift)


def _curve(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the labels, by Newton steps with a small penalty."""
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    beta = np.array([0.1, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curvature, x.T @ (labels - p) - 1e-2 * beta), -1, 1)
    return max(float(beta[0]), 1e-3), float(beta[1])


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the id as text, modulo 5, is 0.  Not so without an id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> Field | None:
    """Fit a field to at most ``sample_documents`` labelled documents that aren't held out."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    marked = marked.select(key, F.col(label).alias("_label")).dropDuplicates()
    sample = marked.orderBy(F.xxhash64(key), F.col(key), "_label").limit(sample_documents)
    # Ids may repeat among the documents: the bound holds for rows again.
    known = docs.select(key, F.xxhash64(text).alias("_hash")).join(F.broadcast(sample), key)
    known = known.orderBy(F.xxhash64(key), key, "_label", "_hash").limit(sample_documents)
    rows = known.select(F.col(key).alias("_key"), "_label", "_hash").toArrow().combine_chunks()
    order = np.lexsort((rows["_label"].to_numpy(), rows["_key"].to_numpy()))
    rows = rows.take(pa.array(order, pa.int64()))
    fitted = parts(rows["_label"].to_numpy())
    if fitted is None:
        return None
    # equal rows are measured once, and count as often as they occur in the sample
    rows = rows.append_column("_fitted", pa.array(fitted.astype(np.int64)))
    rows = rows.append_column("_held", pa.array((~fitted).astype(np.int64)))
    rows = rows.group_by(["_key", "_label", "_hash"], use_threads=False).aggregate([("_fitted", "sum"), ("_held", "sum")])
    numbers = rows.select(["_key", "_hash"]).append_column("_number", pa.array(np.arange(rows.num_rows)))
    return learn(
        measured_texts(docs.select(F.col(key).alias("_key"), text), numbers, text),
        rows["_label"].to_numpy(), rows["_fitted_sum"].to_numpy(), rows["_held_sum"].to_numpy(),
    )


def measured_texts(docs: DataFrame, numbers: pa.Table, text: str) -> Callable[[PerText], np.ndarray]:
    """Measures of the numbered documents, written once; what it returns runs a function over them, rows by number."""
    spark = docs.sparkSession
    docs = docs.withColumn("_hash", F.xxhash64(text))
    chosen = docs.join(F.broadcast(spark.createDataFrame(numbers)), ["_key", "_hash"])
    chosen = chosen.select("_number", text).dropDuplicates(["_number"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            measures, first, length = lines_of(rows.column(text))
            lines = np.column_stack([measures, length])
            data = [lines[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.record_batch([rows.column("_number"), pa.array(data, pa.binary())], ["_number", "_lines"])

    path = fresh_path(spark, "measured-lines")
    chosen.mapInArrow(measure, "_number long, _lines binary").write.parquet(path)
    measured = spark.read.parquet(path)

    def over(work: PerText) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in flat.chunks(batches, "_lines", MEASURED_BYTES):
                raw, at = flat.flat_bytes(rows.column("_lines"))
                lines = np.frombuffer(raw, np.float64).reshape(-1, MEASURES + 1)
                out = work(lines[:, :-1], at // (8 * (MEASURES + 1)), lines[:, -1])
                yield pa.record_batch(
                    [rows.column("_number"), pa.array(list(out), pa.list_(pa.float64()))], ["_number", "_found"])

        found = measured.mapInArrow(run, "_number long, _found array<double>").toArrow().combine_chunks()
        found = found.take(pa.array(np.argsort(found["_number"].to_numpy())))
        return found["_found"].combine_chunks().flatten().to_numpy().reshape(found.num_rows, -1)

    return over


def classify(docs: DataFrame, field: Field | None, *, text: str = "text", out: str = "score") -> DataFrame:
    """Add the score of every whole text, from 0 to 1."""
    docs = docs.drop(out)
    if field is None:
        return docs.withColumn(out, F.lit(0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in flat.chunks(batches, text):
            yield rows.append_column(out, pa.array(field.scores(rows.column(text))))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType(), False)]))
