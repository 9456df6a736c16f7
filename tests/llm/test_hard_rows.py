"""Words of any length, repetitive items, clashing columns, regions and borders of the forest."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.brute import in_order
from wayfare.llm import contamination, flat, licenses, near, rules, substrings, suffixes, urls


def thue_morse(n, letters="ab"):
    """A word whose sum modulo 2**64 equals that of its complement, from 1,024 letters on."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "ba")) for n in (1024, 4096)]


@pytest.mark.parametrize("word, other", PAIRS)
def test_long_words_have_hashes_of_their_own(word, other):
    raw, at = flat.flat_bytes(pa.array([word, other, word, word.upper()]))
    starts, ends, _ = flat.word_spans(raw, at, flat.PLAIN_WORD)
    a, b, c, d = flat.word_hashes(raw, starts, ends)
    assert a != b and a == c and a != d
    a, b, c, d = flat.word_hashes(raw, starts, ends, flat.FOLDED_VALUES)
    assert a != b and a == c == d


def rows_with(word, other):
    rest = " ".join(f"w{i}" for i in range(49))
    return [(1, f"{word} {rest}"), (2, f"{other} {rest}"), (3, f"{word} {rest}"), (4, f"{word} x {other} x {word} y"),
            (5, " ".join([word, "a", "b"])), (6, " ".join([other, "a", "b"]))]


@pytest.mark.parametrize("word, other", PAIRS)
def test_operators_tell_long_words_apart(spark, word, other):
    rows = rows_with(word, other)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = substrings.deduplicate(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert in_order(cut) == in_order(brute.words_removed(rows))
    found = near.classes(docs, shingle=4).select("doc_id", "n_shingles", "component_id").collect()
    assert in_order(found) == in_order(brute.components(rows))
    for r in rules.with_statistics(docs).collect():
        s = r.statistics
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute.base_statistics(r.text)
    items = [(1, f"{word} w0 w1"), (2, f"{other} q"), (3, f"x {word} y")]
    scanned = contamination.scan(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = [(r.doc_id, r.found.n_words, sum(s.end - s.start for s in r.found.spans),
            len(ids := sorted({m.item_id for m in r.found.matches})), brute.sha(",".join(ids)), bool(r.found.spans))
           for r in scanned.collect()]
    assert in_order(got) == in_order(brute.contamination(rows, items))
    templates = (("one", f"{word} a b"), ("other", f"{other} c d"))
    texts = {r.doc_id: [m.license for m in r.licenses] for r in licenses.scan(docs, templates=templates).collect()}
    assert texts == {d: [m[0] for m in brute.licenses(t, templates)] for d, t in rows}


def test_an_item_and_a_text_of_one_repeated_word(spark):
    items = [(1, "a " * 200), (2, "a " * 12 + "b"), (3, "a a a")]
    rows = [(1, "a " * 60_000), (2, "a " * 150), (3, "c " + "a " * 20 + "b"), (4, "a a b"), (5, "a a a"), (6, "a " * 9)]
    scanned = contamination.scan(
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.doc_id: {(m.item_id, m.length, m.word, m.item_word) for m in r.found.matches} for r in scanned}
    assert got[1] == {("1", 200, 0, 0), ("2", 12, 0, 0), ("3", 3, 0, 0)}
    assert got[2] == {("1", 150, 0, 0), ("2", 12, 0, 0), ("3", 3, 0, 0)}
    assert got[3] == {("1", 20, 1, 0), ("2", 13, 9, 0), ("3", 3, 1, 0)}
    assert got[4] == set() and got[5] == {("3", 3, 0, 0)} and got[6] == {("3", 3, 0, 0)}
    assert {r.doc_id: sum(s.end - s.start for s in r.found.spans) for r in scanned} == {1: 60_000, 2: 150, 3: 21, 4: 0, 5: 3, 6: 9}


def test_repeated_items_are_one(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "two three")] * 500 + [(8, "two three")] * 3, "item_id long, text string")
    for block in (1 << 20, 10):
        row = contamination.scan(docs, items, block_bytes=block).first()
        assert sorted(m.item_id for m in row.found.matches) == ["7", "8"]


CLASH = ["_row", "_copy", "_owners", "_asked", "_text", "_rule", "_url", "_guess", "_key", "_rest", "_kept"]


@pytest.mark.parametrize("run", [
    substrings.deduplicate, suffixes.deduplicate,
    lambda docs: urls.judge(docs.withColumn("url", F.concat(F.lit("http://a.org/"), "doc_id")), [urls.Rule("org/", "allow")]),
])
def test_columns_named_like_the_operators_own_pass_through(spark, run):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string")
    docs = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASH))
    out = run(docs)
    assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    for r in out.collect():
        assert all(r[c] == f"{c}{r.doc_id}" for c in CLASH)


def sorted_region_rows(draw, n, groups):
    """Rows of one sorted partition: an order value, a name and a byte of every signature value."""
    out = []
    for i in range(n):
        order = bytes([0]) + b"".join(draw.choice(groups).to_bytes(4, "big") for _ in range(near.SORTED))
        low = draw.choice([b"\1", b"\2", b"\3"]) * 24 + bytes(draw.choice([1, 2]) for _ in range(24))
        out.append((order, i.to_bytes(16, "big"), low))
    return sorted(out)


@pytest.mark.parametrize("size", [1, 7, 1000])
@pytest.mark.parametrize("region, sparse", [(2048, 64), (20, 5), (6, 3)])
def test_no_pair_of_a_region_is_lost(monkeypatch, size, region, sparse):
    monkeypatch.setattr(near, "REGION", region)
    monkeypatch.setattr(near, "SPARSE", sparse)
    for seed in range(6):
        draw = random.Random(seed)
        rows = sorted_region_rows(draw, 300, range(1, draw.choice([2, 3, 5])))
        borders = sorted(draw.sample(range(300), 2))
        links = []
        for part in (rows[: borders[0]], rows[borders[0] : borders[1]], rows[borders[1] :]):
            batches = [pa.record_batch([pa.array(c, pa.binary()) for c in zip(*part[k : k + size])], names=["_order", "_node", "_low"])
                       for k in range(0, len(part), size)]
            for out in near._regions(iter(batches)):
                links += zip(out.column("head").to_pylist(), out.column("node").to_pylist())
        assert len(links) <= 2 * len(rows)
        cluster = {}

        def root(x):
            while cluster.setdefault(x, x) != x:
                x = cluster[x]
            return x

        for a, b in links:
            cluster[root(a)] = root(b)
        by_prefix = defaultdict(list)
        for order, node, low in rows:
            by_prefix[order[: 1 + 4 * near.DEPTH]].append((node, np.frombuffer(low, np.uint8)))
        for members in by_prefix.values():
            for i, (a, x) in enumerate(members):
                for b, y in members[:i]:
                    assert (x == y).sum() < near.AGREEING or root(a) == root(b)


def test_large_group_of_near_copies_at_the_threshold(spark, monkeypatch):
    """Texts that agree with a few others at about 0.8, in regions larger than are searched."""
    monkeypatch.setattr(near, "REACH", 1)
    draw, words = random.Random(9), [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        text = list(words)
        for k in range(draw.choice([1, 2, 2])):
            text[draw.randrange(60)] = f"n{i}-{k}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = near.classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert in_order(found) == in_order(brute.components(rows, size=5))


def test_pipeline_stages_on_empty_and_null_tables(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0)], docs.schema)
    for table in (docs.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, table, small).columns == docs.columns, name
            stage(spark, table, small).collect()
        assert corpus_pipeline.STAGES[-1][1](spark, table, small).count() == table.count()
