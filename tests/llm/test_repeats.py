"""Substring and byte deduplication, decontamination and near duplicates against brute force."""

import random

import pytest

from tests.llm import brute
from tests.llm.brute import in_order
from wayfare.llm import contamination, near, queries, rules, substrings, suffixes

SMALL = "/root/testdata/sf0.001"
ODD = [(None, "a b c"), (0, None), (1, ""), (2, "a"), (3, " \n\t")]


def patchwork(seed, words, joined):
    """Texts of repeated and random pieces, repeated ids, null ids and repeated rows."""
    draw = random.Random(seed)

    def some(n):
        return [draw.choice("abcdefgh") + draw.choice(["", "é", "x"]) for _ in range(n)]

    pool = [some(draw.randint(3, words)) for _ in range(12)]
    rows = list(ODD)
    for i in range(4, 120):
        text = [w for _ in range(draw.randint(1, 8)) for w in (draw.choice(pool) if draw.random() < 0.7 else some(draw.randint(1, 10)))]
        rows.append((i if draw.random() < 0.9 else draw.choice([None, i - 1]), draw.choice(joined).join(text)))
    return rows + rows[20:40] + [(500, " ".join(["z"] * 300)), (501, " ".join(["z"] * 120))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("length, grain", [(50, 10), (8, 2)])
def test_words_of_repeats(spark, length, grain):
    rows = patchwork(5, 40, [" ", "\n\t "])
    cut = substrings.deduplicate(frame(spark, rows), length=length, grain=grain)
    got = cut.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert in_order(got) == in_order(brute.words_removed(rows, length))


def test_cleaned_keeps_texts_that_lose_nothing(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, "one\n" + passage), (2, passage), (3, "two  " + passage + " three"), (4, "a  b\nc"), (5, None)]
    got = {r.doc_id: r.text for r in substrings.cleaned(frame(spark, rows)).collect()}
    assert got == {1: "one\n" + passage, 3: "two three", 4: "a  b\nc", 5: None}


@pytest.mark.parametrize("length, grain, group_rows", [(50, 10, 1000), (20, 6, 0), (200, 40, 1000)])
def test_bytes_of_repeats(spark, length, grain, group_rows):
    rows = patchwork(6, 40, ["", " "])
    cut = suffixes.deduplicate(frame(spark, rows), length=length, grain=grain, group_rows=group_rows)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept_bytes))) for r in cut.collect()]
    assert in_order(got) == in_order(brute.bytes_removed(rows, length))


def test_windows_of_items(spark):
    draw = random.Random(3)

    def some(n):
        return " ".join(draw.choice(["a", "B", "É", "c9"]) for _ in range(n))

    items = [(i, some(draw.choice([0, 1, 3, 10, 11, 20]))) for i in range(8)] + [(None, some(12)), (3, None), (9, some(12))]
    docs = [(i, some(draw.randint(0, 80))) for i in range(40)] + ODD
    docs += [(60, items[-1][1].upper()), (60, items[-1][1])]
    for block_bytes in (1 << 20, 40):
        benchmark = spark.createDataFrame(items, "item_id long, text string")
        scanned = contamination.scan(frame(spark, docs), benchmark, block_bytes=block_bytes)
        got = [
            (r.doc_id, r.found.n_words, sum(s.end - s.start for s in r.found.spans),
             len(ids := sorted({m.item_id for m in r.found.matches})), brute.sha(",".join(ids)), bool(r.found.spans))
            for r in scanned.collect()
        ]
        assert in_order(got) == in_order(brute.contamination(docs, items))


def test_longest_matches_and_their_places(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, "x " + " ".join(f"w{i}" for i in range(3, 18)) + " y " + " ".join(f"w{i}" for i in range(5, 30)))]
    row = contamination.scan(frame(spark, docs), spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert [tuple(m) for m in row.found.matches] == [("7", 5, 17, 25)]
    assert [tuple(s) for s in row.found.spans] == [(1, 16), (17, 42)]


def near_copies(seed):
    draw = random.Random(seed)
    base = [[draw.choice("abcdefghijklm") + str(draw.randint(0, 30)) for _ in range(draw.randint(3, 200))] for _ in range(20)]
    rows = [*ODD, (900, "x y z"), (901, "X  y\tz"), (902, "A")]
    for i in range(5, 250):
        words = list(draw.choice(base))
        for _ in range(draw.randint(0, max(1, len(words) // 25))):
            words[draw.randrange(len(words))] = draw.choice("pqr") + str(draw.randint(0, 3000))
        rows.append((i if draw.random() < 0.95 else None, " ".join(words)))
    return rows + rows[30:60]


@pytest.mark.parametrize("block", [400_000, 2_000])
def test_classes_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", block)
    rows = near_copies(3)
    found = near.classes(frame(spark, rows), shingle=4).select("doc_id", "n_shingles", "component_id")
    assert in_order(found.collect()) == in_order(brute.components(rows))


def test_one_of_each_class_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (2, text + " end"), (2, text + " end"), (3, "other words here now yes"), (4, ""), (5, None), (None, text)]
    extra = frame(spark, rows).selectExpr("*", "doc_id AS component", "text AS _task")
    kept = near.deduplicate(extra)
    assert kept.columns == extra.columns
    assert in_order((r.doc_id, r.text) for r in kept.collect()) == in_order([rows[0], *rows[3:6]])


@pytest.mark.parametrize("run", [
    lambda df, b: substrings.deduplicate(df), lambda df, b: suffixes.deduplicate(df), lambda df, b: near.classes(df),
    lambda df, b: contamination.scan(df, b), lambda df, b: contamination.scan(df, b.limit(0)),
])
def test_empty_tables(spark, run):
    empty = spark.createDataFrame([], "doc_id long, text string, n_words long, found string")
    assert run(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_filters_keep_columns_with_the_operators_names(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    names = ["_row", "_found", "kept", "n_words", "n_removed", "_owners", "component", "statistics", "_node", "_own", "rule"]
    rows = spark.createDataFrame([(1, passage), (2, "x " + passage), (3, "some other words")], "doc_id long, text string")
    rows = rows.selectExpr("'first' AS _kept", "text", "doc_id", *(f"'{n}' AS `{n}`" for n in names))
    item = spark.createDataFrame([(1, "some other words")], "item_id long, text string")
    for out, left in (
        (near.deduplicate(rows), {1: passage, 3: "some other words"}),
        (substrings.cleaned(rows), {1: passage, 2: "x", 3: "some other words"}),
        (contamination.remove_contaminated(rows, item), {1: passage, 2: "x " + passage}),
        (rules.keep(rows, rules.DecisionList(())), {1: passage, 2: "x " + passage}),
    ):
        assert out.columns == rows.columns
        got = out.collect()
        assert {r.doc_id: r.text for r in got} == left
        assert all(r[n] == n for r in got for n in names) and {r["_kept"] for r in got} == {"first"}


def test_a_document_longer_than_a_chunk(spark):
    text = " ".join(f"w{i % 5000}" for i in range(500_000))
    rows = [(1, text), (2, "w0 w1 " + " ".join(f"w{i}" for i in range(100, 200)))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substrings.deduplicate(frame(spark, rows)).collect()}
    assert got == {1: (500_000, 0), 2: (102, 100)}


def test_queries_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    wanted = {
        queries.op1_decontamination: brute.contamination(docs, items),
        queries.op2_suffix_array_dedup: brute.bytes_removed(docs),
        queries.op5_minhash_near_dedup: [(*row, row[0] == row[2]) for row in brute.components(docs)],
        queries.op10_substring_dedup: [(*row[:3], brute.sha(row[3])) for row in brute.words_removed(docs)],
    }
    for run, rows in wanted.items():
        assert in_order(run(spark, SMALL).collect()) == in_order(rows), run.__name__


def test_what_a_crowded_cluster_leaves_beside_its_largest_group_is_compared(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_SHINGLES", 1500)
    draw = random.Random(12)

    def edited(words, count):
        out = list(words)
        for i in draw.sample(range(len(out)), count):
            out[i] = f"e{draw.randrange(10**6)}"
        return " ".join(out)

    base = [f"w{draw.randrange(10**5)}" for _ in range(120)]
    half = [*base[:70], *(f"v{i}" for i in range(50))]
    rows = [(i, edited(base, 2)) for i in range(150)] + [(200 + i, edited(half, 1)) for i in range(25)]
    rows += [(300 + i, " ".join([*base[:88], *(f"u{i}_{j}" for j in range(30))])) for i in range(20)]
    draw.shuffle(rows)
    seen = []
    opposed = near._opposed
    monkeypatch.setattr(near, "_opposed", lambda rest, text: seen.append(rest.count()) or opposed(rest, text))
    # Regions count as linked as a whole, so that clusters hold texts that aren't alike.
    monkeypatch.setattr(near, "REGION", 3)
    monkeypatch.setattr(near, "DEPTH", 1)
    monkeypatch.setattr(near, "SPARSE", 2)
    docs = frame(spark, rows)
    found = near.classes(docs, shingle=4).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == sorted(brute.components(rows))
    assert seen and seen[0] > 150
