"""Periodic runs, fill-in-the-middle texts and shards against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import PLAIN, in_order, sha
from wayfare.llm import middles, periodic, queries, shards

SMALL = "/root/testdata/sf0.001"
ODD = [(None, "a b c\nd"), (0, None), (1, ""), (2, "a"), (3, " \n\t\n"), (4, "x " * 40), (4, "x " * 40), (5, "é\n" * 9 + "ü")]


def runs(words, min_words=6, exponent=4):
    out = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            inside = any(s <= start and s + n >= start + length and not q % p for s, n, p in out)
            if length >= max(min_words, exponent * q) and not inside:
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(draw):
    words = [draw.choice("abcde"[: draw.choice([1, 2, 3, 5])]) for _ in range(draw.randint(0, 60))]
    if words and draw.random() < 0.6:
        a = draw.randrange(len(words))
        p = 1 + draw.randrange(max(1, (len(words) - a) // 3 + 1))
        for i in range(a + p, len(words)):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("min_words, exponent", [(6, 4), (4, 2), (8, 3)])
def test_runs_equal_brute_force(min_words, exponent):
    draw = random.Random(exponent)
    texts = [periodic_words(draw) for _ in range(600)]
    for words in texts:
        numbers = [ord(w) for w in words]
        assert periodic.runs(numbers, min_words, exponent) == runs(words, min_words, exponent), words
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    flat = np.array([ord(w) for t in texts for w in t], np.uint64)
    found, row = periodic.found(flat, first, min_words, exponent)
    got = defaultdict(list)
    for (start, length, period), i in zip(found.tolist(), row.tolist()):
        got[i].append((start - first[i], length, period))
    assert all(got[i] == runs(t, min_words, exponent) for i, t in enumerate(texts))


def test_long_periodic_texts():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 3000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for text in ("a" * 5000, "abcab" * 700, fibonacci[-1], "".join(c * 7 for c in "abcdefgh" * 40)):
        numbers = [ord(c) for c in text]
        for exponent in (2, 4):
            assert periodic.runs(numbers, 6, exponent) == runs(text, 6, exponent)


def run_row(doc, text, planted):
    words = PLAIN.findall(text or "")
    h = zlib.crc32(("" if doc is None else str(doc)).encode())
    if planted and doc is not None and h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(len(words))]
    found = runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    start, length, period = best or (None,) * 3
    milli = 1000 * length // period if best else None
    return doc, len(found), start, length, period, milli, sha(listed), sha(kept)


def test_run_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, SMALL).collect()]
    assert in_order(got) == in_order(run_row(d, t, True) for d, t in rows)
    assert any(r[1] for r in got)


def test_runs_of_odd_rows(spark):
    rows = [*ODD, (9, " ".join(str(i % 3) for i in range(40_000)))]
    docs = spark.createDataFrame([(d, t, 1, "own") for d, t in rows], "doc_id long, text string, runs int, _key string")
    out = periodic.scan(docs).withColumn("best", periodic.strongest())
    assert out.columns[:3] == ["doc_id", "text", "_key"] and out.where("_key = 'own'").count() == len(rows)
    got = [(r.doc_id, [tuple(x) for x in r.runs], sha(r.collapsed)) for r in out.collect()]
    wanted = [(d, runs(w) if len(w) < 100 else [(0, 40_000, 3)], run_row(d, t, False)[-1] if len(w) < 100 else sha("0 1 2"))
              for d, t in rows for w in [PLAIN.findall(t or "")]]
    assert in_order(got) == in_order(wanted)
    assert periodic.scan(docs.limit(0)).count() == 0


def cut_row(doc, text, unit, fim_percent=100, spm_percent=50, seed=7):
    text = text or ""
    units = {"lines": re.findall(r"[^\n]*\n|[^\n]+", text), "characters": list(text), "bytes": list(text.encode())}[unit]
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return doc, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if unit == "bytes":
        raw = text.encode()
        a, b = (next(k for k in range(x, -1, -1) if k == len(raw) or raw[k] & 0xC0 != 0x80) for x in (a, b))
        prefix, middle, suffix = (x.decode() for x in (raw[:a], raw[a:b], raw[b:]))
    else:
        prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = h[3] % 100 < spm_percent
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc, n, "spm" if spm else "psm", len(prefix), len(middle), out


MIXED = ODD + [(i, "".join(random.Random(i).choice("ab\né漢𝄞< PSM>") for _ in range(i))) for i in range(6, 80)] + [
    (90, "a <P> b"), (91, "<M>"), (92, "\n"), (93, "one\n\n\ntwo"), (94, "<<S\n>P>" * 5), (95, "漢" * 30_000 + "\n" + "a" * 30_000)]


@pytest.mark.parametrize("unit", middles.UNITS)
@pytest.mark.parametrize("fim_percent", [100, 60])
def test_cuts_equal_brute_force(spark, unit, fim_percent):
    docs = spark.createDataFrame([(d, t, "x", 5) for d, t in MIXED], "doc_id long, text string, _rest string, form int")
    out = middles.transform(docs.repartition(3), unit=unit, fim_percent=fim_percent)
    assert out.columns[:3] == ["doc_id", "text", "_rest"] and out.columns.count("form") == 1
    out = out.withColumn("restored", middles.restored(F.col("fim_text"), F.col("form"))).collect()
    got = [(r.doc_id, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.fim_text) for r in out]
    assert in_order(got) == in_order(cut_row(d, t, unit, fim_percent) for d, t in MIXED)
    assert all(r.restored == (r.text or "") for r in out)


def test_cut_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    wanted = [(*(c := cut_row(d, t, "lines"))[:5], sha(c[5]), sha(t or "")) for d, t in rows]
    assert in_order(queries.op12_fill_in_middle(spark, SMALL).collect()) == in_order(wanted)


def test_cuts_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert middles.transform(docs).count() == 0
    with pytest.raises(ValueError):
        middles.transform(docs, unit="words")


def placed(spark, rows, n, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out, slots = shards.assign(shards.measured(docs), n, **options)
    return out.collect(), slots


def check_places(got, n):
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(n))
    sizes = Counter({i: 0 for i in range(n)})
    for r in got:
        sizes[r.shard] += r.size
    return sizes


def test_shards_are_near_equal_in_bytes(spark):
    draw = random.Random(4)
    rows = [(i, "w" * draw.randint(0, 400)) for i in range(3000)]
    rows += [(None, None)] * 700 + [(7, "the same row")] * 900 + [(i, "the same text") for i in range(5000, 5600)]
    got, _ = placed(spark, rows, 24)
    sizes = check_places(got, 24)
    assert max(sizes.values()) <= 1.01 * min(sizes.values())
    assert in_order((r.doc_id, r.text, r.size, r.text_crc32) for r in got) == in_order(
        (d, t, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)


def test_one_record_keeps_its_slot(spark):
    rows = [(i, "t" * (i % 50)) for i in range(500)]
    first = {r.doc_id: r.virtual_slot for r in placed(spark, rows, 5)[0]}
    more = {r.doc_id: r.virtual_slot for r in placed(spark, rows + [(i, "more") for i in range(500, 900)], 9)[0]}
    assert all(more[d] == s for d, s in first.items())


def test_rebalancing_moves_what_it_must(spark, tmp_path):
    rows = [(i, "t" * (i % 90)) for i in range(4000)]
    path = str(tmp_path / "maps")
    got, slots = placed(spark, rows, 8)
    shards.save_map(slots, path, 1)
    old = {r.doc_id: r.shard for r in got}
    got, slots = placed(spark, rows, 9, known=shards.load_map(spark, path))
    shards.save_map(slots, path, 2)
    sizes = check_places(got, 9)
    assert max(sizes.values()) <= 1.02 * min(sizes.values())
    moved = sum(r.size for r in got if r.shard != old[r.doc_id])
    assert moved < 0.16 * sum(sizes.values())
    got, _ = placed(spark, rows, 7, known=shards.load_map(spark, path, 1))
    sizes = check_places(got, 7)
    assert max(sizes.values()) <= 1.02 * min(sizes.values())
    assert sum(r.size for r in got if r.shard != old[r.doc_id]) < 0.2 * sum(sizes.values())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        shards.save_map(slots, path, 2)
    assert shards.load_map(spark, path).agg(F.max("shard")).first()[0] == 8


def test_shards_of_nothing_and_clashing_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", "a", 5, 6) for i in range(50)], "doc_id long, text string, _row string, slot int, _n int")
    out, _ = shards.assign(shards.measured(docs), 3)
    assert out.columns == ["doc_id", "text", "_row", "_n", "size", "text_crc32", "virtual_slot", "shard", "slot"]
    check_places(out.collect(), 3)
    shards.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 50
    out, slots = shards.assign(shards.measured(docs.limit(0)), 3)
    assert out.count() == 0 and slots.count() == 0


def test_shard_query(spark):
    got = queries.op13_sharding(spark, SMALL).collect()
    check_places(got, 24)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sorted(texts) == sorted(r.doc_id for r in got)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
