"""Quality rules and scores, tokens, licenses and chats."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.brute import in_order
from wayfare.llm import chat, fields, licenses, pieces, queries, rules

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n\n", "a", "a b c a b c a b c", "x\nx\n x\nx", "É É", "\x00 \x0b", "#|<>", "w " * 5000]


def documents(spark, sf_dir=SMALL):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


# Quality rules


def test_base_statistics(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = {r.doc_id: r.statistics for r in rules.with_statistics(df.withColumn("statistics", F.lit(1))).collect()}
    for i, text in enumerate(ODD):
        s = got[i]
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute.base_statistics(text), text


def test_list_finds_a_conjunction():
    draw = np.random.default_rng(1)
    values = {"a": draw.random(3000), "b": draw.random(3000), "c": draw.random(3000)}
    bad = (values["a"] > 0.7) & (values["b"] < 0.4)
    found = rules.cover(values, bad)
    hit = np.zeros(3000, bool)
    for rule in found.rules:
        one = np.ones(3000, bool)
        for condition in rule:
            one &= condition.holds(values)
        hit |= one
    assert (hit & bad).sum() > 0.95 * bad.sum() and (hit & ~bad).sum() < 0.05 * hit.sum()


def test_rules_without_labels_reject_nothing(spark):
    docs = spark.createDataFrame([(i, "word " * 60 + str(i)) for i in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.learn(docs, labels).rules == ()
    same = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert rules.learn(docs, same).rules == ()
    assert rules.judge(docs.limit(0), rules.DecisionList(())).count() == 0


def test_quality_query(spark):
    docs = documents(spark)
    got = queries.op3_quality_rules(spark, SMALL).collect()
    wanted = [(d, *(s := brute.base_statistics(t)), s[0] < 50 or 100 * s[4] > 50 * s[0]) for d, t in docs]
    assert in_order(tuple(r)[:7] for r in got) == in_order(wanted)
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_keep_the_good_and_find_the_bad(spark):
    sf_dir = "/root/testdata/sf0.01"
    judged = queries.op3_quality_rules(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in judged if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


# Quality scores


def test_forward_backward_equals_all_labellings():
    draw = np.random.default_rng(2)
    first = np.array([0, 1, 4, 9])
    energy, links = draw.normal(size=9), draw.normal(size=(2, 2))
    marginal, pairs, total = fields.forward_backward(energy, links, first)
    expected = np.zeros((2, 2))
    for text, (a, b) in enumerate(zip(first[:-1], first[1:])):
        n = b - a
        weights, ones = [], []
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            weights.append(np.exp(sum(energy[a + i] * y[i] for i in range(n)) + sum(links[y[i], y[i + 1]] for i in range(n - 1))))
            ones.append(y)
        weights, ones = np.array(weights), np.array(ones)
        assert total[text] == pytest.approx(np.log(weights.sum()))
        assert marginal[a:b] == pytest.approx((weights[:, None] * ones).sum(0) / weights.sum())
        for i in range(n - 1):
            for w, y in zip(weights / weights.sum(), ones):
                expected[y[i], y[i + 1]] += w
    assert pairs == pytest.approx(expected)


def test_scores_tell_held_out_documents_apart(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = queries.op6_quality_classifier(spark, sf_dir)
    rows = scored.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good, bad = ([r.score for r in rows if r.held_out and r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_scores_of_odd_texts(spark):
    texts = pa.array([*ODD, "fine words here\n" * 5, "BAD!! BAD!! " * 30] * 30, pa.string())
    labels = np.array(([1] * len(ODD) + [1, 0]) * 30)
    field = fields.fit(texts, labels)
    scores = field.scores(pa.array([None, "", "\n", "BAD!! BAD!! " * 40, "fine words here\n" * 4]))
    assert ((0 <= scores) & (scores <= 1)).all() and scores[0] == scores[1] and scores[3] < scores[4]
    assert fields.fit(texts, np.ones(len(labels), int)) is None
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert fields.classify(df, None).first().score == 0.5
    empty = spark.createDataFrame([], "doc_id long, text string, quality int")
    assert fields.train(empty.drop("quality"), empty.drop("text")) is None


def test_long_texts_pass_in_stretches_as_in_one(monkeypatch):
    draw = np.random.default_rng(3)
    first = np.array([0, 1, 4, 5, 42, 45, 100])
    energy, links = draw.normal(size=100), draw.normal(size=(2, 2))
    whole = fields.forward_backward(energy, links, first)
    monkeypatch.setattr(fields, "STRETCH", 4)
    for got, wanted in zip(fields.forward_backward(energy, links, first), whole):
        assert got == pytest.approx(wanted)


def test_a_long_labelled_text_neither_empties_the_fit_nor_takes_it_over(spark):
    good = "some fine words stand here in one plain line of text, and a few more of them\n"
    bad = "BAD!! #### 123 BAD!! BAD!! #### 123 BAD!! BAD!! #### 123 BAD!! #### 123 BAD!!\n"
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    keys = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    first = keys.orderBy(F.xxhash64("doc_id")).first().doc_id  # the first in the sample
    rows = [(i, (bad if i % 2 else good) * (3 + i % 4), 1 - i % 2) for i in ids if i != first]
    rows.append((first, (bad if first % 2 else good) * ((20 << 20) // len(bad if first % 2 else good)), 1 - first % 2))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    field = fields.train(df.drop("quality"), df.drop("text"))
    assert field is not None
    scores = field.scores(pa.array([text * n for text in (good, bad) for n in (3, 4, 5, 6)]))
    assert min(scores[:4]) > 0.9 and max(scores[4:]) < 0.1


# Tokens


@pytest.fixture(scope="module")
def both():
    return pieces.Vocabulary.load(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same_as_library(both, texts):
    vocabulary, library = both
    ids, at = pieces.Encoder(vocabulary).encode(texts)
    raw, stops = pieces.decode(ids, at, vocabulary)
    for i, text in enumerate(texts):
        wanted = library.encode(text or "", add_eos=True)
        assert ids[at[i] : at[i + 1]].tolist() == wanted, text
        assert raw[stops[i] : stops[i + 1]].tobytes().decode() == library.decode(wanted), text


def test_odd_texts_encode_as_the_library_does(both):
    same_as_library(both, [
        *ODD, "    " * 5, "▁", " ▁▁ a", "\t", "</s>[INST] <0x0A> <s>", "日本語🙂👍🏽 x", "é" * 50, " " * 3000, "a" * 5000,
        "ab" * 3000 + " " * 1500 + "\n" * 2000, "�⁇",
    ])


def test_random_texts_encode_as_the_library_does(both):
    draw, pool = random.Random(1), [p for p in both[0].pieces if len(p) > 2]
    for _ in range(20):
        same_as_library(both, ["".join(draw.choice([
            draw.choice(pool).replace("▁", " "), draw.choice("abcdefgh etaoin  \n.,é日ñ"), chr(draw.randrange(32, 0x3000)),
        ]) for _ in range(draw.randrange(200))) for _ in range(30)])


def test_token_query(spark, both):
    got = queries.op4_sentencepiece(spark, SMALL).collect()
    wanted = []
    for doc, text in documents(spark):
        ids = both[1].encode(text or "", add_eos=True)
        wanted.append((doc, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(both[1].decode(ids))))
    assert in_order(got) == in_order(wanted)
    df = spark.createDataFrame([(1, None, 5)], "doc_id long, text string, token_ids int")
    row = pieces.encode(df, MODEL).first()
    assert (row.token_ids, row.decoded_text) == ([2], "")
    assert pieces.encode(df.limit(0), MODEL).count() == 0


# Licenses


def test_licenses_equal_windows_by_hand(spark):
    draw = random.Random(1)
    templates = (*licenses.TEMPLATES, ("short", "all rights reserved"), ("none", "!!"))
    texts = [*ODD, "All rights reserved"]
    for _ in range(200):
        words = []
        for _ in range(draw.randint(0, 6)):
            own = draw.choice(templates)[1].split() if draw.random() < 0.6 else ["license"] * draw.randint(0, 20)
            if draw.random() < 0.5 and own:
                k = draw.randrange(len(own))
                own = own[:k] + ["x"] * draw.randint(0, 2) + own[k + draw.randint(0, 1) :]
            words += own
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(m) for m in r.licenses] for r in licenses.scan(df, templates=templates).collect()}
    assert got == {i: brute.licenses(t, templates) for i, t in enumerate(texts)}
    assert licenses.scan(df.limit(0)).count() == 0


def test_notices_and_texts_are_told_apart(spark):
    gnu = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General "
           "Public License as published by the Free Software Foundation, either version {} of the License, or (at your "
           "option) any later version.")
    notices = {
        "GPL-2.0-or-later": gnu.format("", 2), "GPL-3.0-or-later": gnu.format("", 3), "LGPL-2.1-or-later": gnu.format("Lesser ", "2.1"),
        "LGPL-2.0-or-later": gnu.format("Library ", 2), "LGPL-3.0-or-later": gnu.format("Lesser ", 3),
        "AGPL-3.0-or-later": gnu.format("Affero ", 3),
        "BSD-2-Clause": "* in the documentation and/or other materials provided with the distribution.\n\n * THIS SOFTWARE IS "
                        "PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS",
        "BSD-3-Clause": "in the documentation and/or other materials provided with the distribution. * Neither the name of the "
                        "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                        "from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE "
                        "COPYRIGHT HOLDERS AND CONTRIBUTORS",
    }
    of_their_own = {name: text for name, text in licenses.TEMPLATES if name not in notices}
    rows = list((notices | of_their_own).items())
    got = licenses.scan(spark.createDataFrame(rows, "name string, text string")).collect()
    assert {r.name: [m.license for m in r.licenses] for r in got} == {name: [name] for name, _ in rows}
    assert {"ISC-text", "CC0-1.0", "EPL-2.0", "GPL-3.0-text", "Apache-2.0-text"} <= set(of_their_own)


def test_license_query(spark):
    got = {r.doc_id: (r.n_words, r.licenses) for r in queries.op7_license_scan(spark, SMALL).collect()}
    for doc, text in documents(spark):
        assert got[doc] == (len(brute.alnum(text)), ",".join(m[0] for m in brute.licenses(text, licenses.TEMPLATES)))


# Chats

BITS = ["\\", "<|", "turn", "|>", chat.TURN, chat.END, "\n", "</s>", "[INST]", "a", "é", "🙂", "[", "<", "<\\|end|>", "<<SYS>>"]


def test_rendered_turns_read_back():
    draw = random.Random(2)
    for _ in range(500):
        turns = [(draw.choice(["user", "assistant", "".join(draw.choices(BITS, k=3))]), "".join(draw.choices(BITS, k=draw.randint(0, 12))))
                 for _ in range(draw.randint(0, 5))]
        formatted, spans = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]
        assert formatted.count(chat.TURN) == formatted.count(chat.END) == len(turns)


def test_odd_conversations(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(40)]), draw.choice([None, 0, 1, 2, 3]), draw.choice(["user", "assistant", None, "x\ny"]),
             draw.choice([None, "".join(draw.choices(BITS, k=draw.randint(0, 30)))])) for _ in range(300)]
    df = spark.createDataFrame(rows + rows[:10], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df.withColumn("chat", F.lit(1)), public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert got == brute.conversations(rows + rows[:10])
    for row in formatted.collect():
        assert len(row.chat.token_ids) == len(row.chat.token_learned)
    assert chat.read_back(chat.format_conversations(df.limit(0), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op9_chat_formatting(spark, SMALL).collect()}
    assert got == brute.conversations([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])
