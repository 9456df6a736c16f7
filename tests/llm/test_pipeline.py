"""The pipeline stage by stage against plain Python, and whole."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tests.llm import brute
from wayfare.llm import rules

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage_does_its_work_on_what_the_last_one_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near dedup", "substring dedup", "decontamination", "encoding"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r.text for r in out.collect()}
        rows = list(before.items())
        if name == "quality rules":
            learned = rules.learn(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            rejected = {r.doc_id for r in rules.with_statistics(docs).where(learned.rejects()).collect()}
            base = {d for d, t in rows if (s := brute.base_statistics(t))[0] < 50 or 100 * s[4] > 50 * s[0]}
            wanted = {d: t for d, t in rows if d not in base | rejected}
        elif name == "near dedup":
            wanted = {d: before[d] for d, _, component in brute.components(rows, size=5) if d == component}
        elif name == "substring dedup":
            wanted = {d: kept if gone else before[d] for d, n, gone, kept in brute.words_removed(rows) if not n or gone < n}
        elif name == "decontamination":
            wanted = {row[0]: before[row[0]] for row in brute.contamination(rows, items) if not row[5]}
        else:
            wanted = before
            ids = {r.doc_id: (r.n_tokens, r.token_ids) for r in out.collect()}
            assert ids == {d: (len(i), i) for d, t in rows for i in [library.encode(t, add_eos=True)]}
        assert after == wanted, name
        if name != "encoding":
            assert out.columns == columns
        docs, before = out, after


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_tokens", "token_ids"] and out.count() > 100


def test_encoding_returns_what_the_ids_decode_to(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = corpus_pipeline.encoding(spark, docs, SF_DIR).select("token_ids", "decoded_text").collect()
    assert rows and all(r.decoded_text == library.decode(r.token_ids) for r in rows)
