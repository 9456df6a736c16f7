"""The thirteen operators bound to the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare.llm import (
    chat, contamination, fields, licenses, middles, near, oracles, periodic, pieces, rules, shards, substrings, suffixes, urls,
)
from wayfare.llm.registry import query, table


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decisions = rules.learn(docs, table(spark, sf_dir, "labels"))
    judged = rules.judge(docs, decisions)
    counts = [F.col(f"statistics.{name}").alias(name)
              for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept", "rejecting_rule")


@query(oracles.DECONTAMINATION)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = contamination.scan(docs, table(spark, sf_dir, "benchmark"))
    items = contamination.found_items()
    return scanned.select(
        "doc_id", F.col("found.n_words").alias("n_words"), contamination.n_hit().alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (contamination.n_hit() > 0).alias("contaminated"),
    )


@query(oracles.SUBSTRING_DEDUP)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substrings.deduplicate(docs)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(oracles.BYTE_DEDUP)
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffixes.deduplicate(docs)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded_text", 256).alias("decoded_sha256"),
    )


@query(oracles.NEAR_DEDUP)
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near.classes(docs, shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"))


@query(oracles.CHAT_FORMATTING)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    formatted = chat.format_conversations(rows.unionByName(more), public_tokenizers.path("byte_bpe_50k.json"))
    return chat.read_back(formatted).drop("n_tokens", "n_learned_tokens")


#: Rules of the URL query: host and path prefix, longest wins.
URL_RULES = [
    urls.Rule("org/", "allow"), urls.Rule("example.org/es/", "block"), urls.Rule("example.org/en/1", "block"),
    urls.Rule("com/fr/", "allow"), urls.Rule("com/de/", "block"),
]


@query(oracles.url_filter(URL_RULES, urls.ORDER))
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = fields.train(docs, table(spark, sf_dir, "labels"))
    scored = fields.classify(docs, field)
    return scored.select(
        "doc_id", fields.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select(
        "doc_id", "n_words", F.size("licenses").cast("long").alias("n_licenses"),
        F.concat_ws(",", "licenses.license").alias("licenses"),
        F.concat_ws(",", F.transform("licenses", lambda m: F.concat_ws(
            ":", *(m[c].cast("string") for c in ("word", "n_found", "n_shingles"))))).alias("places"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's rewriting: a tenth of the documents, by checksum of the id, end in a repeated stretch of their words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.withColumn("w", F.when(h % 10 == 0, words)).withColumns({"n": F.size("w"), "g": F.floor(h / 10)})
    a = F.pmod(F.col("g"), F.col("n"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)
    place = F.expr("transform(sequence(0L, n - 1L), i -> if(i < a, i, a + (i - a) % p))")
    planted = F.concat_ws(" ", F.transform(place, lambda i: F.get("w", i.cast("int"))))
    return docs.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query(oracles.PERIODIC_RUNS)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = periodic.scan(with_planted_runs(docs)).withColumn("best", periodic.strongest())
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return scanned.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", listed), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(oracles.FILL_IN_MIDDLE)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = middles.transform(docs)
    return cut.select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        F.sha2("fim_text", 256).alias("output_sha256"),
        F.sha2(middles.restored(F.col("fim_text"), F.col("form")), 256).alias("restored_sha256"),
    )


@query(oracles.sharding(24, shards.SLOTS, shards.PIECES))
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shards.measured(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    placed, _ = shards.assign(docs, 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
