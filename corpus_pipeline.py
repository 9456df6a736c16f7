"""Documents to training samples: quality rules, near and substring deduplication, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and gets the rows that its predecessor
kept; ``run`` writes what each returns and reads it back, so a lost executor
or a failed stage never repeats the stages before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare.llm import contamination, near, pieces, rules, substrings
from wayfare.llm.registry import table
from wayfare.scratch import fresh_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    return rules.keep(docs, rules.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id."""
    return near.deduplicate(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that a document with a smaller id has."""
    cleaned = substrings.cleaned(docs)
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return contamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training samples: the whole text as ids with an end id, their number, and the text that the ids decode to."""
    encoded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id", "text", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_text"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: No SQL: the learned list and the sketches can't be expressed; tests hold the stages against plain Python.
ORACLE_SQL = None


#: Columns of the samples that ``run`` returns; the encoding stage itself also returns ``decoded_text``.
SAMPLE = ["doc_id", "text", "lang", "source", "n_tokens", "token_ids"]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir).select(*SAMPLE)
