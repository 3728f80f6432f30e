"""Documents to tokens: toxicity, line dedup, near-duplicates, decontamination, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written and read again for the next one.
All but the last give the columns of documents; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.llm import bpe, fm_index, line_dedup, simhash, toxicity
from clinspark.llm.queries import table, tokenizer
from clinspark.staging import Staging

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def measured(docs: DataFrame, changed) -> DataFrame:
    """``docs`` with ``n_chars``, if there is one, measured anew where the text ``changed``."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold, learnt from the labels of the documents that came in."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    kept = toxicity.score(docs, machine, out="__toxicity").where(F.col("__toxicity") < toxicity.THRESHOLD)
    return kept.select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks that an earlier one has; one of which nothing is left was a copy, and goes."""
    found = line_dedup.dedup_lines(docs, Staging(spark), report="__report")
    changed = F.col("__report").isNotNull()
    left = measured(found, changed).where(~changed | (F.trim("text") != ""))
    return left.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs, Staging(spark))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that they share with the benchmark."""
    found = fm_index.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    cleaned = found.withColumn("text", F.coalesce("leak.clean", "text"))
    return measured(cleaned, F.col("leak.clean").isNotNull()).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as packed tokens, and the text that they decode to."""
    ranks, pattern = tokenizer()
    tokens = bpe.bpe_round_trip(docs, ranks, pattern)
    return tokens.select(
        *[c for c in docs.columns if c != "text"],
        F.col("decoded").alias("text"), (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"), "tokens",
        F.sha2("tokens", 256).alias("ids_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", encode),
]

#: SQL can express neither the kernel machine nor the transducer; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``; each result is stored in the shared folder."""
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return docs
