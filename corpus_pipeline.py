"""The corpus pipeline: stages over table ``documents``, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``; it works on all rows that the stage
before it kept.  Any further columns of the table, whatever their names, are handed on as they are by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climastar.llm import bpe, decontaminate, langid, simhash_dedup, suffix_dedup
from climastar.llm.common import quoted, staged, table
from climastar.llm.queries import tokenizer_path


#: A language is told if its calibrated probability is at least so many times that of a guess.
OVER_CHANCE = 1.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: texts without a letter go, and those that are about as likely in any learned
    language, as in an unknown script.  Without a labelled document to learn from all stay."""
    return langid.keep_identified(docs, OVER_CHANCE)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, two bits."""
    return simhash_dedup.keep_one(docs, shingle=3, max_distance=2)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 200 bytes or more that also are elsewhere; n_chars is that of the text left."""
    others = F.struct(*[F.col(quoted(c)) for c in docs.columns if c != "text"])
    found = suffix_dedup.remove_repeats(docs.select(others.alias("row"), "doc_id", "text"), as_text=True, drop_text=True)
    new = {"text": F.col("__kept"), "n_chars": F.length("__kept").cast(docs.schema["n_chars"].dataType)}
    return found.select(*[new.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = docs.select(F.struct(F.col("*")).alias("row"), "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    bad = decontaminate.contaminated(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("hash") == F.col("bad_hash"))
    return rows.join(bad.hint("shuffle_hash"), same, "left_anti").select("row.*")


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    rows = bpe.encode(docs.select("doc_id", "lang", "source", "text"), tokenizer_path(), decoded="text")
    return rows.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe", bpe_round_trip),
]

#: SQL expresses none of language ID, SimHash and BPE; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
