"""The corpus pipeline: language, exact copies, near copies, benchmark passages, then pieces.

Each stage reads what the one before it has written as Parquet. The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrail.llm import decontaminate, exact_dedup, language, near_dedup, pieces
from casetrail.llm.common import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose evidence speaks for no language, go."""
    return language.keep_identified(docs, "doc_id", "text", "lang", F.lower("source"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 or more of five-word shingles, the smallest id stays."""
    return near_dedup.keep_one_of_each(docs, size=5, percent=80)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or all words of a shorter one, go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, and a digest of the text that they decode to."""
    encoded = pieces.encode_texts(docs, pieces.load_model(pieces.default_model()))
    return encoded.select("doc_id", "n_pieces", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("SentencePiece encoding", encode_pieces),
]

#: SQL cannot express the first and the last stage; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
