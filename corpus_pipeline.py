"""A corpus from raw documents to tokens: quality rules, line dedup, near-duplicates, source mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import lines, mixing, quality_rules, sentencepiece, simhash
from logweir.llm.common import n_words, stored, table

TOKENIZERS = "/opt/tokenizers"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules: thresholds learnt per language and source."""
    return quality_rules.kept_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of 50 words or more cut out; n_chars follows. Documents left without a word go."""
    cut, _, deleted = lines.dedup_lines(docs)
    cut = cut.where((F.col(deleted) == 0) | (n_words(F.col("text")) > 0))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(deleted) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word Jaccard likeness of 0.8 or more."""
    return simhash.without_near_duplicates(docs, n_gram=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with its language and source."""
    return sentencepiece.encoded(docs, f"{TOKENIZERS}/piece_bpe_32k.model", keep=("lang", "source"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mix),
    ("sentencepiece", encode),
]

# SimHash needs XXH64 and the last stage a tokenizer: no SQL. The tests hold it against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return docs
