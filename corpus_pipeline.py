"""A corpus pipeline of training-data operators: documents in, packed sequences out.

Each stage takes the documents that the one before kept, and its result is written as
Parquet in the shared folder before the next one reads it. All stages but the last return
the columns of documents, whatever their names, and rows that repeat others are rows like
any. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill.llm import decontaminate, linededup, packing, quality, simhash
from visitmill.llm.queries import WORD_VOCABULARY, table
from visitmill.sinks.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are anomalies go; so do null and empty texts.

    Without labels of both kinds nothing is an anomaly.
    """
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are cut out; every document stays.

    One of which all lines go keeps an empty text, a null text stays null, and n_chars is
    that of the new text. Of equal ids the text's hash decides which is earlier.
    """
    cut = linededup.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies stays.

    Rows without an id stay, and so do all rows of the smallest id. Texts without a word are
    near copies of each other.
    """
    return simhash.first_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go.

    Null and empty texts share none, and neither does anything with an empty benchmark.
    """
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the remaining documents with its place in a sequence.

    A null or empty text is one piece, of the separator alone.
    """
    return packing.pack(docs, WORD_VOCABULARY)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL has neither XXH64, the forest's random splits nor the tokenizer. A test holds each stage
#: against a plain version on what it was given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder: the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
