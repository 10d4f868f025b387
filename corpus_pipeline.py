"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again
for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.debruijn import remove_repeats
from millrace.llm.decontaminate import contamination
from millrace.llm.packing import pack
from millrace.llm.quality import quality_verdicts
from millrace.llm.queries import TOKENIZER
from millrace.llm.shared import ship, stored
from millrace.llm.simhash import representatives

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ship(spark)
    return quality_verdicts(docs, with_text=True).filter("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    ship(spark)
    return representatives(docs, shingle=4, max_bits=4).select(COLUMNS)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of 20 words and more that occur earlier are cut from the texts; every document stays.

    A text from which something is cut keeps its other words, joined by blanks. ``n_chars`` follows.
    """
    ship(spark)
    cut = remove_repeats(docs.select(COLUMNS), window=20, with_text=True)
    return cut.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "row.lang",
        "row.source",
        F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("long"))
        .otherwise(F.col("row.n_chars").cast("long"))
        .alias("n_chars"),
    )


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go."""
    ship(spark)
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_row"))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(keyed, items, window=10, k=5, doc_id="_row").filter("contaminated")
    gone = stored(found.select(F.col("doc_id").alias("_row")).distinct(), "contaminated")
    return keyed.join(gone, "_row", "left_anti").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2048 tokens."""
    ship(spark)
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Fingerprints and tokens cannot be had from SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents of ``sf_dir`` that the stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
