"""Documents to training sequences: language, near duplicates, repeated passages, packing.

Each stage takes the rows that its predecessor kept, with the columns of `documents`, and its
decisions hold for all that follow; the last one gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstats import files
from ledgerstats.llm.common import size_session, written
from ledgerstats.llm.language import only_identified
from ledgerstats.llm.neardup import without_near_duplicates
from ledgerstats.llm.packing import pack
from ledgerstats.llm.passages import remove_repeats
from ledgerstats.llm.queries import byte_bpe

#: The stage's near copies are those from this similarity on, in hundredths; op5 has its own.
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that two languages fit alike, go."""
    return only_identified(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return without_near_duplicates(docs, percent=NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut, and `n_chars` counts what is left."""
    rows = remove_repeats(docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), size))
    return rows.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack(docs, byte_bpe())


STAGES = [
    ("language", language),
    ("near_duplicate", near_duplicate),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

# SQL can express neither the trained classifier nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each one's rows written and read again."""
    path = f"{sf_dir}/documents.parquet"
    size_session(spark, files.size_in_bytes(spark, path))
    rows = spark.read.parquet(path)
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
