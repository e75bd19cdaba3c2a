"""A corpus made ready for training, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its
result is written as Parquet and read again before the next one starts, so a lost executor
never costs more than one stage. All stages but the last return the columns of their input.

Cases that hold for all stages: an empty table stays empty; rows with null or empty text
have no language and go in the first stage; a null ``doc_id`` is an id like others, except
that it comes last where the smallest id decides; rows equal in all columns are one
document, of which the third stage keeps one; extra columns are carried along, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm.bpe import digests
from ridelake.llm.decontaminate import without_benchmark
from ridelake.llm.language import accepted
from ridelake.llm.lines import remove_repeated_lines
from ridelake.llm.queries import tokenizer_path
from ridelake.llm.simhash import keep_one
from ridelake.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled rows; others go."""
    return accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that earlier documents have in the same company."""
    return remove_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no item of ``benchmark`` was found."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, for each document."""
    # Executors that have been through four stages have less room for remembered words.
    return digests(docs, tokenizer_path(), table_words=200_000)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

# Language scores and fingerprints cannot be written in SQL; tests use plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"corpus-{name}")
    return docs
