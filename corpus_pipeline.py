"""The corpus pipeline: documents to token files, each stage one operator over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainlake.llm import mixing, near_copies, perplexity, token_files, winnowing
from chainlake.llm.common import saved
from chainlake.llm.queries import table, tokenizer_path

# DuckDB has neither the tokenizer nor XXH64 of Spark's seed, so SQL cannot say what run() returns. The stages are tested
# against plain versions, the mixing one against its own SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model does not reject. Null and empty texts, and languages without trusted texts, stay; an id goes with all its
    rows; a null id stays."""
    return perplexity.kept_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest id. Texts without words are one
    group; of repeated rows one stays; rows of a null id stay."""
    return near_copies.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark. Null and empty texts have none and stay, as do repeated rows."""
    return winnowing.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the probabilities of their source, language and topic. Nulls are values of these; texts without words are not drawn; rows of
    one id are drawn alike."""
    return mixing.drawn_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from the token files. A null text is its end id alone; every row has one of its own."""
    return token_files.read_tokens(token_files.write_tokens(docs, tokenizer_path()), with_tokens=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixture),
    ("token files", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
