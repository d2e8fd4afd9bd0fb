"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

Language ID, near duplicates, personal data, the mixture of sources, and packing into training sequences. Each stage
works on all that its predecessor kept; all but the last return the columns of documents. Null doc_ids, null and empty
texts, repeated rows, empty tables and further columns are handled as each stage says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandemlake.llm.common import release, staged, table
from tandemlake.llm.langid import accepted_documents
from tandemlake.llm.mixing import WEIGHTS, mixed_documents
from tandemlake.llm.neardup import distinct_documents
from tandemlake.llm.packing import pack_documents
from tandemlake.llm.pii import redact_pii


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: null texts, texts without letters, and those of no learned language."""
    return accepted_documents(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, its least doc_id; of rows repeated whole one."""
    return distinct_documents(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; null texts and repeated rows stay as they are."""
    return redact_pii(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as the sources' targets say; a null source is a source."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their ids, in the proportions of the mixture's weights."""
    return pack_documents(docs, weights=WEIGHTS)


STAGES = [("language", language), ("near_duplicates", near_duplicate), ("personal_data", personal_data), ("mixture", mixture), ("packing", packing)]

#: The stages' models are trained, which SQL can't express; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
