"""A corpus pipeline: rejects low quality, deletes repeated lines, drops near copies, mixes the sources and encodes the texts.

Defined results of every stage but the last: the columns of docs in their order, whatever the names of further ones; an empty table
gives an empty one; a null text counts as empty; texts are worked on whole, however long.  Ties and repeated rows are told at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import bpe, line_dedup, mixing, quality_model, simhash
from gridloom.llm.common import checkpointed, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject: a score of one half or more stays; repeated rows have equal scores."""
    return quality_model.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; one of which nothing is left goes, and n_chars follows the text.

    The first copy, by doc_id (null first), then text hash, stays; a text without words loses nothing and stays.
    """
    return line_dedup.remaining(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: that of the smallest doc_id (null last), then of the least digest; texts without words are one group."""
    return simhash.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources has them, each at least once; a null source is a source, repeated rows count each."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text, for each copy of a document."""
    return bpe.round_trip_digests(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("mixing", mixture), ("bpe", tokens)]

#: A trained classifier, SimHash components and BPE can't be put into SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return docs
