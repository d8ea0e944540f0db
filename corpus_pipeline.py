"""The training-data pipeline: toxicity, near-duplicates, personal data, mixing, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``. What a stage returns is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe import read_ranks, token_digests
from ledgerlake.llm.common import keyed_rows, remainder, staged, table, unkeyed
from ledgerlake.llm.mixing import mixed_documents
from ledgerlake.llm.neardup import near_duplicates
from ledgerlake.llm.pii import pseudonymise
from ledgerlake.llm.queries import PSEUDONYM_KEY
from ledgerlake.llm.toxicity import train, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts as toxic go. It learns from labelled rows that are not held out.

    Every row is judged by its own text.
    """
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels"), ~held_out))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the least id.

    Every row goes or stays by its own text; rows that repeat an id and its text stay together.
    """
    rows = keyed_rows(docs)
    gone = near_duplicates(rows.select("row.doc_id", "row.text", "row_key"), carry=("row_key",)).filter("not kept").select("row_key")
    return unkeyed(rows.join(gone, "row_key", "left_anti"), docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same length; every document stays, null and empty texts and repeated rows included.

    The key is the session's ``ledgerlake.pii.key``; without it that of the registered query, whose results anybody can undo.
    """
    return pseudonymise(docs, spark.conf.get("ledgerlake.pii.key", PSEUDONYM_KEY), kinds=None)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; sources beyond their target lose documents, others repeat."""
    return mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, one row per row of the mix."""
    import public_tokenizers

    return token_digests(docs, read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", hide_personal_data),
    ("mixing", mix),
    ("tokens", tokenise),
]

#: SQL expresses neither the model nor the signatures; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
