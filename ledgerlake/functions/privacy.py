"""Hashing, masking and column policy tags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import trim_text

DIGEST_PATTERN = "^[0-9a-f]{64}$"
TAG = "policy_tag"


def hash_ssn(c: Column | str) -> Column:
    """SHA-256 of the trimmed number, as 64 hex characters."""
    return F.sha2(trim_text(c), 256)


def hash_email(c: Column | str) -> Column:
    """SHA-256 of the trimmed, lower-cased address, as 64 hex characters."""
    return F.sha2(F.lower(trim_text(c)), 256)


def is_digest(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(DIGEST_PATTERN)


def drop_pii(df: DataFrame, columns: Iterable[str] = ("ssn", "email")) -> DataFrame:
    return df.drop(*columns)


def tag_columns(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Attach a policy tag to columns; it travels in the schema and in Parquet files."""
    for name, tag in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, TAG: tag})
    return df


def tagged(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG] for f in df.schema.fields if TAG in f.metadata}


def masked_view(df: DataFrame, privileged: bool | Column, required: Iterable[str] = ("ssn", "email")) -> DataFrame:
    """Tagged columns in clear text for privileged readers and as SHA-256 digests for all others.

    ``required`` names columns that must carry a tag where they exist; serving them untagged would leak clear text.
    """
    tags = tagged(df)
    untagged = [c for c in required if c in df.columns and c not in tags]
    if untagged:
        raise ValueError(f"columns without a policy tag: {untagged}")
    allowed = F.lit(privileged) if isinstance(privileged, bool) else privileged
    return df.withColumns(
        {c: F.when(allowed, F.col(c)).otherwise(F.sha2(F.col(c).cast("string"), 256)) for c in tags}
    )
