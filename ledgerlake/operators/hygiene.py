"""Null contract: classify rows, drop corrupt ones, keep benign nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.cleanse import CURRENCY, parse_number, parse_trimmed_ts, parse_ts, trim_text, ts_shape
from ledgerlake.plans.specs import FeedSpec

CORRUPT = "_corrupt_record"
CLASSES = ("N1", "N2", "N3a", "N3b", "N4", "CLEAN")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def benign_null(spec: FeedSpec) -> Column:
    """Either of the feed's two optional columns is missing."""
    return _any([F.col(c).isNull() for c in spec.optional])


def _truncated(df: DataFrame) -> Column:
    return F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)


def _keyed(spec: FeedSpec) -> Column:
    """All keys and the timestamp are there. A key of blanks and a timestamp in no known layout are not."""
    present = [F.coalesce(F.col(k).rlike(r"[^\s\p{Z}]"), F.lit(False)) for k in spec.keys]
    return _all(present + ([parse_ts(spec.ts).isNotNull()] if spec.ts else []))


def _positive(spec: FeedSpec, accounting: bool = True) -> Column:
    """The mandatory metric is a number above zero."""
    return F.coalesce(parse_number(spec.metric, spec.roles.get(spec.metric, CURRENCY), accounting) > 0, F.lit(False))


def null_class_expr(df: DataFrame, spec: FeedSpec, accounting: bool = True) -> Column:
    """Class of a raw row: N1 empty, N2 truncated, N3a missing key or timestamp, N3b mandatory metric
    not positive, N4 benign null, CLEAN."""
    return (
        F.when(_truncated(df), "N2")
        .when(_all([F.col(c).isNull() for c in spec.columns]), "N1")
        .when(~_keyed(spec), "N3a")
        .when(~_positive(spec, accounting), "N3b")
        .when(benign_null(spec), "N4")
        .otherwise("CLEAN")
    )


def null_class(df: DataFrame, spec: FeedSpec) -> DataFrame:
    return df.withColumn("null_class", null_class_expr(df, spec))


def is_sound(df: DataFrame, spec: FeedSpec, accounting: bool = True) -> Column:
    """The row is CLEAN or N4: nothing that must be there is missing. (An empty row has no key.)"""
    return ~_truncated(df) & _keyed(spec) & _positive(spec, accounting)


def drop_corrupt(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Keep CLEAN and N4 rows. Rows with missing optional values are kept on purpose."""
    return df.where(is_sound(df, spec)).drop(CORRUPT)


METRIC = "_metric"


def sound_keyed(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """The feed's columns of ``drop_corrupt``'s rows, with normalised keys and parsed timestamp, and the metric's number as ``_metric``.

    Every value is worked out once and then judged. The rows pass a generator, since a filter behind a projection moves below it and
    repeats its expressions, for the timestamp once for each layout.
    """
    rows = df.where(~_truncated(df)).select(*spec.columns)
    values = {k: F.upper(trim_text(k)) for k in spec.keys} | {METRIC: parse_number(spec.metric, spec.roles.get(spec.metric, CURRENCY))}
    if spec.ts:
        rows = rows.withColumn("_text", trim_text(spec.ts)).withColumn("_shape", ts_shape(F.col("_text")))
        values[spec.ts] = parse_trimmed_ts(F.col("_text"), F.col("_shape"))
    columns = [*spec.columns, METRIC]
    once = rows.withColumns(values).select(F.inline(F.array(F.struct(*columns))))  # of a column, Spark would infer a filter and move it down
    sound = [F.col(k) != "" for k in spec.keys] + ([F.col(spec.ts).isNotNull()] if spec.ts else []) + [F.col(METRIC) > 0]
    return once.where(_all(sound))
