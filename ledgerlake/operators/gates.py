"""Rule-driven quality scan and gate summaries."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Exit codes of a check.
EXIT_PASS = 0
EXIT_SCRIPT_ERROR = 1
EXIT_EVAL_FAIL = 2
EXIT_MANUAL_UNGRADED = 3
EXIT_ADVISORY = 4


class Rule(NamedTuple):
    """A quality rule. ``kind`` is not_null, unique, range, set, regex or row; ``args`` depend on it:
    range (low, high; None is open), set (values), regex (pattern,), row (condition,): a column, or its SQL text."""

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    args: tuple = ()
    threshold: float = 1.0


def _row_condition(rule: Rule) -> Column:
    c = F.col(rule.columns[0]) if rule.columns else None
    if rule.kind == "not_null":
        return c.isNotNull()
    if rule.kind == "range":
        low, high = rule.args
        ok = F.lit(True)
        if low is not None:
            ok = ok & (c >= F.lit(low))
        return ok & (c <= F.lit(high)) if high is not None else ok
    if rule.kind == "set":
        return c.isin(*rule.args)
    if rule.kind == "regex":
        return c.rlike(rule.args[0])
    if rule.kind == "row":
        return rule.args[0] if isinstance(rule.args[0], Column) else F.expr(rule.args[0])
    raise ValueError(f"unknown rule kind {rule.kind}")


def dq_scan(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """One row per rule, and per group of ``by`` where given: rows evaluated, rows passed, their ratio and whether it reaches the threshold.

    NULLs are judged by not_null and row rules only; the other kinds skip them. For unique, passed is
    the number of different values. All row rules are answered by one pass over the table; each
    uniqueness rule adds a count of distinct keys.
    """
    counts: list[Column] = []
    for i, r in enumerate(rules):
        if r.kind == "unique":
            present = F.lit(True)
            for c in r.columns:
                present = present & F.col(c).isNotNull()
            key = F.struct(*r.columns) if len(r.columns) > 1 else F.col(r.columns[0])
            counts += [F.count_if(present).alias(f"e{i}"), F.count_distinct(F.when(present, key)).alias(f"p{i}")]
            continue
        evaluated = F.lit(True) if r.kind in ("not_null", "row") else F.col(r.columns[0]).isNotNull()
        passed = F.coalesce(_row_condition(r), F.lit(False)) & evaluated
        counts += [F.count_if(evaluated).alias(f"e{i}"), F.count_if(passed).alias(f"p{i}")]
    rows = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.col(f"e{i}").alias("evaluated"),
            F.col(f"p{i}").alias("passed"), F.lit(float(r.threshold)).alias("threshold"),
        )
        for i, r in enumerate(rules)
    ]
    ratio = F.round(F.coalesce(F.try_divide(F.col("passed").cast("double"), F.col("evaluated")), F.lit(1.0)), 6)
    return (
        df.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*rows)))
        .withColumn("ratio", ratio)
        .select(*by, "rule", "kind", "evaluated", "passed", "ratio", (F.col("ratio") >= F.col("threshold")).alias("ok"))
    )


def check_results(scan: DataFrame, run_id: Column | str, table: str, elapsed: Column | float = 0.0) -> DataFrame:
    """Quality-scan rows as check results (``run_id, table_name, rule, required, exit_code, elapsed``)."""

    def lit(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return scan.select(
        lit(run_id).alias("run_id"), F.lit(table).alias("table_name"), "rule", F.lit(True).alias("required"),
        F.when(F.col("ok"), EXIT_PASS).otherwise(EXIT_EVAL_FAIL).alias("exit_code"), lit(elapsed).alias("elapsed"),
    )


def gate_summary(results: DataFrame) -> DataFrame:
    """One row per run over check results ``run_id, rule, required, exit_code, elapsed``.

    A required check passes with exit code 0 and fails with any other. Exit code 4 is advisory
    whatever the check; an optional check never blocks. The gate passes when at least one required
    check ran and none failed.
    """
    advisory = F.col("exit_code") == EXIT_ADVISORY
    counted = F.col("required") & ~advisory
    passed = counted & (F.col("exit_code") == EXIT_PASS)
    return (
        results.groupBy("run_id")
        .agg(
            F.count_if(counted).alias("required_total"),
            F.count_if(passed).alias("required_passed"),
            F.count_if(counted & (F.col("exit_code") != EXIT_PASS)).alias("required_failed"),
            F.count_if(advisory).alias("advisories"),
            F.round(F.sum("elapsed"), 2).alias("total_elapsed"),
        )
        .withColumn("gate_passed", (F.col("required_failed") == 0) & (F.col("required_total") > 0))
    )


def outcome(exit_code: Column) -> Column:
    """Meaning of an exit code."""
    return (
        F.when(exit_code == EXIT_PASS, "passed")
        .when(exit_code == EXIT_EVAL_FAIL, "failed")
        .when(exit_code == EXIT_MANUAL_UNGRADED, "ungraded")
        .when(exit_code == EXIT_ADVISORY, "advisory")
        .otherwise("script error")
    )
