"""What event logs tell about plans: fallbacks to Python, native operators, row transitions.

All operators take lines as ``scan_event_log`` returns them (``path, app, block_start, seq, value``) and
work on the logs of a whole estate. Lines are reduced where they are read; the largest log therefore
sends no more rows over the network than the smallest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.sources.logs import log_of

# Tokens that mark plan lines, native operators looked for, marks of Python evaluation,
# row-transition operators and the gate's limit.
PLAN_TOKENS = (
    "SparkListenerSQLAdaptiveExecutionUpdate", "SparkListenerSQLExecutionStart", "Velox", "Transformer",
    "BatchEvalPython",
)
NATIVE_OPERATORS = (
    "VeloxHashAggregate", "ProjectExecTransformer", "FilterExecTransformer", "BroadcastHashJoinExecTransformer",
    "ColumnarToRowExec", "VeloxColumnarToRow",
)
PYTHON_EVAL = "BatchEvalPython"
PYTHON_EVALS = ("BatchEvalPython", "ArrowEvalPython")
ROW_TRANSITIONS = ("ColumnarToRow", "VeloxToRow", "VeloxColumnarToRow")
TRANSITION_LIMIT = 500
ROWS_METRIC = "number of output rows"


def _has_any(value: Column, tokens: Sequence[str]) -> Column:
    found = value.contains(tokens[0])
    for t in tokens[1:]:
        found = found | value.contains(t)
    return found


def _with_log(lines: DataFrame) -> DataFrame:
    """Lines with ``log``, the log their file belongs to, and ``part``."""
    out = lines.withColumn("log", log_of(F.col("path")))
    return out if "part" in lines.columns else out.withColumn("part", F.lit(0).cast("bigint"))


def plan_events(
    lines: DataFrame, tokens: Sequence[str] = PLAN_TOKENS, limit: int | None = None, width: int | None = None
) -> DataFrame:
    """The plan lines of every log in order: all of them and whole, unless a report asks for the first
    ``limit`` or for lines of ``width`` characters. ``path`` is the log's.

    A log is numbered over the splits it was read in, the files of a rolled log one after the other: lines are numbered within their split,
    counts of the splits before it are added, and no task needs a log as a whole. A limit is applied per split before the shuffle, so a large log then sends few lines.
    """
    split = ["log", "app", "part", "path", "block_start"]
    found = _with_log(lines).where(_has_any(F.col("value"), tokens)).select(
        *split, "seq", (F.col("value") if width is None else F.substring("value", 1, width)).alias("event")
    )
    counts = found.groupBy(*split).agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("log", "app").orderBy("part", "path", "block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*split, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    placed = found.withColumn("place", F.row_number().over(Window.partitionBy(*split).orderBy("seq")))
    if limit is not None:
        placed = placed.where(F.col("place") <= limit)
        offsets = offsets.where(F.col("offset") < limit)
    numbered = placed.join(offsets, split).select(
        F.col("log").alias("path"), "app", (F.col("offset") + F.col("place")).cast("int").alias("position"), "event"
    )
    return numbered if limit is None else numbered.where(F.col("position") <= limit)


def plan_summary(lines: DataFrame, tokens: Sequence[str] = PLAN_TOKENS) -> DataFrame:
    """Per log: native operators named anywhere, whether Python evaluation is, and the number of plan lines. The files of a rolled log are one log.

    ``has_batch_eval_python`` is NULL for a log without content.
    """
    value = F.col("value")
    flags = [F.coalesce(F.bool_or(value.contains(op)), F.lit(False)).alias(op) for op in NATIVE_OPERATORS]
    per_log = lines.groupBy(log_of(F.col("path")).alias("path"), "app").agg(
        F.bool_or(F.when(F.btrim("value") != "", value.contains(PYTHON_EVAL))).alias("has_batch_eval_python"),
        F.count_if(_has_any(value, tokens)).alias("plan_event_count"),
        *flags,
    )
    named = F.array_compact(F.array(*[F.when(F.col(op), F.lit(op)) for op in NATIVE_OPERATORS]))
    return per_log.select(
        "path", "app", "has_batch_eval_python", F.concat_ws(",", named).alias("native_operators"), "plan_event_count"
    )


_TASK_END = (
    "struct<`Task Info`:struct<Accumulables:array<struct<ID:bigint,Name:string,Update:string>>>>"
)
_DRIVER_UPDATE = "struct<accumUpdates:array<array<bigint>>>"
_NODES = "array<struct<node:string,metrics:string>>"
_METRICS = "array<struct<name:string,accumulatorId:bigint>>"
# a node's name opens it and its metrics close it, so names and metrics nest like brackets; brackets inside of
# strings do not count. Possessive, so that no text costs the JVM stack or steps back.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NODE_TOKEN = rf'"nodeName":{_STRING}|"metrics":\[[^"\]]*+(?:{_STRING}[^"\]]*+)*+\]'


def _event(name: str) -> Column:
    return F.col("value").contains(f'"Event":"{name}"')


def plan_node_metrics(plan_text: Column) -> Column:
    """``array<struct<acc, node, metric, update>>`` of all metrics in a plan tree's JSON text (update is 0).

    A tree of any depth is folded with a stack: a name token pushes, a metrics token belongs to the
    name on top and pops it. The fold gathers one entry a node; metrics are read from them afterwards.
    """
    tokens = F.regexp_extract_all(plan_text, F.lit(_NODE_TOKEN), F.lit(0))
    empty = F.struct(
        F.array().cast("array<string>").alias("stack"), F.array().cast(_NODES).alias("found")
    )

    def step(state: Column, token: Column) -> Column:
        name = F.regexp_extract(token, r'(?s)^"nodeName":"(.*)"$', 1)
        depth = F.size(state["stack"])
        node = F.struct(
            F.when(depth > 0, F.element_at(state["stack"], -1)).alias("node"), F.regexp_extract(token, r"(?s)^[^\[]*(\[.*\])$", 1).alias("metrics")
        )
        pushed = F.struct(F.concat(state["stack"], F.array(name)).alias("stack"), state["found"].alias("found"))
        popped = F.struct(
            F.slice(state["stack"], 1, F.greatest(depth - 1, F.lit(0))).alias("stack"),
            F.concat(state["found"], F.array(node)).alias("found"),
        )
        return F.when(token.startswith('"nodeName"'), pushed).otherwise(popped)

    def metrics_of(node: Column) -> Column:
        return F.transform(
            F.coalesce(F.from_json(node["metrics"], _METRICS), F.array().cast(_METRICS)),
            lambda m: F.struct(
                m["accumulatorId"].alias("acc"), node["node"].alias("node"), m["name"].alias("metric"), F.lit(0).cast("bigint").alias("update")
            ),
        )

    return F.flatten(F.transform(F.aggregate(tokens, empty, step, lambda s: s["found"]), metrics_of))


def accumulator_moves(lines: DataFrame) -> DataFrame:
    """One row per plan metric (``node`` and ``metric`` set, update 0) and per reported update (both NULL).

    A line is parsed only if it names one of the four events; every other line yields one row without
    an accumulator, so an application without any of them stays visible.
    """
    value = F.col("value")
    is_plan = _event("org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart") | _event(
        "org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate"
    )
    task = F.from_json(value, _TASK_END)["Task Info"]["Accumulables"]
    driver = F.from_json(value, _DRIVER_UPDATE)["accumUpdates"]
    none = F.lit(None).cast("string")

    def move(acc: Column, update: Column) -> Column:
        return F.struct(acc.alias("acc"), none.alias("node"), none.alias("metric"), update.alias("update"))

    moves = (
        F.when(is_plan, plan_node_metrics(value))
        .when(_event("SparkListenerTaskEnd"), F.transform(task, lambda a: move(a["ID"], a["Update"].try_cast("bigint"))))
        .when(
            _event("org.apache.spark.sql.execution.ui.SparkListenerDriverAccumUpdates"),
            F.transform(driver, lambda a: move(F.get(a, F.lit(0)), F.get(a, F.lit(1)))),
        )
    )
    return lines.select("app", F.inline_outer(moves))


def node_updates(lines: DataFrame) -> DataFrame:
    """Summed updates per application, plan node name and metric name: plan metrics joined to their updates.

    Metrics and updates meet in a group-by on (app, accumulator), after a first one that adds updates up
    before the shuffle with node and metric as keys (a hash aggregate; a maximum of text would sort all
    updates). One pass over the logs.
    """
    added = accumulator_moves(lines).groupBy("app", "acc", "node", "metric").agg(F.coalesce(F.sum("update"), F.lit(0)).alias("total"))
    per_metric = added.groupBy("app", "acc").agg(F.max(F.struct("node", "metric")).alias("of"), F.sum("total").alias("total"))
    return per_metric.groupBy("app", F.col("of.node").alias("node"), F.col("of.metric").alias("metric")).agg(
        F.count("acc").alias("metrics"), F.sum("total").alias("total_updates")
    )


def metric_plan_join(lines: DataFrame) -> DataFrame:
    """Updates of accumulators that belong to a plan node, kinds of metric apart."""
    return node_updates(lines).where("node is not null")


def deceleration_gate(
    lines: DataFrame, limit: int = TRANSITION_LIMIT, nodes: Sequence[str] = ROW_TRANSITIONS, metric: str = ROWS_METRIC
) -> DataFrame:
    """Per application: updates of one metric of columnar-to-row nodes and whether they stay within the limit.

    Rows, batches and nanoseconds are not added to each other.
    """
    counts = F.coalesce(_has_any(F.col("node"), nodes) & (F.col("metric") == metric), F.lit(False))
    return (
        node_updates(lines).groupBy("app")
        .agg(F.coalesce(F.sum(F.when(counts, F.col("total_updates"))), F.lit(0)).alias("row_transition_updates"))
        .withColumn("gate_passed", F.col("row_transition_updates") <= limit)
    )


def app_features(lines: DataFrame, unsupported: Sequence[str]) -> DataFrame:
    """Counts per application that qualification rules look at."""
    value = F.col("value")
    plan = _event("org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart") | _event(
        "org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate"
    )
    job = _event("SparkListenerJobStart")
    return lines.groupBy("app").agg(
        F.count_if(_event("org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart")).alias("sql_executions"),
        F.count_if(plan & _has_any(value, PYTHON_EVALS)).alias("python_plans"),
        F.count_if(plan & _has_any(value, list(unsupported))).alias("unsupported_plans"),
        F.count_if(job).alias("jobs"),
        F.count_if(job & ~value.contains('"spark.sql.execution.id"')).alias("rdd_jobs"),
    )


def qualify(
    lines: DataFrame,
    unsupported: Sequence[str] = ("map<", "interval", "udt<"),
    rdd_share: float = 0.5,
    speedup: Mapping[str, float] | None = None,
) -> DataFrame:
    """Class and recommendation per application.

    Mostly jobs outside SQL make it ``rdd_heavy``; Python evaluation in a plan ``udf_decelerated``; types
    the native engine lacks ``unsupported_types``; anything else with SQL is ``pure_sql`` and the only
    class recommended. Thresholds, type marks and the assumed speed-up per class are the caller's.
    """
    assumed = {"pure_sql": 2.0, "udf_decelerated": 1.0, "unsupported_types": 1.0, "rdd_heavy": 1.0, **(speedup or {})}
    f = app_features(lines, unsupported)
    share = F.coalesce(F.try_divide(F.col("rdd_jobs").cast("double"), F.col("jobs")), F.lit(0.0))
    cls = (
        F.when((share > rdd_share) | ((F.col("sql_executions") == 0) & (F.col("rdd_jobs") > 0)), "rdd_heavy")
        .when(F.col("python_plans") > 0, "udf_decelerated")
        .when(F.col("unsupported_plans") > 0, "unsupported_types")
        .when(F.col("sql_executions") > 0, "pure_sql")
        .otherwise("no_work")
    )
    est = F.lit(1.0)
    for name, value in assumed.items():
        est = F.when(F.col("class") == name, F.lit(float(value))).otherwise(est)
    return f.withColumn("class", cls).select(
        F.col("app").alias("app_id"), "class", (F.col("class") == "pure_sql").alias("recommend"),
        est.alias("est_speedup"), "sql_executions", "python_plans", "unsupported_plans", "jobs", "rdd_jobs",
    )
