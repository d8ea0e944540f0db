"""Event-log lines and job records, derived from the ``events`` table.

Eight consecutive events make one block; blocks go round 40 applications. Within a block the first
event is a plan, the second an adaptive update, then two task ends, a driver update, a job start and
two other lines. As in ``derived``, the expressions mean the same in other SQL engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources.derived import table

APPS = 40
BLOCK = "cast(floor(event_id / 8) as bigint)"
APP_NO = f"({BLOCK} % {APPS})"
APP = f"'app-' || lpad(cast({APP_NO} as string),4,'0')"
# accumulator ids: block * 10 + 1 (rows of the transition), + 4 and + 5 (its batches and time), + 2 (scan), + 3 (project)
_ID = f"cast({BLOCK} * 10 + {{}} as string)"


def _node(name: str, simple: str, children: str, *metrics: tuple[str, int]) -> str:
    listed = " || ',' || ".join(
        f"'{{\"name\":\"{metric}\",\"accumulatorId\":' || {_ID.format(acc)} || ',\"metricType\":\"sum\"}}'" for metric, acc in metrics
    )
    return (
        f"'{{\"nodeName\":\"' || {name} || '\",\"simpleString\":\"' || {simple} || '\",\"children\":[' || {children} ||"
        f" '],\"metadata\":{{}},\"metrics\":[' || {listed} || ']}}'"
    )


_SCAN = _node("'Scan parquet'", f"case when {APP_NO} % 5 = 2 then 'props: map<string,string>' else 'id: bigint' end",
              "''", ("number of output rows", 2))
_TRANSITION = _node(
    f"case {APP_NO} % 3 when 0 then 'ColumnarToRow' when 1 then 'VeloxColumnarToRow' else 'FilterExecTransformer' end",
    "'transition'", _SCAN, ("batches [in]", 4), ("number of output rows", 1), ("time", 5),
)
_ROOT = _node(f"case when {APP_NO} % 5 = 1 then 'BatchEvalPython' else 'Project' end", "'[f(id)]'",
              _TRANSITION, ("data sent to workers", 3))
_UI = "org.apache.spark.sql.execution.ui."
LINE = (
    "case event_id % 8 "
    f"when 0 then '{{\"Event\":\"{_UI}SparkListenerSQLExecutionStart\",\"executionId\":' || cast({BLOCK} as string) ||"
    f" ',\"physicalPlanDescription\":\"plan\",\"sparkPlanInfo\":' || {_ROOT} || '}}' "
    f"when 1 then '{{\"Event\":\"{_UI}SparkListenerSQLAdaptiveExecutionUpdate\",\"executionId\":' || cast({BLOCK} as string) ||"
    f" ',\"sparkPlanInfo\":' || {_TRANSITION} || '}}' "
    "when 2 then '{\"Event\":\"SparkListenerTaskEnd\",\"Stage ID\":1,\"Task Info\":{\"Task ID\":' || cast(event_id as string) ||"
    f" ',\"Accumulables\":[{{\"ID\":' || {_ID.format(1)} || ',\"Name\":\"number of output rows\",\"Update\":\"' ||"
    f" cast(event_id % 50 as string) || '\",\"Internal\":true}},{{\"ID\":' || {_ID.format(4)} || ',\"Update\":\"' || cast(event_id % 3 as string) ||"
    f" '\"}},{{\"ID\":' || {_ID.format(5)} || ',\"Update\":\"' || cast(event_id % 900000 as string) || '\"}}]}}}}' "
    "when 3 then '{\"Event\":\"SparkListenerTaskEnd\",\"Stage ID\":1,\"Task Info\":{\"Task ID\":' || cast(event_id as string) ||"
    f" ',\"Accumulables\":[{{\"ID\":' || {_ID.format(1)} || ',\"Update\":' || cast(event_id % 7 as string) || '}},{{\"ID\":' ||"
    f" {_ID.format(2)} || ',\"Update\":\"' || cast(event_id % 11 as string) || '\"}}]}}}}' "
    f"when 4 then '{{\"Event\":\"{_UI}SparkListenerDriverAccumUpdates\",\"executionId\":' || cast({BLOCK} as string) ||"
    f" ',\"accumUpdates\":[[' || {_ID.format(1)} || ',' || cast(event_id % 13 as string) || '],[' || {_ID.format(9)} || ',5]]}}' "
    f"when 5 then '{{\"Event\":\"SparkListenerJobStart\",\"Job ID\":' || cast(event_id as string) || ',\"Properties\":{{' ||"
    f" case when {APP_NO} % 5 = 3 then '' else '\"spark.sql.execution.id\":\"' || cast({BLOCK} as string) || '\"' end || '}}}}' "
    "when 6 then '{\"Event\":\"SparkListenerStageCompleted\"}' else '' end"
)
JOB_STAGE = "case event_id % 4 when 0 then 'bronze' when 1 then 'silver' when 2 then 'gold' else 'benchmark' end"
JOB_NAME = f"'projects/p/batches/' || {JOB_STAGE} || '-' || cast(event_id as string)"
JOB_STATE = "case when event_id % 3 = 0 then 'FAILED' else 'SUCCEEDED' end"
JOB_TIME = "replace(substring(cast(ts as string),1,19),' ','T') || 'Z'"
JOB_SCRIPT = "case when event_id % 4 = 3 then 'pure_sql_benchmark.py' else 'etl.py' end"
JOB_TIER = "case when event_id % 2 = 0 then 'premium' else 'standard' end"
JOB_ENGINE = "case when event_id % 6 = 0 then 'default' else 'lightningEngine' end"
JOB_RECORD = (
    f"'{{\"name\":\"' || {JOB_NAME} || '\",\"state\":\"' || {JOB_STATE} || '\",\"createTime\":\"' || {JOB_TIME} || '\"' ||"
    f" case when event_id % 9 = 0 then '' else ',\"pysparkBatch\":{{\"mainPythonFileUri\":\"gs/' || {JOB_SCRIPT} || '\"}}' end ||"
    f" ',\"runtimeConfig\":{{\"properties\":{{\"dataproc.tier\":\"' || {JOB_TIER} || '\",\"spark.dataproc.engine\":\"default\",'"
    " || '\"spark.dataproc.lightningEngine.runtime\":\"native\"}}' ||"
    " case when event_id % 10 = 0 then '' else ',\"runtimeInfo\":{\"properties\":{\"spark.dataproc.engine\":\"' ||"
    f" {JOB_ENGINE} || '\"' || case when event_id % 14 = 0 then ',\"dataproc:dataproc.tier\":\"premium\"' else '' end || '}}}}' end || '}}'"
)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as ``scan_event_log`` returns them, one per event, in splits of 100,000 events."""
    return table(spark, sf_dir, "events").selectExpr(
        f"'logs/' || {APP} || '.json' as path", f"{APP} as app", "0L as part",
        "cast(floor(event_id / 100000) as bigint) * 100000 as block_start", "event_id as seq", f"{LINE} as value"
    )


def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON job record per event."""
    return table(spark, sf_dir, "events").selectExpr(f"{JOB_RECORD} as value")


def write_logs(lines: DataFrame, path: str, codec: str | None = None) -> None:
    """Write lines as a folder of text files per application; a large log spans several files, in order."""
    out = lines.repartitionByRange("app", "seq").sortWithinPartitions("app", "seq").select("value", "app")
    writer = out.write.partitionBy("app")
    (writer.option("compression", codec) if codec else writer).text(path)
