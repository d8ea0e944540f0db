"""Job records: filters, latest run, runtime conformance, A/B comparison and fleet savings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JOB_SCHEMA = (
    "struct<name:string,state:string,createTime:string,pysparkBatch:struct<mainPythonFileUri:string>,"
    "runtimeConfig:struct<properties:map<string,string>>,runtimeInfo:struct<properties:map<string,string>>>"
)
# Property looked up as prefixed key, then bare key, and the value that conforms.
CONFORMANCE = {
    "tier": ("dataproc:dataproc.tier", "dataproc.tier", "premium"),
    "engine": ("spark:spark.dataproc.engine", "spark.dataproc.engine", "lightningEngine"),
    "lightning_engine_runtime": (
        "spark:spark.dataproc.lightningEngine.runtime", "spark.dataproc.lightningEngine.runtime", "native",
    ),
}


def parse_jobs(df: DataFrame, column: str = "value") -> DataFrame:
    """Job records out of JSON text; a record that is no JSON becomes NULL fields."""
    return df.withColumn("job", F.from_json(column, JOB_SCHEMA)).select(
        *[c for c in df.columns if c != column], "job.*"
    )


def filter_jobs(df: DataFrame, script: str | None = None, names: Sequence[str] = ()) -> DataFrame:
    """Jobs that run a script or whose name holds one of the words; missing fields count as empty."""
    main = F.coalesce("pysparkBatch.mainPythonFileUri", F.lit(""))
    wanted = main.contains(script) if script else F.lit(False)
    for n in names:
        wanted = wanted | F.lower(F.coalesce("name", F.lit(""))).contains(n.lower())
    return df.where(wanted)


def recent_jobs(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` succeeded jobs; equal times are told apart by name."""
    return df.where("state = 'SUCCEEDED'").orderBy(F.col("createTime").desc_nulls_last(), F.col("name")).limit(n)


def latest_job(df: DataFrame, stage: str) -> DataFrame:
    """Of all succeeded jobs, the newest whose name holds the stage, else the newest."""
    match = F.lower(F.coalesce("name", F.lit(""))).contains(stage.lower())
    return df.where("state = 'SUCCEEDED'").orderBy(match.desc(), F.col("createTime").desc_nulls_last(), F.col("name")).limit(1)


def merge_maps(first: Column, second: Column) -> Column:
    """Union of two maps, the second winning. Session settings for repeated map keys do not matter."""
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(first, empty), F.coalesce(second, empty)
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(b, k)), b)


def runtime_conformance(df: DataFrame) -> DataFrame:
    """Job name, the three runtime properties ('' where unset) and whether all have the required value."""
    props = merge_maps(F.col("runtimeConfig.properties"), F.col("runtimeInfo.properties"))
    looked = df.withColumn("_props", props)

    def lookup(key: str) -> Column:
        return F.nullif(F.try_element_at("_props", F.lit(key)), F.lit(""))

    values = {n: F.coalesce(lookup(prefixed), lookup(bare), F.lit("")) for n, (prefixed, bare, _) in CONFORMANCE.items()}
    out = looked.select("name", *[v.alias(n) for n, v in values.items()])
    ok = F.lit(True)
    for n, (_, _, wanted) in CONFORMANCE.items():
        ok = ok & (F.col(n) == wanted)
    return out.select(
        F.element_at(F.split("name", "/"), -1).alias("batch_id"), *CONFORMANCE, ok.alias("conforms")
    )


def ab_compare(runs: DataFrame) -> DataFrame:
    """Standard and accelerated run of each benchmark job side by side.

    ``runs`` holds ``job, arm, seconds`` with arm ``standard`` or ``accelerated``; repeated runs are averaged.
    """
    arms = runs.groupBy("job").pivot("arm", ["standard", "accelerated"]).agg(F.avg("seconds"))
    return arms.select(
        "job",
        F.round("standard", 4).alias("standard_sec"),
        F.round("accelerated", 4).alias("accelerated_sec"),
        F.round(F.try_divide("standard", "accelerated"), 4).alias("speedup"),
    )


def fleet_roi(apps: DataFrame, rates: Mapping[str, tuple[float, float]], hourly_rate: float) -> DataFrame:
    """Cost before and after acceleration per class and for the fleet (class ``TOTAL``).

    ``apps`` holds ``app_id, class, runtime_hours``. ``rates`` gives per class the speed-up and the price
    factor of accelerated hours; a class without an entry stays as it is. All rates are the caller's. Hours, rates and costs are
    decimals, so sums are exact and do not depend on the order of rows; hours count to four decimals, the change of a class's cost to eight.
    """
    change = F.lit(Decimal(1)).cast("decimal(12,8)")
    for name, (speedup, factor) in rates.items():
        ratio = (Decimal(str(factor)) / Decimal(str(speedup))).quantize(Decimal("1.00000000"))
        change = F.when(F.col("class") == name, F.lit(ratio).cast("decimal(12,8)")).otherwise(change)
    rate = F.lit(Decimal(str(hourly_rate))).cast("decimal(10,4)")
    cost = apps.select("class", (F.col("runtime_hours").cast("decimal(16,4)") * rate).cast("decimal(26,8)").alias("baseline")).withColumn(
        "projected", (F.col("baseline") * change).cast("decimal(38,12)")
    )
    rolled = cost.rollup("class").agg(
        F.grouping("class").alias("g"),
        F.count(F.lit(1)).alias("apps"),
        F.sum("baseline").alias("baseline"),
        F.sum("projected").alias("projected"),
    )
    saving = F.col("baseline") - F.col("projected")
    return rolled.select(
        F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("class")).alias("class"),
        "apps",
        F.round("baseline", 2).cast("decimal(38,2)").alias("baseline_cost"),
        F.round("projected", 2).cast("decimal(38,2)").alias("projected_cost"),
        F.round(saving, 2).cast("decimal(38,2)").alias("saving"),
        F.round(F.try_divide(saving.cast("double"), F.col("projected").cast("double")), 4).alias("roi"),
    )
