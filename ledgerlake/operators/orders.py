"""Order enrichment in native expressions, the counterpart of a row-by-row Python function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.joins import BROADCAST_LIMIT, join_dim, plan_bytes


def enrich_orders(orders: DataFrame, customer: DataFrame, nation: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Orders with customer segment, nation, price band, priority rank, order month and status.

    Dimensions are joined by ``join_dim``: broadcast within a checked size, else shuffled with its hot keys salted.
    """
    customers = customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    located = join_dim(
        customers,
        nation.select("n_nationkey", "n_name"),
        ["n_nationkey"],
        limit=limit,
    ).drop("n_nationkey")
    # a customer has one nation, whose columns are no wider than its own: the join at most doubles the size
    size = plan_bytes(customers)
    joined = join_dim(orders, located, ["o_custkey"], "left", ["o_orderkey"], limit=limit, size=None if size is None else 2 * size)
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return joined.select(
        "o_orderkey",
        "o_custkey",
        F.upper(F.btrim("c_mktsegment")).alias("segment"),
        F.initcap(F.lower("n_name")).alias("nation"),
        price.alias("price_usd"),
        F.when(price >= 300000, "HIGH").when(price >= 100000, "MEDIUM").otherwise("LOW").alias("price_band"),
        F.regexp_extract("o_orderpriority", r"^([0-9]+)", 1).try_cast("int").alias("priority_rank"),
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
        F.when(F.col("o_orderstatus") == "F", "FULFILLED").when(F.col("o_orderstatus") == "O", "OPEN")
        .otherwise("PARTIAL").alias("status"),
    )
