"""Parquet table scans and the derived test views (order lines, stock checks).

The views turn the TPC-H-like test tables into the domain's inputs:
``lines`` (one row per order item), ``stock`` (two checks per key) and
``orders_nested`` (orders with an ``items`` array). Only the columns the
views use are read, so the Parquet scans carry a pruned ReadSchema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.session import use_utc

# fixed values of the test views: time origin of all derived instants
# (2021-01-01 00:00:00 UTC, in epoch seconds) and the hour arithmetic below
ORIGIN_EPOCH_SECONDS = 1609459200
CREATED_MULT, CREATED_MOD = 37, 672
DELIVER_MULT, DELIVER_MOD = 53, 1080
STOCK_SECOND_CHECK_HOURS = 336
STOCK_LATE_HOURS = 200
#: Parts whose checks (ten of each) one task makes.
PARTS_A_TASK = 1 << 16
STATUS_BY_ORDER_STATUS = {"F": "DELIVERED", "P": "PREPARED"}  # anything else: CAPTURED


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hours_after_origin(hours) -> F.Column:
    return F.timestamp_seconds(F.lit(ORIGIN_EPOCH_SECONDS) + hours.cast("long") * 3600)


def customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey → region name; nation and region are fixed-size TPC-H dimensions
    (25 and 5 rows), which Spark broadcasts by its own size check."""
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", F.col("r_name").alias("store"))
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order item: store, product, order_id, line_no, quantity,
    created_at, deliver_at, status. Returned-and-finished items carry quantity 0,
    the retraction signal of the order fold."""
    use_utc(spark)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    items = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    created_h = F.col("o_orderkey") * CREATED_MULT % CREATED_MOD
    deliver_h = created_h + F.col("o_orderkey") * DELIVER_MULT % DELIVER_MOD
    status = F.coalesce(
        *[F.when(F.col("o_orderstatus") == k, F.lit(v)) for k, v in STATUS_BY_ORDER_STATUS.items()],
        F.lit("CAPTURED"),
    )
    order_rows = orders.join(customer_region(spark, sf_dir), orders.o_custkey == F.col("c_custkey")).select(
        "o_orderkey",
        "store",
        hours_after_origin(created_h).alias("created_at"),
        hours_after_origin(deliver_h).alias("deliver_at"),
        status.alias("status"),
    )
    return items.join(order_rows, items.l_orderkey == order_rows.o_orderkey).select(
        "store",
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias("product"),
        F.col("o_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit(0.0))
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
        "created_at",
        "deliver_at",
        "status",
    )


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stock checks per (region, part).

    Checks of every tenth part arrive late, so that orders come before any
    stock is known. The second check arrives two weeks later; for every fourth part it is a
    late one (its ``checked_at`` is older than the first check's).
    The region side is the 5-row TPC-H dimension, so the product with parts is
    a broadcast of a fixed-size table; the two checks are a constant fan-out.
    """
    use_utc(spark)
    region = read_table(spark, sf_dir, "region").select(F.col("r_name").alias("store"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    # two narrow columns make few splits, and each row becomes ten: deal them out first
    parts = -(-part.count() // PARTS_A_TASK)
    part = part.repartition(parts, "p_partkey") if parts > 1 else part
    c = F.col("check_no")
    late_h = F.when(F.col("p_partkey") % 10 == 0, F.lit(STOCK_LATE_HOURS)).otherwise(0)
    checked_h = (
        F.when(c == 0, F.col("p_partkey") % 48)
        .when(F.col("p_partkey") % 4 == 0, F.lit(-120))
        .otherwise(F.lit(STOCK_SECOND_CHECK_HOURS) + F.col("p_partkey") % 24)
    )
    return (
        part.crossJoin(F.broadcast(region))
        .select("store", "p_partkey", "p_size", F.explode(F.array(F.lit(0), F.lit(1))).alias("check_no"))
        .select(
            "store",
            F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("product"),
            "check_no",
            hours_after_origin(F.lit(STOCK_SECOND_CHECK_HOURS) * c + late_h).alias("arrived_at"),
            hours_after_origin(checked_h).alias("checked_at"),
            (F.col("p_size") * (10 - 3 * c)).cast("double").alias("quantity"),
        )
    )


def orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their items nested, as an order stream carries them.

    Items keep their ``line_no`` so that flattening gives back the same lines.
    The group is one order (a handful of items), never a whole key.
    """
    return (
        lines(spark, sf_dir)
        .groupBy("order_id", "store", "created_at", "deliver_at", "status")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "product", "quantity"))).alias("items"))
    )
