"""Stock projection: for days 1..N, stock on hand minus cumulated demand.

Demand of an order info lands on day offset ``day_offset(stock date,
delivery date)``; offsets outside 0..N-1 are ignored. Day d (1-based) shows
``stock - sum(demand at offsets 0..d-1)``, once per slice A and B.

Two forms:

* flat (bulk snapshot): live infos are pre-aggregated per (key, delivery
  date), joined to the stock date, and folded into the N cumulative sums
  with one grouped aggregation of conditional sums: no day spine, no window.
* nested (one record at a time, for replay and streaming): higher-order
  functions over the info array of a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.functions.dates import PERIOD_DAYS, day_offset
from stockcast.schemas import KEYS, SLICES


def check_days(days: int) -> int:
    if int(days) < 1:
        raise ValueError(f"the projection horizon must be at least one day, got {days}")
    return int(days)


def stock_dates(stock_tbl: DataFrame) -> DataFrame:
    return stock_tbl.select(*KEYS, F.to_date("checked_at").alias("stock_date"))


def _demand_per_delivery_date(live_rows: DataFrame) -> DataFrame:
    # map-side combinable: a hot key shrinks to one row per delivery date and task
    return live_rows.groupBy(*KEYS, F.to_date("deliver_at").alias("deliver_date")).agg(
        F.sum("quantity").alias("quantity")
    )


def demand_by_offset(live_rows: DataFrame, stock_tbl: DataFrame, mode: str = PERIOD_DAYS) -> DataFrame:
    """Sum of live demand per (key, day offset from the key's stock date), all offsets."""
    joined = _demand_per_delivery_date(live_rows).join(stock_dates(stock_tbl), KEYS)
    return (
        joined.select(*KEYS, day_offset("stock_date", "deliver_date", mode).alias("offset"), "quantity")
        .groupBy(*KEYS, "offset")
        .agg(F.sum("quantity").alias("quantity"))
    )


def cumulative_sums(offset: Column, quantity: Column, days: int) -> Column:
    """Aggregate expression: array of the N running demand totals (offsets 0..d-1)."""
    return F.array(
        *[
            F.coalesce(F.sum(F.when((offset >= 0) & (offset <= d), quantity)), F.lit(0.0))
            for d in range(check_days(days))
        ]
    )


def cumulative_demand(
    live_rows: DataFrame, stock_tbl: DataFrame, days: int, mode: str = PERIOD_DAYS
) -> DataFrame:
    """Per key with an order state: ``cumulated`` = N running totals of demand."""
    joined = _demand_per_delivery_date(live_rows).join(stock_dates(stock_tbl), KEYS)
    offset = day_offset("stock_date", "deliver_date", mode)
    return joined.groupBy(*KEYS).agg(cumulative_sums(offset, F.col("quantity"), days).alias("cumulated"))


def _snapshot_totals(stock_tbl: DataFrame, live_rows: DataFrame, days: int, mode: str) -> DataFrame:
    """Per key of the stock table: current_quantity, ``cumulated`` (N totals) and
    has_orders. One join; the grouping keeps its partitioning."""
    demand = _demand_per_delivery_date(live_rows).withColumnRenamed("quantity", "due")
    checks = stock_tbl.select(*KEYS, F.col("quantity").alias("current_quantity"), F.to_date("checked_at").alias("stock_date"))
    offset = day_offset("stock_date", "deliver_date", mode)
    return (
        checks.join(demand, KEYS, "left")
        .groupBy(*KEYS, "current_quantity")
        .agg(cumulative_sums(offset, F.col("due"), days).alias("cumulated"), F.max(F.col("due").isNotNull()).alias("has_orders"))
    )


def project_snapshot(
    stock_tbl: DataFrame,
    live_rows: DataFrame,
    days: int,
    mode: str = PERIOD_DAYS,
    created_at: Column | None = None,
) -> DataFrame:
    """Flat projection lines for every key of the stock table.

    Output: store, product, [created_at], current_quantity, has_orders, day,
    slice, quantity. Keys with no order state project their stock flat.
    """
    extra = [created_at.alias("created_at")] if created_at is not None else []
    totals = _snapshot_totals(stock_tbl, live_rows, check_days(days), mode)
    base = totals.select(*KEYS, *extra, "current_quantity", "has_orders", F.posexplode("cumulated").alias("day0", "cumulated"))
    return base.select(
        *KEYS,
        *[c for c in ["created_at"] if extra],
        "current_quantity",
        "has_orders",
        (F.col("day0") + 1).cast("int").alias("day"),
        F.explode(F.array(*[F.lit(s) for s in SLICES])).alias("slice"),
        (F.col("current_quantity") - F.col("cumulated")).alias("quantity"),
    )


def project_snapshot_records(
    stock_tbl: DataFrame,
    live_rows: DataFrame,
    days: int,
    mode: str = PERIOD_DAYS,
    created_at: Column | None = None,
) -> DataFrame:
    """The snapshot as projection records: store, product, projection struct
    (store, product, created_at, current_quantity, lines), one per stock key."""

    def of_day(cumulated, k):
        left = F.col("current_quantity") - cumulated
        return F.array(*[F.struct((k + 1).alias("day"), F.lit(s).alias("slice"), left.alias("quantity")) for s in SLICES])

    created = created_at if created_at is not None else F.current_timestamp()
    return _snapshot_totals(stock_tbl, live_rows, check_days(days), mode).select(
        *KEYS,
        F.struct(
            "store",
            "product",
            created.alias("created_at"),
            "current_quantity",
            F.flatten(F.transform("cumulated", of_day)).alias("lines"),
        ).alias("projection"),
    )


# ---- nested form: one projection record computed inside a row ----


def projection_lines_expr(
    stock_quantity: Column, stock_date: Column, info: Column, days: int, mode: str = PERIOD_DAYS
) -> Column:
    """Array<struct<day, slice, quantity>> for one row holding an info array.

    ``info`` may be NULL (no order state): the stock is projected flat.
    """
    days = check_days(days)

    def remaining(d: Column) -> Column:
        due = F.filter(
            info,
            lambda i: (day_offset(stock_date, F.to_date(i["deliver_at"]), mode) >= 0)
            & (day_offset(stock_date, F.to_date(i["deliver_at"]), mode) <= d - 1),
        )
        # a NULL info array (no order state) sums to nothing
        return stock_quantity - F.coalesce(F.aggregate(due, F.lit(0.0), lambda acc, i: acc + i["quantity"]), F.lit(0.0))

    per_day = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda d: F.struct(d.alias("day"), remaining(d).alias("q")))
    return F.flatten(
        F.transform(
            per_day,
            lambda x: F.array(
                *[
                    F.struct(x["day"].alias("day"), F.lit(s).alias("slice"), x["q"].alias("quantity"))
                    for s in SLICES
                ]
            ),
        )
    )
