"""Read-side views and the small operators around the service.

* table views: the first rows of the stock / order tables, formatted for
  reading (over all partitions, in (store, product) order, 100 rows);
* topic categories: input / output / debug topic of a record;
* the two-input operation of the learning app, in its two natural forms:
  a merge of both streams, and a keyed as-of left join.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.functions.dates import readable_time
from stockcast.operators.scan import before, joined, weighed
from stockcast.schemas import KEYS

VIEW_ROWS = 100

# fixed values: the topics of the service and their kind
INPUT_TOPICS = ["stock-stream", "order-stream"]
PROJECTION_TOPIC = "projection-stream"
PROJECTION_ON_STOCK_TOPIC, PROJECTION_ON_ORDER_TOPIC = "projection-on-stock", "projection-on-order"
ORDER_TABLE_TOPIC = "order-table-output"
OUTPUT_TOPICS = [PROJECTION_TOPIC]
DEBUG_TOPICS = [PROJECTION_ON_STOCK_TOPIC, PROJECTION_ON_ORDER_TOPIC, ORDER_TABLE_TOPIC]
TOPIC_KINDS = {
    **{t: "Input" for t in INPUT_TOPICS},
    **{t: "Output" for t in OUTPUT_TOPICS},
    **{t: "Debug" for t in DEBUG_TOPICS},
}
ALL_TOPICS = INPUT_TOPICS + OUTPUT_TOPICS + DEBUG_TOPICS


def topic_kind(topic) -> Column:
    """Kind of a topic (Input / Output / Debug), NULL for an unknown one."""
    t = F.col(topic) if isinstance(topic, str) else topic
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in TOPIC_KINDS.items()))
    return lookup[t]


def categorize(records: DataFrame, topic: str = "topic") -> DataFrame:
    """Records per topic with its kind: topic, kind, records."""
    return records.groupBy(topic).agg(F.count(F.lit(1)).alias("records")).select(
        F.col(topic).alias("topic"), topic_kind(topic).alias("kind"), "records"
    )


def stock_table_view(stock_tbl: DataFrame, rows: int = VIEW_ROWS) -> DataFrame:
    """First rows of the stock table: store, product, checked_at (readable), quantity."""
    return (
        stock_tbl.select(*KEYS, readable_time("checked_at").alias("checked_at"), "quantity")
        .orderBy(*KEYS)
        .limit(rows)
    )


def order_info_text(quantity, order_id, status, created_at) -> Column:
    """One info as text: ``<orderId> => <quantity> (<status> - <created at>)``."""
    return F.concat(
        order_id.cast("string"),
        F.lit(" => "),
        quantity.cast("string"),
        F.lit(" ("),
        status,
        F.lit(" - "),
        readable_time(created_at),
        F.lit(")"),
    )


def order_table_view(live_rows: DataFrame, rows: int = VIEW_ROWS) -> DataFrame:
    """First rows of the order table: store, product, infos as text lines.

    The first keys are picked before any text is built (a top-k over the
    distinct keys, bounded by ``rows``), so only those keys' infos are
    gathered. ``live_rows`` carries ``rn`` (arrival rank) for the line order.
    """
    first_keys = live_rows.select(*KEYS).distinct().orderBy(*KEYS).limit(rows)
    picked = live_rows.join(F.broadcast(first_keys), KEYS, "left_semi")
    text = F.struct("rn", order_info_text(F.col("quantity"), F.col("order_id"), F.col("status"), F.col("created_at")).alias("t"))
    return (
        picked.groupBy(*KEYS)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(text)), lambda x: x["t"]), "\n").alias("info"))
        .orderBy(*KEYS)
    )


def dual_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs as one stream (duplicates kept), tagged with their side."""
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))


def asof_left_join(
    left: DataFrame, right: DataFrame, key: str, time: str, right_cols: list[str], parts: int | None = None
) -> DataFrame:
    """For each left row, the latest right row of the same key at or before it
    (NULLs when none). On a time tie the right row is taken as already seen; of
    right rows at the same time the one with the greatest ``right_cols`` counts.
    A null key or time on either side matches nothing.

    Both sides are exchanged once on the key; a key with more than a task's share of the
    rows is cut along its time (``operators.scan``) and what was last seen is
    carried from chunk to chunk."""
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    r = right.where(known).select(key, time, F.struct(*right_cols).alias("_r"), F.lit(0).alias("_side"))
    l_cols = [c for c in left.columns if c not in (key, time)]
    l = left.select(key, time, F.struct(*l_cols).alias("_l"), F.lit(1).alias("_side"))
    order = [time, "_side", "_r"]
    seen = [F.col(f"_seen.{c}").alias(f"right_{c}") for c in right_cols]
    out = []
    for part in weighed(l.where(known).unionByName(r, allowMissingColumns=True), [key], order, parts):
        run = part.window().orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        part = part.with_rows(part.rows.withColumn("_own", F.last("_r", ignorenulls=True).over(run)))
        part = part.entered(
            [key],
            {"_last": F.max(F.when(F.col("_side") == 0, F.struct(time, "_r")))},
            lambda chunks: {"_in": F.max("_last").over(before(chunks))["_r"]},
            {"_in": F.lit(None).cast(r.schema["_r"].dataType)},
        )
        rows = part.rows.where(F.col("_side") == 1).withColumn("_seen", F.coalesce("_own", "_in"))
        out.append(rows.select(key, time, "_l.*", *seen))
    unplaced = l.where(~known).withColumn("_seen", F.lit(None).cast(r.schema["_r"].dataType))
    return joined([*out, unplaced.select(key, time, "_l.*", *seen)])
