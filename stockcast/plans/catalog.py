"""The registered queries: each a Spark plan over the test tables plus, where
SQL can say it, the DuckDB oracle text for the same flat result.

Flat results only (one row per line / info / projection line), instants as
epoch milliseconds (``*_ms``), dates as ISO text, integer widths fixed by
casts, so that the two engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.functions.dates import CALENDAR_DAYS, PERIOD_DAYS, day_offset, readable_time
from stockcast.operators import history as H
from stockcast.operators import orders as O
from stockcast.operators import projection as P
from stockcast.operators import replay as R
from stockcast.operators import stocks as S
from stockcast.operators import views as V
from stockcast.functions import codec as C
from stockcast.functions import text as TX
from stockcast.sources import streams as ST
from stockcast.streaming import native as NV
from stockcast.streaming import service as SV
from stockcast.plans import oracle as Q
from stockcast.schemas import DEFAULT_DAYS, INFO_FIELDS, KEYS
from stockcast.session import scratch_path, use_utc
from stockcast.sources import tables

DAYS = DEFAULT_DAYS


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(fn, oracle)
        return fn

    return deco


def ms(c: str, alias: str | None = None):
    return F.unix_millis(F.col(c)).alias(alias or f"{c}_ms")


def info_flat(prefix: str = "") -> list:
    p = f"{prefix}." if prefix else ""
    return [
        F.col(f"{p}quantity").alias("quantity"),
        F.col(f"{p}order_id").alias("order_id"),
        F.unix_millis(F.col(f"{p}created_at")).alias("created_at_ms"),
        F.unix_millis(F.col(f"{p}deliver_at")).alias("deliver_at_ms"),
        F.col(f"{p}status").alias("status"),
    ]


INFO_FLAT_SQL = "quantity, order_id, epoch_ms(created_at) AS created_at_ms, epoch_ms(deliver_at) AS deliver_at_ms, status"


def _inputs(spark: SparkSession, sf_dir: str):
    use_utc(spark)
    return tables.lines(spark, sf_dir), tables.stock(spark, sf_dir)


# ---------------------------------------------------------------- flatten


@register(
    "explode_order_lines",
    Q.with_(Q.LINES)
    + "SELECT store, product, order_id, line_no, "
    + INFO_FLAT_SQL.replace("quantity, order_id, ", "quantity, ")
    + " FROM lines",
)
def explode_order_lines(spark, sf_dir):
    use_utc(spark)
    flat = O.explode_lines(tables.orders_nested(spark, sf_dir))
    return flat.select(
        *KEYS, "order_id", "line_no", "quantity", ms("created_at"), ms("deliver_at"), "status"
    )


@register("order_line_info", Q.with_(Q.LINES) + f"SELECT store, product, {INFO_FLAT_SQL} FROM lines")
def order_line_info(spark, sf_dir):
    use_utc(spark)
    single = O.line_info(O.explode_lines(tables.orders_nested(spark, sf_dir)))
    return single.select(*KEYS, F.explode("info").alias("i")).select(*KEYS, *info_flat("i"))


@register(
    "nonpositive_orders",
    Q.with_(Q.LINES)
    + "SELECT order_id, store, count(*) AS item_count FROM lines GROUP BY order_id, store HAVING min(quantity) <= 0",
)
def nonpositive_orders(spark, sf_dir):
    use_utc(spark)
    found = O.nonpositive_orders(tables.orders_nested(spark, sf_dir))
    return found.select("order_id", "store", F.size("items").cast("long").alias("item_count"))


# ---------------------------------------------------------------- fold


@register(
    "order_table",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"), Q.live_infos("f", "live"))
    + f"SELECT store, product, {INFO_FLAT_SQL} FROM live",
)
def order_table(spark, sf_dir):
    lines, _ = _inputs(spark, sf_dir)
    return O.order_table_rows(lines).select(*KEYS, *info_flat())


@register(
    "order_table_changelog",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"))
    + f"""
, pairs AS (
  SELECT DISTINCT a.store, a.product, a.rn, b.quantity, b.order_id, b.created_at, b.deliver_at, b.status
  FROM f a JOIN f b ON a.store=b.store AND a.product=b.product AND a.occ=1
   AND b.rn > a.lastempty AND b.rn <= a.rn),
agg AS (SELECT store, product, rn, count(*) AS n, sum(quantity) AS q FROM pairs GROUP BY store, product, rn)
SELECT f.store, f.product, CAST(f.rn AS BIGINT) AS rn, f.order_id, f.line_no, f.occ=0 AS deleted,
       coalesce(agg.n, 0) AS info_count, coalesce(agg.q, 0.0) AS live_quantity
FROM f LEFT JOIN agg ON f.store=agg.store AND f.product=agg.product AND f.rn=agg.rn""",
)
def order_table_changelog(spark, sf_dir):
    lines, _ = _inputs(spark, sf_dir)
    log = O.order_table_changelog(lines)
    return log.select(
        *KEYS,
        F.col("rn").cast("long").alias("rn"),
        "order_id",
        "line_no",
        "deleted",
        F.col("info_count").cast("long").alias("info_count"),
        "live_quantity",
    )


@register(
    "merge_orders",
    Q.with_(
        Q.LINES,
        "even AS (SELECT * FROM lines WHERE order_id % 2 = 0)",
        "odd AS (SELECT * FROM lines WHERE order_id % 2 = 1)",
        Q.fold_states("even", "fe"),
        Q.live_infos("fe", "le"),
        Q.fold_states("odd", "fo"),
        Q.live_infos("fo", "lo"),
    )
    + f"""SELECT store, product, {INFO_FLAT_SQL}, min(side) AS side, arg_min(rn, side) AS rn FROM (
  SELECT *, 0 AS side FROM le UNION ALL
  SELECT *, 1 AS side FROM lo WHERE (store, product) IN (SELECT store, product FROM le))
GROUP BY store, product, {Q.INFO}""",
)
def merge_orders(spark, sf_dir):
    """Two order tables (lines of even / odd orders) merged per key: the first
    table's infos then the second's, without repeats, with their place in that
    list; keys only in the second table stay out (the merge is driven by the first)."""
    lines, _ = _inputs(spark, sf_dir)
    merged = O.merged_tables(lines, F.col("order_id") % 2)
    return merged.select(*KEYS, *info_flat(), "side", "rn")


# ---------------------------------------------------------------- stock


@register(
    "stock_table",
    Q.with_(Q.STOCK, Q.STOCK_TABLE)
    + "SELECT store, product, check_no, epoch_ms(checked_at) AS checked_at_ms, quantity FROM stock_table",
)
def stock_table(spark, sf_dir):
    _, stock = _inputs(spark, sf_dir)
    return S.stock_table(stock).select(*KEYS, "check_no", ms("checked_at"), "quantity")


# ---------------------------------------------------------------- dates


@register(
    "instant_to_date",
    Q.with_(Q.LINES)
    + """SELECT store, product, order_id, line_no,
       strftime(CAST(created_at AS DATE), '%Y-%m-%d') AS created_date,
       strftime(CAST(deliver_at AS DATE), '%Y-%m-%d') AS deliver_date FROM lines""",
)
def instant_to_date(spark, sf_dir):
    lines, _ = _inputs(spark, sf_dir)
    return lines.select(
        *KEYS,
        "order_id",
        "line_no",
        F.date_format(F.to_date("created_at"), "yyyy-MM-dd").alias("created_date"),
        F.date_format(F.to_date("deliver_at"), "yyyy-MM-dd").alias("deliver_date"),
    )


@register(
    "day_offset",
    Q.with_(Q.LINES, Q.STOCK, Q.STOCK_TABLE)
    + f"""SELECT l.store, l.product, l.order_id, l.line_no,
       strftime(CAST(s.checked_at AS DATE), '%Y-%m-%d') AS stock_date,
       strftime(CAST(l.deliver_at AS DATE), '%Y-%m-%d') AS deliver_date,
       CAST({Q.period_days("CAST(s.checked_at AS DATE)", "CAST(l.deliver_at AS DATE)")} AS INTEGER) AS period_offset,
       CAST(date_diff('day', CAST(s.checked_at AS DATE), CAST(l.deliver_at AS DATE)) AS INTEGER) AS calendar_offset
FROM lines l JOIN stock_table s ON l.store=s.store AND l.product=s.product""",
)
def day_offset_query(spark, sf_dir):
    lines, stock = _inputs(spark, sf_dir)
    j = lines.join(P.stock_dates(S.stock_table(stock)), KEYS).withColumn("deliver_date", F.to_date("deliver_at"))
    return j.select(
        *KEYS,
        "order_id",
        "line_no",
        F.date_format("stock_date", "yyyy-MM-dd").alias("stock_date"),
        F.date_format("deliver_date", "yyyy-MM-dd").alias("deliver_date"),
        day_offset("stock_date", "deliver_date", PERIOD_DAYS).cast("int").alias("period_offset"),
        day_offset("stock_date", "deliver_date", CALENDAR_DAYS).cast("int").alias("calendar_offset"),
    )


# ---------------------------------------------------------------- projection

_SNAP_CTES = (Q.LINES, Q.STOCK, Q.STOCK_TABLE, Q.fold_states("lines", "f"), Q.live_infos("f", "live"))
_OFFSETS = f"""offs AS (
  SELECT s.store, s.product, l.quantity,
         {Q.period_days("CAST(s.checked_at AS DATE)", "CAST(l.deliver_at AS DATE)")} AS o
  FROM stock_table s JOIN live l ON s.store=l.store AND s.product=l.product)"""
_CUM = f"""cum AS (
  SELECT k.store, k.product, dd.day,
         coalesce((SELECT sum(quantity) FROM offs WHERE offs.store=k.store AND offs.product=k.product
                   AND o BETWEEN 0 AND dd.day-1), 0.0) AS quantity
  FROM (SELECT DISTINCT store, product FROM offs) k CROSS JOIN {Q.day_values(DAYS)})"""


def _snapshot(spark, sf_dir):
    lines, stock = _inputs(spark, sf_dir)
    return P.project_snapshot(S.stock_table(stock), O.order_table_rows(lines), DAYS)


@register(
    "demand_by_day",
    Q.with_(*_SNAP_CTES, _OFFSETS)
    + "SELECT store, product, CAST(o AS INTEGER) AS offset, sum(quantity) AS quantity FROM offs GROUP BY store, product, o",
)
def demand_by_day(spark, sf_dir):
    lines, stock = _inputs(spark, sf_dir)
    d = P.demand_by_offset(O.order_table_rows(lines), S.stock_table(stock))
    return d.select(*KEYS, F.col("offset").cast("int").alias("offset"), "quantity")


@register(
    "cumulative_demand",
    Q.with_(*_SNAP_CTES, _OFFSETS, _CUM) + "SELECT store, product, CAST(day AS INTEGER) AS day, quantity FROM cum",
)
def cumulative_demand(spark, sf_dir):
    lines, stock = _inputs(spark, sf_dir)
    c = P.cumulative_demand(O.order_table_rows(lines), S.stock_table(stock), DAYS)
    return c.select(*KEYS, F.posexplode("cumulated").alias("d", "quantity")).select(
        *KEYS, (F.col("d") + 1).cast("int").alias("day"), "quantity"
    )


_SNAP_SELECT = f"""SELECT s.store, s.product, s.quantity AS current_quantity, CAST(dd.day AS INTEGER) AS day, sl.slice,
       s.quantity - coalesce(c.quantity, 0.0) AS quantity
FROM stock_table s CROSS JOIN {Q.day_values(DAYS)} CROSS JOIN {Q.SLICE_VALUES}
LEFT JOIN cum c ON c.store=s.store AND c.product=s.product AND c.day=dd.day"""
_HAS_ORDERS = "EXISTS (SELECT 1 FROM live WHERE live.store=s.store AND live.product=s.product)"


@register("project_snapshot", Q.with_(*_SNAP_CTES, _OFFSETS, _CUM) + _SNAP_SELECT)
def project_snapshot(spark, sf_dir):
    return _snapshot(spark, sf_dir).drop("has_orders")


@register("project_no_orders", Q.with_(*_SNAP_CTES, _OFFSETS, _CUM) + _SNAP_SELECT + f" WHERE NOT {_HAS_ORDERS}")
def project_no_orders(spark, sf_dir):
    """The stock-only branch: keys with no order state project their stock flat."""
    return _snapshot(spark, sf_dir).where(~F.col("has_orders")).drop("has_orders")


@register("projection_lines", Q.with_(*_SNAP_CTES, _OFFSETS, _CUM) + _SNAP_SELECT + f" WHERE {_HAS_ORDERS}")
def projection_lines(spark, sf_dir):
    """The stock-and-orders branch: lines with cumulated demand taken off."""
    return _snapshot(spark, sf_dir).where(F.col("has_orders")).drop("has_orders")


# ---------------------------------------------------------------- replay

_PD_STOCK = Q.period_days("CAST(checked_at AS DATE)", "CAST(deliver_at AS DATE)")
_PD_ORDER = Q.period_days("CAST(s_checked AS DATE)", "CAST(deliver_at AS DATE)")


def _replay_ctes(arrival: str) -> tuple[str, ...]:
    """CTEs up to on_stock and on_order, from ``f`` (folded lines, which arrive at
    ``arrival``) and ``stock``."""
    return (
        f"""se AS (
  SELECT s.store, s.product, s.arrived_at, s.checked_at, s.quantity,
         coalesce((SELECT max(rn) FROM f WHERE f.store=s.store AND f.product=s.product
                   AND f.{arrival} < s.arrived_at), 0) AS pos
  FROM stock s)""",
        """ses AS (SELECT se.*, f.occ, f.lastempty FROM se LEFT JOIN f
           ON f.store=se.store AND f.product=se.product AND f.rn=se.pos)""",
        """se_live AS (
  SELECT DISTINCT ses.store, ses.product, ses.arrived_at, ses.checked_at,
         b.quantity, b.order_id, b.created_at, b.deliver_at, b.status
  FROM ses JOIN f b ON b.store=ses.store AND b.product=ses.product AND ses.occ=1
   AND b.rn > ses.lastempty AND b.rn <= ses.pos)""",
        f"""se_off AS (SELECT store, product, arrived_at, checked_at, quantity AS q, {_PD_STOCK} AS o FROM se_live)""",
        f"""on_stock AS (
  SELECT se.store, se.product, 'on_stock' AS branch, epoch_ms(se.arrived_at) AS event_at_ms,
         CAST(NULL AS BIGINT) AS order_id, CAST(NULL AS INTEGER) AS line_no,
         epoch_ms(se.checked_at) AS stock_checked_at_ms, se.quantity AS current_quantity,
         CAST(dd.day AS INTEGER) AS day, sl.slice,
         se.quantity - coalesce((SELECT sum(q) FROM se_off x WHERE x.store=se.store AND x.product=se.product
              AND x.arrived_at=se.arrived_at AND x.checked_at=se.checked_at AND x.o BETWEEN 0 AND dd.day-1), 0.0) AS quantity
  FROM se CROSS JOIN {Q.day_values(DAYS)} CROSS JOIN {Q.SLICE_VALUES})""",
        f"""ns AS (
  SELECT f.store, f.product, f.rn, s.checked_at, s.quantity,
         row_number() OVER (PARTITION BY f.store, f.product, f.rn
                            ORDER BY s.checked_at DESC, s.arrived_at DESC, s.quantity DESC) AS k
  FROM f JOIN stock s ON s.store=f.store AND s.product=f.product AND s.arrived_at <= f.{arrival})""",
        """oe AS (SELECT f.*, ns.checked_at AS s_checked, ns.quantity AS s_qty FROM f JOIN ns
          ON ns.store=f.store AND ns.product=f.product AND ns.rn=f.rn AND ns.k=1)""",
        """oe_live AS (
  SELECT DISTINCT oe.store, oe.product, oe.rn, oe.s_checked, b.quantity, b.order_id, b.created_at, b.deliver_at, b.status
  FROM oe JOIN f b ON b.store=oe.store AND b.product=oe.product
   AND ((oe.occ=1 AND b.rn > oe.lastempty AND b.rn <= oe.rn) OR (oe.occ=0 AND b.rn=oe.rn)))""",
        f"""oe_off AS (SELECT store, product, rn, quantity AS q, {_PD_ORDER} AS o FROM oe_live)""",
        f"""on_order AS (
  SELECT oe.store, oe.product, 'on_order' AS branch, epoch_ms(oe.{arrival}) AS event_at_ms,
         oe.order_id, oe.line_no, epoch_ms(oe.s_checked) AS stock_checked_at_ms, oe.s_qty AS current_quantity,
         CAST(dd.day AS INTEGER) AS day, sl.slice,
         oe.s_qty - coalesce((SELECT sum(q) FROM oe_off x WHERE x.store=oe.store AND x.product=oe.product
              AND x.rn=oe.rn AND x.o BETWEEN 0 AND dd.day-1), 0.0) AS quantity
  FROM oe CROSS JOIN {Q.day_values(DAYS)} CROSS JOIN {Q.SLICE_VALUES})""",
    )


_REPLAY_CTES = (Q.LINES, Q.STOCK, Q.fold_states("lines", "f"), *_replay_ctes("created_at"))


def _replay(spark, sf_dir, branches):
    lines, stock = _inputs(spark, sf_dir)
    r = R.replay_projections(lines, stock, DAYS, branches=branches)
    return r.select(
        *KEYS,
        "branch",
        ms("event_at"),
        "order_id",
        "line_no",
        ms("stock_checked_at"),
        "current_quantity",
        "day",
        "slice",
        "quantity",
    )


@register("project_on_stock", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock")
def project_on_stock(spark, sf_dir):
    """Every stock check projected against the order table as it stood then."""
    return _replay(spark, sf_dir, (R.ON_STOCK,))


@register("project_on_order", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_order")
def project_on_order(spark, sf_dir):
    """Every order line (with a stock check before it) projected against the
    newest check, with the table read after the line's own update."""
    return _replay(spark, sf_dir, (R.ON_ORDER,))


@register(
    "projections_merged", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order"
)
def projections_merged(spark, sf_dir):
    """Both projection streams merged into one (duplicates kept)."""
    return _replay(spark, sf_dir, (R.ON_STOCK, R.ON_ORDER))


@register(
    "order_merged_with_table",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"))
    + f"""
, pairs AS (
  SELECT DISTINCT a.store, a.product, a.rn, b.quantity, b.order_id, b.created_at, b.deliver_at, b.status
  FROM f a JOIN f b ON a.store=b.store AND a.product=b.product
   AND ((a.occ=1 AND b.rn > a.lastempty AND b.rn <= a.rn) OR (a.occ=0 AND b.rn = a.rn))),
agg AS (SELECT store, product, rn, count(*) AS n, sum(quantity) AS q FROM pairs GROUP BY store, product, rn)
SELECT f.store, f.product, {INFO_FLAT_SQL}, f.line_no, agg.n AS merged_count, agg.q AS merged_quantity
FROM f JOIN agg ON f.store=agg.store AND f.product=agg.product AND f.rn=agg.rn""",
)
def order_merged_with_table(spark, sf_dir):
    lines, _ = _inputs(spark, sf_dir)
    m = R.merged_with_table(lines)
    return m.select(
        *KEYS, *info_flat(), "line_no", F.col("merged_count").cast("long").alias("merged_count"), "merged_quantity"
    )


# ---------------------------------------------------------------- the order table in time

_FIRSTS = f"""firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store, product, lastempty, {Q.INFO} ORDER BY rn) AS k FROM f WHERE occ = 1)
  WHERE k = 1)"""


@register(
    "order_table_history",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"), _FIRSTS)
    + f"""SELECT a.store, a.product, {INFO_FLAT_SQL.replace("quantity, order_id", "a.quantity, a.order_id").replace("(created_at", "(a.created_at").replace("(deliver_at", "(a.deliver_at").replace(", status", ", a.status")},
  a.rn AS from_rn, epoch_ms(a.created_at) AS from_at_ms, min(e.rn) AS to_rn, epoch_ms(arg_min(e.created_at, e.rn)) AS to_at_ms
FROM firsts a LEFT JOIN f e ON e.store = a.store AND e.product = a.product AND e.occ = 0 AND e.rn > a.rn
GROUP BY a.store, a.product, a.rn, a.quantity, a.order_id, a.created_at, a.deliver_at, a.status""",
)
def order_table_history(spark, sf_dir):
    """The order table as a temporal table: every info with the lines and instants between which it held."""
    lines, _ = _inputs(spark, sf_dir)
    return H.order_table_history(lines).select(*KEYS, *info_flat(), "from_rn", ms("from_at"), "to_rn", ms("to_at"))


@register(
    "order_table_as_of",
    Q.with_(Q.LINES, Q.STOCK, Q.fold_states("lines", "f"))
    + f""", pos AS (
  SELECT s.store, s.product, s.check_no, s.arrived_at, max(f.rn) AS pos FROM stock s
  JOIN f ON f.store = s.store AND f.product = s.product AND f.created_at <= s.arrived_at GROUP BY ALL)
SELECT p.store, p.product, p.check_no, epoch_ms(p.arrived_at) AS at_ms, b.quantity, b.order_id, epoch_ms(b.created_at) AS created_at_ms,
  epoch_ms(b.deliver_at) AS deliver_at_ms, b.status, min(b.rn) AS from_rn
FROM pos p JOIN f a ON a.store = p.store AND a.product = p.product AND a.rn = p.pos AND a.occ = 1
JOIN f b ON b.store = a.store AND b.product = a.product AND b.rn > a.lastempty AND b.rn <= a.rn
GROUP BY p.store, p.product, p.check_no, p.arrived_at, b.quantity, b.order_id, b.created_at, b.deliver_at, b.status""",
)
def order_table_as_of(spark, sf_dir):
    """The order table of its key at the instant of each stock check."""
    lines, stock = _inputs(spark, sf_dir)
    found = H.order_table_as_of(lines, stock.select(*KEYS, F.col("arrived_at").alias("at"), "check_no"))
    return found.select(*KEYS, "check_no", ms("at"), *info_flat(), "from_rn")


@register(
    "order_merged_infos",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"))
    + f"""SELECT a.store, a.product, a.rn, a.order_id AS line_order_id, a.line_no, b.quantity, b.order_id, epoch_ms(b.created_at) AS created_at_ms,
  epoch_ms(b.deliver_at) AS deliver_at_ms, b.status, bool_or(b.rn = a.rn) AS own, min(b.rn) AS from_rn
FROM f a JOIN f b ON a.store = b.store AND a.product = b.product
 AND ((a.occ = 1 AND b.rn > a.lastempty AND b.rn <= a.rn) OR (a.occ = 0 AND b.rn = a.rn))
GROUP BY a.store, a.product, a.rn, a.order_id, a.line_no, b.quantity, b.order_id, b.created_at, b.deliver_at, b.status""",
)
def order_merged_infos(spark, sf_dir):
    """Every line with the merged infos it is projected with: its own, then the table's in order."""
    lines, _ = _inputs(spark, sf_dir)
    return H.merged_infos(lines).select(*KEYS, "rn", "line_order_id", "line_no", *info_flat(), "own", "from_rn")


# ---------------------------------------------------------------- codec and keys

_STOCK_KEY_SQL = """'{"store":"' || store || '","product":"' || product || '"}'"""
_STOCK_VALUE_SQL = (
    """'{"store":"' || store || '","product":"' || product || '","checkedAt":' || CAST(epoch_ms(checked_at) AS VARCHAR)"""
    """ || ',"quantity":' || CAST(quantity AS VARCHAR) || '}'"""
)
_ORDER_KEY_SQL = """'{"orderId":"' || CAST(order_id AS VARCHAR) || '"}'"""
_ORDERS_JSON_CTE = """order_json AS (
  SELECT order_id, '{"orderId":"' || CAST(order_id AS VARCHAR) || '","store":"' || store || '","createdAt":'
         || CAST(epoch_ms(created_at) AS VARCHAR) || ',"items":['
         || string_agg('{"product":"' || product || '","quantity":' || CAST(quantity AS VARCHAR) || '}', ','
                       ORDER BY line_no, product, quantity)
         || '],"deliverAt":' || CAST(epoch_ms(deliver_at) AS VARCHAR) || ',"status":"' || status || '"}' AS value
  FROM lines GROUP BY order_id, store, created_at, deliver_at, status)"""


def _stock_payloads(spark, sf_dir):
    _, stock = _inputs(spark, sf_dir)
    return stock.select(C.stock_key_json().alias("key"), C.stock_value_json().alias("value"))


def _order_payloads(spark, sf_dir):
    use_utc(spark)
    orders = tables.orders_nested(spark, sf_dir)
    return orders.select(C.order_key_json().alias("key"), C.order_value_json().alias("value"))


_STOCK_DECODED_SQL = "SELECT store, product, epoch_ms(checked_at) AS checked_at_ms, quantity FROM stock"
_ORDER_DECODED_SQL = (
    "SELECT CAST(order_id AS VARCHAR) AS order_id, store, product, quantity, "
    "epoch_ms(created_at) AS created_at_ms, epoch_ms(deliver_at) AS deliver_at_ms, status FROM lines"
)


def _flat_decoded_orders(orders):
    return O.explode_lines(orders).select(
        "order_id", *KEYS, "quantity", ms("created_at"), ms("deliver_at"), "status"
    )


@register("json_decode_stock", Q.with_(Q.STOCK) + _STOCK_DECODED_SQL)
def json_decode_stock(spark, sf_dir):
    """Stock checks → a folder of JSON lines → scanned and decoded (epoch ms → instants)."""
    good, _ = _scanned(spark, _stock_payloads(spark, sf_dir), C.decode_stock())
    return good.select(*KEYS, ms("checked_at"), "quantity")


@register("json_decode_order", Q.with_(Q.LINES) + _ORDER_DECODED_SQL)
def json_decode_order(spark, sf_dir):
    """Orders → a folder of JSON lines with nested items → scanned and decoded, items flattened."""
    good, _ = _scanned(spark, _order_payloads(spark, sf_dir), C.decode_order())
    return _flat_decoded_orders(good)


_BROKEN_STOCK = ("""'"quantity":'""", """'"quantity":"x'"""), ("""'"product"'""", """'"item"'"""), ("""'"checkedAt":'""", """'"checkedAt":"zz","was":'""")
_BROKEN_ORDER = ("""'"createdAt":'""", """'"createdAt":"zz","was":'"""), ("""'"product"'""", """'"item"'"""), ("""'{'""", """'['""")


def _broken_sql(value: str, kind: str, ways) -> str:
    cases = " ".join(f"WHEN {k} THEN replace({value}, {a}, {b})" for k, (a, b) in enumerate(ways, 1))
    return f"CASE {kind} {cases} ELSE {value} END"


@register(
    "decode_rejects",
    Q.with_(Q.LINES, Q.STOCK, _ORDERS_JSON_CTE)
    + f"""SELECT topic, value FROM (
  SELECT 'stock-stream' AS topic, CAST(quantity AS BIGINT) % 4 AS kind, {_broken_sql(_STOCK_VALUE_SQL, "CAST(quantity AS BIGINT) % 4", _BROKEN_STOCK)} AS value FROM stock
  UNION ALL SELECT 'order-stream', order_id % 4, {_broken_sql("value", "order_id % 4", _BROKEN_ORDER)} FROM order_json)
WHERE kind <> 0""",
)
def decode_rejects(spark, sf_dir):
    """Payloads of which three in four are damaged (no number, a field missing, no
    instant, no JSON object), scanned as JSON lines: the lines that are rejected."""
    _, stock = _inputs(spark, sf_dir)
    orders = tables.orders_nested(spark, sf_dir)
    damaged = lambda kind, ways: F.expr(_broken_sql("value", kind, ways)).alias("value")
    checks = stock.withColumn("value", C.stock_value_json()).select(damaged("CAST(quantity AS BIGINT) % 4", _BROKEN_STOCK))
    orders = orders.withColumn("value", C.order_value_json()).select(damaged("order_id % 4", _BROKEN_ORDER))
    _, no_checks = _scanned(spark, checks, C.decode_stock())
    _, no_orders = _scanned(spark, orders, C.decode_order())
    return no_checks.select(F.lit(C.STOCK_TOPIC).alias("topic"), "value").unionByName(
        no_orders.select(F.lit(C.ORDER_TOPIC).alias("topic"), "value")
    )


def _scanned(spark, payloads, decoded):
    """(decoded, rejected) of payloads written as JSON lines and scanned."""
    path = scratch_path(spark, "json-lines")
    payloads.select("value").write.text(path)
    return ST.json_lines(spark, path, decoded)


@register(
    "keyed_stock_payload",
    Q.with_(Q.STOCK) + f"SELECT {_STOCK_KEY_SQL} AS key, {_STOCK_VALUE_SQL} AS value FROM stock",
)
def keyed_stock_payload(spark, sf_dir):
    """Producer side: each stock payload with its key derived from the payload."""
    payloads = _stock_payloads(spark, sf_dir).select("value")
    return payloads.select(C.key_from_stock_payload("value").alias("key"), "value")


@register(
    "keyed_order_payload",
    Q.with_(Q.LINES, _ORDERS_JSON_CTE) + f"SELECT {_ORDER_KEY_SQL} AS key, value FROM order_json",
)
def keyed_order_payload(spark, sf_dir):
    payloads = _order_payloads(spark, sf_dir).select("value")
    return payloads.select(C.key_from_order_payload("value").alias("key"), "value")


@register(
    "keyed_payload_routed",
    Q.with_(Q.LINES, Q.STOCK, _ORDERS_JSON_CTE)
    + f"""SELECT 'stock-stream' AS topic, {_STOCK_KEY_SQL} AS key, {_STOCK_VALUE_SQL} AS value FROM stock
UNION ALL SELECT 'order-stream', {_ORDER_KEY_SQL}, value FROM order_json
UNION ALL SELECT 'input', CAST(NULL AS VARCHAR), trim(props) FROM events""",
)
def keyed_payload_routed(spark, sf_dir):
    """Payloads of several topics keyed by the rule of their topic; records of
    an unknown topic (here the raw event topic) get no key (reject output)."""
    raw = (
        _stock_payloads(spark, sf_dir)
        .select(F.lit(C.STOCK_TOPIC).alias("topic"), "value")
        .unionByName(_order_payloads(spark, sf_dir).select(F.lit(C.ORDER_TOPIC).alias("topic"), "value"))
        .unionByName(tables.read_table(spark, sf_dir, "events").select(F.lit("input").alias("topic"), F.col("props").alias("value")))
    )
    keyed, rejected = C.keyed_records(raw)
    return keyed.unionByName(rejected.withColumn("key", F.lit(None).cast("string")))


@register(
    "projection_sink_json",
    Q.with_(*_SNAP_CTES, _OFFSETS, _CUM)
    + """SELECT '{"store":"' || s.store || '","product":"' || s.product || '"}' AS key, """
    + _SNAP_SELECT.removeprefix("SELECT "),
)
def projection_sink_json(spark, sf_dir):
    """Snapshot projections written as (key JSON, value JSON) records and read
    back: the value carries store, product, createdAt (ms), currentQuantity and
    the 14 lines."""
    lines, stock = _inputs(spark, sf_dir)
    records = P.project_snapshot_records(S.stock_table(stock), O.order_table_rows(lines), DAYS)
    out = records.select(C.stock_key_json().alias("key"), C.projection_value_json("projection").alias("value"))
    back = out.select("key", F.from_json("value", C.PROJECTION_JSON).alias("p"))
    return back.select(
        "key",
        F.col("p.store").alias("store"),
        F.col("p.product").alias("product"),
        F.col("p.currentQuantity").alias("current_quantity"),
        F.explode("p.lines").alias("l"),
    ).select("key", *KEYS, "current_quantity", "l.day", "l.slice", "l.quantity")


# ---------------------------------------------------------------- stream sources (file twins)


@register("stock_source", Q.with_(Q.STOCK) + _STOCK_DECODED_SQL)
def stock_source(spark, sf_dir):
    """Stock topic (file twin) read as a stream to the end of its input, decoded."""
    path = ST.publish(_stock_payloads(spark, sf_dir), scratch_path(spark, "stock-topic"), F.col("key"), F.col("value"))
    good, _ = ST.stock_stream(ST.file_raw(spark, path))
    return ST.drain(good, spark, "stock-source").select(*KEYS, ms("checked_at"), "quantity")


@register("order_source", Q.with_(Q.LINES) + _ORDER_DECODED_SQL)
def order_source(spark, sf_dir):
    """Order topic (file twin) read as a stream, decoded, items flattened."""
    path = ST.publish(_order_payloads(spark, sf_dir), scratch_path(spark, "order-topic"), F.col("key"), F.col("value"))
    good, _ = ST.order_stream(ST.file_raw(spark, path))
    return _flat_decoded_orders(ST.drain(good, spark, "order-source"))


@register("raw_source", "SELECT CAST(user_id AS VARCHAR) AS key, props AS value FROM events")
def raw_source(spark, sf_dir):
    """A plain (key, value) string topic, read as a stream."""
    events = tables.read_table(spark, sf_dir, "events")
    path = ST.publish(events, scratch_path(spark, "raw-topic"), F.col("user_id").cast("string"), F.col("props"))
    return ST.drain(ST.file_raw(spark, path), spark, "raw-source").select("key", "value")


@register(
    "multi_topic_source",
    Q.with_(Q.LINES, Q.STOCK)
    + f"""SELECT 'stock-stream' AS topic, {_STOCK_KEY_SQL} AS key FROM stock
UNION ALL SELECT 'order-stream', {_ORDER_KEY_SQL} FROM (SELECT DISTINCT order_id FROM lines)""",
)
def multi_topic_source(spark, sf_dir):
    """Several topics in one subscription, from the start, each record with
    its topic and source metadata."""
    paths = {
        C.STOCK_TOPIC: ST.publish(
            _stock_payloads(spark, sf_dir), scratch_path(spark, "stock-topic"), F.col("key"), F.col("value")
        ),
        C.ORDER_TOPIC: ST.publish(
            _order_payloads(spark, sf_dir), scratch_path(spark, "order-topic"), F.col("key"), F.col("value")
        ),
    }
    drained = ST.drain(ST.multi_topic(spark, paths), spark, "multi-topic")
    return drained.where(F.col("file_path").isNotNull()).select("topic", "key")


# ---------------------------------------------------------------- views, text, topics


def _readable_sql(col: str) -> str:
    return (
        f"(CASE WHEN epoch_ms({col}) % 1000 <> 0 THEN strftime({col}, '%Y-%m-%dT%H:%M:%S.%g') "
        f"WHEN second({col}) = 0 THEN strftime({col}, '%Y-%m-%dT%H:%M') ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S') END)"
    )


@register(
    "stock_table_view",
    Q.with_(Q.STOCK, Q.STOCK_TABLE)
    + f"SELECT store, product, {_readable_sql('checked_at')} AS checked_at, quantity FROM stock_table "
    + "ORDER BY store, product LIMIT 100",
)
def stock_table_view(spark, sf_dir):
    """The first 100 entries of the stock table, in (store, product) order."""
    _, stock = _inputs(spark, sf_dir)
    return V.stock_table_view(S.stock_table(stock))


@register(
    "order_table_view",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"))
    + f""", firsts AS (
  SELECT store, product, rn, {Q.INFO} FROM (
    SELECT *, max(CASE WHEN occ=0 THEN rn ELSE 0 END) OVER (PARTITION BY store,product) AS le,
           row_number() OVER (PARTITION BY store,product,quantity,order_id,created_at,deliver_at,status ORDER BY rn) AS k
    FROM f) WHERE rn > le AND k = 1),
keys AS (SELECT DISTINCT store, product FROM firsts ORDER BY store, product LIMIT 100)
SELECT store, product,
       string_agg(CAST(order_id AS VARCHAR) || ' => ' || CAST(quantity AS VARCHAR) || ' (' || status || ' - '
                  || {_readable_sql('created_at')} || ')', chr(10) ORDER BY rn) AS info
FROM firsts JOIN keys USING (store, product) GROUP BY store, product""",
)
def order_table_view(spark, sf_dir):
    """The first 100 keys of the order table, infos rendered as text lines."""
    lines, _ = _inputs(spark, sf_dir)
    return V.order_table_view(O.order_table_rows(lines, with_rank=True))


_UTF16_SQL = r"(length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')))"


@register(
    "map_values_size_content",
    f"""SELECT doc_id, '{{"size": ' || CAST({_UTF16_SQL} AS VARCHAR) || ', "content": "' || text || '"}}' AS value
FROM documents""",
)
def map_values_size_content(spark, sf_dir):
    """Each text value rewritten as ``{"size": n, "content": "..."}`` (whole texts)."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", TX.size_content("text").alias("value"))


def _topic_of_event():
    return F.element_at(F.array(*[F.lit(t) for t in V.ALL_TOPICS]), (F.col("user_id") % len(V.ALL_TOPICS) + 1).cast("int"))


_TOPIC_CASE = "CASE user_id % 6 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(V.ALL_TOPICS)) + " END"
_KIND_CASE = "CASE topic " + " ".join(f"WHEN '{t}' THEN '{k}'" for t, k in V.TOPIC_KINDS.items()) + " END"


@register(
    "categorize_topics",
    f"SELECT topic, {_KIND_CASE} AS kind, count(*) AS records FROM (SELECT {_TOPIC_CASE} AS topic FROM events) GROUP BY topic",
)
def categorize_topics(spark, sf_dir):
    """Records of the service's topics counted per topic with its kind
    (events spread over the six topics by user)."""
    events = tables.read_table(spark, sf_dir, "events").select(_topic_of_event().alias("topic"))
    return V.categorize(events)


def _views_and_others(spark, sf_dir):
    ev = tables.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    is_view = F.col("event_type").eqNullSafe("view")
    return ev.where(is_view).drop("event_type"), ev.where(~is_view).drop("event_type")


@register(
    "dual_union",
    "SELECT event_id, user_id, CASE WHEN event_type='view' THEN 'left' ELSE 'right' END AS side FROM events",
)
def dual_union(spark, sf_dir):
    """Two-input operation as a merge: view events and all others, one stream."""
    views, others = _views_and_others(spark, sf_dir)
    return V.dual_union(views, others).select("event_id", "user_id", "side")


@register(
    "dual_asof_join",
    """WITH o AS (SELECT * FROM events WHERE event_type IS DISTINCT FROM 'view'),
seen AS (
  SELECT o.event_id, v.event_id AS right_event_id,
         row_number() OVER (PARTITION BY o.event_id ORDER BY v.ts DESC, v.event_id DESC) AS k
  FROM o JOIN events v ON v.event_type='view' AND v.user_id=o.user_id AND v.ts <= o.ts)
SELECT o.event_id, o.user_id, seen.right_event_id FROM o LEFT JOIN seen ON seen.event_id=o.event_id AND seen.k=1""",
)
def dual_asof_join(spark, sf_dir):
    """Two-input operation as a keyed as-of left join: each other event with the
    user's latest view at or before it."""
    views, others = _views_and_others(spark, sf_dir)
    j = V.asof_left_join(others, views, "user_id", "ts", ["event_id"])
    return j.select("event_id", "user_id", "right_event_id")


# ---------------------------------------------------------------- streaming


def stream_projection_of(spark, lines, stock, days=DAYS, max_files_per_trigger=None, name="stream-projection"):
    """Run the streaming service over inputs dropped as Parquet files in the
    shared checkpoint folder; return the flat projection lines it emitted."""
    base = scratch_path(spark, name)
    lines.write.mode("overwrite").parquet(f"{base}/lines")
    stock.write.mode("overwrite").parquet(f"{base}/stock")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    line_stream = reader.schema(lines.schema).parquet(f"{base}/lines")
    stock_stream = reader.schema(stock.schema).parquet(f"{base}/stock")
    proj = SV.projection_stream(line_stream, stock_stream, days)
    SV.run(proj, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return SV.flat_lines(spark.read.parquet(f"{base}/out"))


@register("stream_projection", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order")
def stream_projection(spark, sf_dir):
    """The Structured Streaming service (keyed state over both inputs) run to
    the end of its input; must equal the batch replay."""
    lines, stock = _inputs(spark, sf_dir)
    out = stream_projection_of(spark, lines, stock)
    return out.select(
        *KEYS, "branch", ms("event_at"), "order_id", "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


def _kept(df, path):
    """An input that is read several times, written once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _two_runs(spark, lines, stock, name, start):
    """Runs a stream twice over its inputs: up to the second checks' time, then the rest.
    ``start(base, line stream, check stream)`` gives the query."""
    base, read = scratch_path(spark, name), spark.readStream
    lines, stock = _kept(lines, f"{base}/all/lines"), _kept(stock, f"{base}/all/stock")
    cut = tables.hours_after_origin(F.lit(tables.STOCK_SECOND_CHECK_HOURS))
    for slab in range(2):
        of = lambda c: F.col(c) < cut if slab == 0 else F.col(c) >= cut  # noqa: E731, B023
        lines.where(of("created_at")).write.parquet(f"{base}/lines/slab={slab}")
        stock.where(of("arrived_at")).write.parquet(f"{base}/stock/slab={slab}")
        start(base, read.schema(lines.schema).parquet(f"{base}/lines/slab=*"), read.schema(stock.schema).parquet(f"{base}/stock/slab=*")).awaitTermination()
    return base


@register("stream_projection_native", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order")
def stream_projection_native(spark, sf_dir):
    """The service as micro-batches of the batch replay, in two runs that share state: the
    events up to the second check's time, then the rest; must equal the whole replay."""
    lines, stock = _inputs(spark, sf_dir)
    start = lambda base, l, c: NV.run_native(l, c, f"{base}/out", f"{base}/state", f"{base}/checkpoint", DAYS)
    base = _two_runs(spark, lines, stock, "stream-native", start)
    return spark.read.parquet(f"{base}/out").select(
        *KEYS, "branch", ms("event_at"), "order_id", "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


@register("stream_projection_maps", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order")
def stream_projection_maps(spark, sf_dir):
    """The service with the order table as map state read by key, over a restart."""
    lines, stock = _inputs(spark, sf_dir)
    start = lambda base, l, c: SV.run(SV.projection_stream(l, c, DAYS, maps=True), f"{base}/out", f"{base}/checkpoint")
    base = _two_runs(spark, lines, stock, "stream-maps", start)
    return SV.flat_lines(spark.read.parquet(f"{base}/out")).select(
        *KEYS, "branch", ms("event_at"), "order_id", "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


_EARLY = f"early AS (SELECT * FROM lines WHERE created_at < {Q.ORIGIN} + INTERVAL '{tables.STOCK_SECOND_CHECK_HOURS}' HOUR)"


@register(
    "state_changes",
    Q.with_(Q.LINES, _EARLY, Q.fold_states("early", "fe"), Q.live_infos("fe", "le"), Q.fold_states("lines", "f"), Q.live_infos("f", "live"))
    + f"""SELECT *, 'removed' AS change FROM (SELECT store, product, {INFO_FLAT_SQL} FROM le EXCEPT SELECT store, product, {INFO_FLAT_SQL} FROM live)
UNION ALL SELECT *, 'added' FROM (SELECT store, product, {INFO_FLAT_SQL} FROM live EXCEPT SELECT store, product, {INFO_FLAT_SQL} FROM le)""",
)
def state_changes(spark, sf_dir):
    """What changed in the running service's order table between two of its batches, which a
    restart stands between: two versions of its state, read as tables."""
    lines, stock = _inputs(spark, sf_dir)
    start = lambda base, l, c: SV.run(SV.projection_stream(l, c, DAYS), f"{base}/out", f"{base}/checkpoint")
    base = _two_runs(spark, lines, stock, "state-changes", start)
    return SV.state_changes(spark, f"{base}/checkpoint", 0, 1).select(*KEYS, *info_flat(), "change")


@register(
    "state_stock_table",
    Q.with_(Q.STOCK, Q.STOCK_TABLE) + "SELECT store, product, epoch_ms(checked_at) AS checked_at_ms, quantity FROM stock_table",
)
def state_stock_table(spark, sf_dir):
    """The running service's stock table, read from its state after a restart."""
    lines, stock = _inputs(spark, sf_dir)
    start = lambda base, l, c: SV.run(SV.projection_stream(l, c, DAYS), f"{base}/out", f"{base}/checkpoint")
    base = _two_runs(spark, lines, stock, "state-stock", start)
    return SV.state_table(spark, f"{base}/checkpoint", "stock-table").select(*KEYS, ms("checked_at"), "quantity")


_EVENT_SQL = "store, product, branch, event_at_ms, order_id, line_no, stock_checked_at_ms, current_quantity, quantity AS last_quantity"


@register(
    "fan_out_folders",
    Q.with_(*_REPLAY_CTES)
    + f""", sent AS (SELECT * FROM on_stock UNION ALL SELECT * FROM on_order),
closing AS (SELECT {_EVENT_SQL} FROM sent WHERE day = {DAYS} AND slice = 'B')
SELECT 'all' AS folder, * FROM closing UNION ALL SELECT branch, * FROM closing""",
)
def fan_out_folders(spark, sf_dir):
    """One stream written to three folders over a restart: all projections, and each branch's."""
    lines, stock = _inputs(spark, sf_dir)
    folders = ["all", R.ON_STOCK, R.ON_ORDER]

    def start(base, line_stream, checks):
        write = SV.fan_out({f: f"{base}/out/{f}" for f in folders})
        SV.keyed_state(spark)
        stream = SV.projection_stream(line_stream, checks, DAYS).writeStream.foreachBatch(write)
        return stream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()

    base = _two_runs(spark, lines, stock, "fan-out", start)
    out = [spark.read.parquet(f"{base}/out/{f}").drop("batch_id").withColumn("folder", F.lit(f)) for f in folders]
    whole = out[0].unionByName(out[1]).unionByName(out[2])
    return whole.select(
        "folder", *KEYS, "branch", ms("event_at"), "order_id", "line_no", ms("stock_checked_at"), F.col("projection.current_quantity").alias("current_quantity"),
        F.element_at("projection.lines", -1)["quantity"].alias("last_quantity"),
    )


#: The polling fixture's micro-batches: instants at which one ends (hours).
POLLS = [200, 400, 600]


@register("service_polling", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order")
def service_polling(spark, sf_dir):
    """The service polling for input every second, a file of each input a micro-batch, until
    all is taken; then stopped cleanly."""
    lines, stock = _inputs(spark, sf_dir)
    base = scratch_path(spark, "service-polling")
    edges = [tables.hours_after_origin(F.lit(h)) for h in POLLS]
    lines, stock = _kept(lines, f"{base}/all/lines"), _kept(stock, f"{base}/all/stock")
    for i in range(len(POLLS) + 1):  # a micro-batch's input is one file a topic
        for df, at, name in ((lines, "created_at", "lines"), (stock, "arrived_at", "stock")):
            inside = F.lit(True) if i == 0 else F.col(at) >= edges[i - 1]
            inside = inside & (F.lit(True) if i == len(POLLS) else F.col(at) < edges[i])
            # one task writes the file, coalesce(1) would make it do all before, too
            df.where(inside).repartition(1).write.parquet(f"{base}/{name}/slab={i}")
    read = lambda df, name: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/{name}/slab=*")
    proj = SV.projection_stream(read(lines, "lines"), read(stock, "stock"), DAYS)
    query = SV.run(proj, f"{base}/out", f"{base}/checkpoint", trigger={"processingTime": "1 second"})
    query.processAllAvailable()
    query.stop()
    return SV.flat_lines(spark.read.parquet(f"{base}/out")).select(
        *KEYS, "branch", ms("event_at"), "order_id", "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


@register("stream_after_replay", Q.with_(*_REPLAY_CTES) + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order")
def stream_after_replay(spark, sf_dir):
    """Hand-over: the batch replay up to an instant, then the stream from the tables as they
    stood there; together the whole replay."""
    lines, stock = _inputs(spark, sf_dir)
    base, read = scratch_path(spark, "hand-over"), spark.readStream
    cut = tables.hours_after_origin(F.lit(tables.STOCK_SECOND_CHECK_HOURS))
    early, old = lines.where(F.col("created_at") < cut), stock.where(F.col("arrived_at") < cut)
    state = NV.State(spark, f"{base}/state", lines.schema)
    state.seed(O.order_table_rows(early), S.stock_table(old))
    lines.where(F.col("created_at") >= cut).write.parquet(f"{base}/lines")
    stock.where(F.col("arrived_at") >= cut).write.parquet(f"{base}/stock")
    NV.run_native(
        read.schema(lines.schema).parquet(f"{base}/lines"), read.schema(stock.schema).parquet(f"{base}/stock"),
        f"{base}/out", f"{base}/state", f"{base}/checkpoint", DAYS, seeded=True,
    ).awaitTermination()
    streamed = spark.read.parquet(f"{base}/out").drop("batch_id")
    return R.replay_projections(early, old, DAYS).unionByName(streamed).select(
        *KEYS, "branch", ms("event_at"), "order_id", "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


_SINK_SELECT = f"{_STOCK_KEY_SQL} AS key, store, product, current_quantity, day, slice, quantity"


@register(
    "stream_projection_json",
    Q.with_(*_REPLAY_CTES)
    + f"""SELECT 'projection-stream' AS topic, {_SINK_SELECT} FROM on_stock
UNION ALL SELECT 'projection-stream', {_SINK_SELECT} FROM on_order
UNION ALL SELECT 'projection-on-stock', {_SINK_SELECT} FROM on_stock
UNION ALL SELECT 'projection-on-order', {_SINK_SELECT} FROM on_order""",
)
def stream_projection_json(spark, sf_dir):
    """The service's topic sinks: projections as key and value JSON, on the
    projection topic and on their branch's debug topic, read back."""
    lines, stock = _inputs(spark, sf_dir)
    base = scratch_path(spark, "stream-sinks")
    lines.write.parquet(f"{base}/lines")
    stock.write.parquet(f"{base}/stock")
    read = spark.readStream
    proj = SV.projection_stream(read.schema(lines.schema).parquet(f"{base}/lines"), read.schema(stock.schema).parquet(f"{base}/stock"), DAYS)
    SV.run(SV.sink_records(proj), f"{base}/out", f"{base}/checkpoint", fmt="json").awaitTermination()
    out = spark.read.schema("topic string, key string, value string").json(f"{base}/out")
    return (
        C.parsed(out, "p", F.from_json("value", C.PROJECTION_JSON))
        .select("topic", "key", "p.store", "p.product", F.col("p.currentQuantity").alias("current_quantity"), F.explode("p.lines").alias("l"))
        .select("topic", "key", *KEYS, "current_quantity", "l.day", "l.slice", "l.quantity")
    )


def _topics_of(spark, lines, stock, name):
    """The service with its changelog, run over its inputs as Parquet drops into topic
    files; the records it sent."""
    base = scratch_path(spark, name)
    lines.write.parquet(f"{base}/lines")
    stock.write.parquet(f"{base}/stock")
    read = spark.readStream
    events = SV.service_events(
        read.schema(lines.schema).parquet(f"{base}/lines"), read.schema(stock.schema).parquet(f"{base}/stock"), DAYS, changelog=True
    )
    SV.run_to_topics(SV.topic_records(events), f"{base}/topics", f"{base}/checkpoint").awaitTermination()
    return ST.topic_files(spark, f"{base}/topics")


@register(
    "stream_changelog",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"))
    + f"""
, pairs AS (
  SELECT DISTINCT a.store, a.product, a.rn, b.quantity, b.order_id, b.created_at, b.deliver_at, b.status
  FROM f a JOIN f b ON a.store=b.store AND a.product=b.product AND a.occ=1
   AND b.rn > a.lastempty AND b.rn <= a.rn),
agg AS (SELECT store, product, rn, count(*) AS n, sum(quantity) AS q, string_agg(CAST(order_id AS VARCHAR), ',' ORDER BY order_id, quantity) AS orders
  FROM pairs GROUP BY store, product, rn)
SELECT {_STOCK_KEY_SQL.replace("store ||", "f.store ||").replace("product ||", "f.product ||")} AS key, f.occ=0 AS deleted, agg.n AS info_count, agg.q AS live_quantity, agg.orders
FROM f LEFT JOIN agg ON f.store=agg.store AND f.product=agg.product AND f.rn=agg.rn""",
)
def stream_changelog(spark, sf_dir):
    """The live changelog of the order table: a record a line on its topic, the key's infos
    after it, NULL where the line emptied the key; read back from the topic."""
    lines, stock = _inputs(spark, sf_dir)
    records = _topics_of(spark, lines, stock, "stream-changelog").where(F.col("topic") == V.ORDER_TABLE_TOPIC)
    records, info = C.parsed(records, "info", F.from_json("value", C.ORDER_STOCK_JSON)["info"]), F.col("info")
    ids = F.transform(F.array_sort(F.transform(info, lambda i: F.struct(i["orderId"].cast("long").alias("o"), i["quantity"]))), lambda i: i["o"].cast("string"))
    return records.select(
        "key",
        F.col("value").isNull().alias("deleted"),
        F.when(F.col("value").isNotNull(), F.size(info).cast("long")).alias("info_count"),
        F.aggregate(info, F.lit(0.0), lambda a, i: a + i["quantity"]).alias("live_quantity"),
        F.array_join(ids, ",").alias("orders"),
    )


@register(
    "table_from_changelog",
    Q.with_(Q.LINES, Q.fold_states("lines", "f"), Q.live_infos("f", "live"))
    + f"SELECT store, product, {INFO_FLAT_SQL.replace('order_id,', 'CAST(order_id AS VARCHAR) AS order_id,')} FROM live",
)
def table_from_changelog(spark, sf_dir):
    """The order table rebuilt from its changelog topic alone: the newest record a key, NULLs gone."""
    lines, stock = _inputs(spark, sf_dir)
    records = _topics_of(spark, lines, stock, "changelog-compaction")
    return SV.order_table_from_changelog(records).select(*KEYS, *info_flat())


# fixed values of the topic fixture: the hour a record of an order arrives at,
# in another order than the orders were created
ARRIVAL_MULT, ARRIVAL_MOD = 41, 700


@register(
    "service_from_topics",
    Q.with_(
        Q.LINES,
        Q.STOCK,
        f"""arr AS (
  SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY order_id ORDER BY line_no, product, quantity) AS INTEGER) AS line_no),
         {Q.ORIGIN} + INTERVAL '1' HOUR * CAST(order_id*{ARRIVAL_MULT} % {ARRIVAL_MOD} AS INT) AS arrival FROM lines)""",
        Q.fold_states("arr", "f", "arrival,CAST(order_id AS VARCHAR),line_no,quantity"),
        *_replay_ctes("arrival"),
    )
    + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order",
)
def service_from_topics(spark, sf_dir):
    """The whole service from its topics: JSON records with their own arrival
    times, decoded, flattened and projected in arrival order."""
    use_utc(spark)
    stock, orders = tables.stock(spark, sf_dir), tables.orders_nested(spark, sf_dir)
    base = scratch_path(spark, "service-topics")
    arrival = tables.hours_after_origin(F.col("order_id") * ARRIVAL_MULT % ARRIVAL_MOD)
    ST.publish(stock, f"{base}/stock", C.stock_key_json(), C.stock_value_json(), F.col("arrived_at"))
    ST.publish(orders, f"{base}/orders", C.order_key_json(), C.order_value_json(), arrival)
    checks, _ = ST.stock_stream(ST.file_raw(spark, f"{base}/stock"))
    decoded, _ = ST.order_stream(ST.file_raw(spark, f"{base}/orders"))
    proj = SV.projection_stream(O.explode_lines(decoded), checks, DAYS)
    SV.run(proj, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return SV.flat_lines(spark.read.parquet(f"{base}/out")).select(
        *KEYS, "branch", ms("event_at"), F.col("order_id").cast("long").alias("order_id"), "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


# fixed values of the offset fixture: the partitions of the order topic, and the
# offset that order 0 would have; later orders come earlier
OFFSET_PARTITIONS, OFFSET_TOP = 4, 1 << 40


@register(
    "service_by_offset",
    Q.with_(
        Q.LINES,
        Q.STOCK,
        f"""arr AS (
  SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY order_id ORDER BY line_no, product, quantity) AS INTEGER) AS line_no),
         {Q.ORIGIN} + INTERVAL '1' DAY * CAST(order_id*{ARRIVAL_MULT} % {ARRIVAL_MOD} // 24 AS INT) AS arrival,
         order_id % {OFFSET_PARTITIONS} AS part, {OFFSET_TOP} - order_id AS off FROM lines)""",
        Q.fold_states("arr", "f", "arrival,part,off,line_no,quantity"),
        *_replay_ctes("arrival"),
    )
    + "SELECT * FROM on_stock UNION ALL SELECT * FROM on_order",
)
def service_by_offset(spark, sf_dir):
    """The service from topics whose records share the instant of their day: lines arrive
    by their record's place, against the order of their order ids."""
    use_utc(spark)
    stock, orders = tables.stock(spark, sf_dir), tables.orders_nested(spark, sf_dir)
    base = scratch_path(spark, "service-offsets")
    hour = F.col("order_id") * ARRIVAL_MULT % ARRIVAL_MOD
    day = tables.hours_after_origin(F.floor(hour / 24) * 24)
    ST.publish(stock, f"{base}/stock", C.stock_key_json(), C.stock_value_json(), F.col("arrived_at"))
    ST.publish(
        orders, f"{base}/orders", C.order_key_json(), C.order_value_json(), day,
        partition=F.col("order_id") % OFFSET_PARTITIONS, offset=F.lit(OFFSET_TOP) - F.col("order_id"),
    )
    checks, _ = ST.stock_stream(ST.file_raw(spark, f"{base}/stock"))
    decoded, _ = ST.order_stream(ST.file_raw(spark, f"{base}/orders"))
    proj = SV.projection_stream(O.explode_lines(decoded), checks, DAYS)
    SV.run(proj, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return SV.flat_lines(spark.read.parquet(f"{base}/out")).select(
        *KEYS, "branch", ms("event_at"), F.col("order_id").cast("long").alias("order_id"), "line_no", ms("stock_checked_at"),
        "current_quantity", "day", "slice", "quantity",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.oracle for k, q in REGISTRY.items() if q.oracle}
