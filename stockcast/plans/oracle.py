"""SQL text of the independent oracle (DuckDB dialect, ANSI where possible).

Each oracle query is written directly against the base tables; the shared
pieces below are plain CTE fragments. The fold is written as it is defined,
line by line (a recursion over each key's arrival ranks), and the replay in its
*set* form (pairs of rows inside a key, range conditions), which is fine for a
small fixture and independent of the Spark plans.
"""

from __future__ import annotations

from stockcast.sources.tables import (
    CREATED_MOD,
    CREATED_MULT,
    DELIVER_MOD,
    DELIVER_MULT,
    STOCK_LATE_HOURS,
    STOCK_SECOND_CHECK_HOURS,
)

ORIGIN = "TIMESTAMP '2021-01-01 00:00:00'"

LINES = f"""lines AS (
  SELECT r_name AS store, concat('part-', CAST(l_partkey AS VARCHAR)) AS product,
         o_orderkey AS order_id, l_linenumber AS line_no,
         CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS quantity,
         {ORIGIN} + INTERVAL '1' HOUR * CAST(o_orderkey*{CREATED_MULT} % {CREATED_MOD} AS INT) AS created_at,
         {ORIGIN} + INTERVAL '1' HOUR * CAST(o_orderkey*{CREATED_MULT} % {CREATED_MOD} + o_orderkey*{DELIVER_MULT} % {DELIVER_MOD} AS INT) AS deliver_at,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'P' THEN 'PREPARED' ELSE 'CAPTURED' END AS status
  FROM orders JOIN lineitem ON l_orderkey=o_orderkey JOIN customer ON c_custkey=o_custkey
       JOIN nation ON n_nationkey=c_nationkey JOIN region ON r_regionkey=n_regionkey)"""

STOCK = f"""stock AS (
  SELECT r_name AS store, concat('part-', CAST(p_partkey AS VARCHAR)) AS product, c AS check_no,
         {ORIGIN} + INTERVAL '1' HOUR * CAST({STOCK_SECOND_CHECK_HOURS}*c + CASE WHEN p_partkey % 10 = 0 THEN {STOCK_LATE_HOURS} ELSE 0 END AS INT) AS arrived_at,
         {ORIGIN} + INTERVAL '1' HOUR * CAST(CASE WHEN c=0 THEN p_partkey%48 WHEN p_partkey%4=0 THEN -120
                                                  ELSE {STOCK_SECOND_CHECK_HOURS}+p_partkey%24 END AS INT) AS checked_at,
         CAST(p_size*(10-3*c) AS DOUBLE) AS quantity
  FROM region CROSS JOIN part CROSS JOIN (SELECT 0 AS c UNION ALL SELECT 1 AS c) x)"""

# newest check per key (latest checked_at, then latest arrival)
STOCK_TABLE = """stock_table AS (
  SELECT store, product, check_no, arrived_at, checked_at, quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY store, product ORDER BY checked_at DESC, arrived_at DESC) AS k
    FROM stock) WHERE k = 1)"""

INFO = "quantity, order_id, created_at, deliver_at, status"


def fold_states(src: str, name: str, order: str = "created_at,order_id,line_no,quantity") -> str:
    """CTE ``name``: rows of ``src`` with rn, occ (1 = key occupied after the row)
    and lastempty (last unoccupied rn <= the row, 0 if none). ``head`` is the
    quantity of the oldest stored info: only a lone one can be non-positive."""
    return f"""{name}_s AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY store,product ORDER BY {order}) AS rn FROM {src}),
{name}_r AS (
  SELECT store, product, rn, 1 AS occ, quantity AS head FROM {name}_s WHERE rn = 1
  UNION ALL
  SELECT s.store, s.product, s.rn, CASE WHEN r.occ=1 AND (s.quantity<=0 OR r.head<=0) THEN 0 ELSE 1 END,
         CASE WHEN r.occ=1 THEN r.head ELSE s.quantity END
  FROM {name}_r r JOIN {name}_s s ON s.store=r.store AND s.product=r.product AND s.rn=r.rn+1),
{name} AS (SELECT s.*, r.occ, coalesce(max(CASE WHEN r.occ=0 THEN s.rn END) OVER (
    PARTITION BY s.store,s.product ORDER BY s.rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS lastempty
  FROM {name}_s s JOIN {name}_r r ON s.store=r.store AND s.product=r.product AND s.rn=r.rn)"""


def live_infos(states: str, name: str) -> str:
    """CTE ``name``: distinct live infos per key after all rows of ``states``, with
    the rank of their first occurrence."""
    return f"""{name} AS (
  SELECT store, product, {INFO}, min(rn) AS rn FROM (
    SELECT *, max(CASE WHEN occ=0 THEN rn ELSE 0 END) OVER (PARTITION BY store,product) AS lastempty_all FROM {states})
  WHERE rn > lastempty_all GROUP BY store, product, {INFO})"""


def period_days(a: str, b: str) -> str:
    """Day part of the period between DATE expressions a and b."""
    tm = f"((year({b})*12+month({b}))-(year({a})*12+month({a})))"
    d = f"(day({b})-day({a}))"
    return (
        f"(CASE WHEN {tm} > 0 AND {d} < 0 THEN date_diff('day', CAST({a} + to_months(CAST({tm}-1 AS INTEGER)) AS DATE), {b})"
        f" WHEN {tm} < 0 AND {d} > 0 THEN {d} - day(last_day({b})) ELSE {d} END)"
    )


def day_values(days: int) -> str:
    return "(VALUES " + ", ".join(f"({d})" for d in range(1, days + 1)) + ") AS dd(day)"


SLICE_VALUES = "(VALUES ('A'), ('B')) AS sl(slice)"


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def ms(col: str) -> str:
    return f"epoch_ms({col})"
