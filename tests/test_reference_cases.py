"""The reference's own cases: direct projection and the two stream scenarios."""

from datetime import timedelta

from pyspark.sql import functions as F

from conftest import utc
from helpers import lines_df, per_day, stocks_df
from stockcast.operators import orders as O
from stockcast.operators import projection as P
from stockcast.operators import replay as R
from stockcast.operators import stocks as S
from stockcast.plans.catalog import stream_projection_of

BASE = utc(2021, 1, 1)


def _nested(spark, stock_qty, infos, days):
    df = spark.createDataFrame(
        [(stock_qty, BASE, infos)],
        "q double, checked_at timestamp, info array<struct<quantity:double,deliver_at:timestamp>>",
    )
    lines = df.select(P.projection_lines_expr(F.col("q"), F.to_date("checked_at"), F.col("info"), days).alias("l"))
    return [(x["day"], x["slice"], x["quantity"]) for x in lines.first()["l"]]


def _snapshot(spark, stock_qty, orders, days):
    stock = stocks_df(spark, [("s", "p", BASE, BASE, stock_qty)])
    lines = lines_df(
        spark, [("s", "p", "order-1", i + 1, q, BASE, d, "CAPTURED") for i, (q, d) in enumerate(orders)]
    )
    snap = P.project_snapshot(S.stock_table(stock), O.order_table_rows(lines), days)
    return per_day(snap.collect())


def test_one_order(spark):
    due = utc(2021, 1, 2, 10)
    assert _nested(spark, 100.0, [(10.0, due)], 2) == [(1, "A", 100.0), (1, "B", 100.0), (2, "A", 90.0), (2, "B", 90.0)]
    assert _snapshot(spark, 100.0, [(10.0, due)], 2) == [100.0, 90.0]


def test_two_orders(spark):
    orders = [(10.0, utc(2021, 1, 2, 10)), (20.0, utc(2021, 1, 3, 10))]
    assert [q for d, s, q in _nested(spark, 100.0, orders, 3) if s == "A"] == [100.0, 90.0, 70.0]
    assert _snapshot(spark, 100.0, orders, 3) == [100.0, 90.0, 70.0]


def _stream_inputs(spark, stock_first: bool):
    order_at = BASE if stock_first else BASE
    stock_at = BASE if stock_first else BASE + timedelta(seconds=1)
    stock = stocks_df(spark, [("store", "product", stock_at, BASE, 100.0)])
    lines = lines_df(
        spark, [("store", "product", "order-1", 1, 10.0, order_at, BASE + timedelta(days=2), "CAPTURED")]
    )
    return lines, stock


def _events(rows):
    out = {}
    for r in rows:
        out.setdefault((r["branch"], r["event_at"]), []).append(r)
    return sorted((k[0], per_day(v)) for k, v in out.items())


def test_stream_reacts_to_new_orders(spark):
    lines, stock = _stream_inputs(spark, stock_first=True)
    expected = [("on_order", [100.0, 100.0, 90.0]), ("on_stock", [100.0, 100.0, 100.0])]
    assert _events(R.replay_projections(lines, stock, 3).collect()) == expected
    assert _events(stream_projection_of(spark, lines, stock, days=3).collect()) == expected


def test_stream_order_before_stock(spark):
    lines, stock = _stream_inputs(spark, stock_first=False)
    expected = [("on_stock", [100.0, 100.0, 90.0])]
    assert _events(R.replay_projections(lines, stock, 3).collect()) == expected
    assert _events(stream_projection_of(spark, lines, stock, days=3).collect()) == expected
