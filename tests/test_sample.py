"""The shipped sample (8 stock checks, 3 orders) through the JSON codec."""

from pyspark.sql import functions as F

from stockcast.functions import codec as C
from stockcast.operators import orders as O
from stockcast.operators import projection as P
from stockcast.operators import replay as R
from stockcast.operators import stocks as S

# the shipped sample records, as they are written in the sample files
STOCK_JSON = [
    '{"store": "Plouzané", "product": "chocolat", "checkedAt": 1609459200000, "quantity": 20.0}',
    '{"store": "Plouzané", "product": "miel", "checkedAt": 1609459200000, "quantity": 10.0}',
    '{"store": "Plouzané", "product": "café", "checkedAt": 1609459200000, "quantity": 200.0}',
    '{"store": "Plouzané", "product": "cidre", "checkedAt": 1609459200000, "quantity": 10.0}',
    '{"store": "Shouffelweyersheim", "product": "chocolat", "checkedAt": 1609459200000, "quantity": 20.0}',
    '{"store": "Shouffelweyersheim", "product": "miel", "checkedAt": 1609459200000, "quantity": 10.0}',
    '{"store": "Shouffelweyersheim", "product": "café", "checkedAt": 1609459200000, "quantity": 150.0}',
    '{"store": "Shouffelweyersheim", "product": "bière", "checkedAt": 1609459200000, "quantity": 10.0}',
]
ORDER_JSON = [
    '{"orderId": "order-1", "store": "Plouzané", "createdAt": 1609581600000, "items":  [{"product": "café", "quantity": 7.0}], "deliverAt": 1609840800000, "status": "CAPTURED"}',
    '{"orderId": "order-2", "store": "Plouzané", "createdAt": 1609668000000, "items":  [{"product": "miel", "quantity": 1.0}, {"product": "chocolat", "quantity": 2.0}], "deliverAt": 1609754400000, "status": "CAPTURED"}',
    '{"orderId": "order-3", "store": "Plouzané", "createdAt": 1609668000000, "items":  [{"product": "café", "quantity": 5.0}], "deliverAt": 1609840800000, "status": "CAPTURED"}',
]


def _inputs(spark):
    raw_s = spark.createDataFrame([(v,) for v in STOCK_JSON + ["not json"]], "value string")
    raw_o = spark.createDataFrame([(v,) for v in ORDER_JSON], "value string")
    stock, rejected = C.split_decoded(raw_s, C.decode_stock("value"))
    assert rejected.count() == 1
    stock = stock.withColumn("arrived_at", F.col("checked_at"))
    orders, _ = C.split_decoded(raw_o, C.decode_order("value"))
    return O.explode_lines(orders), stock


def test_sample_snapshot(spark):
    lines, stock = _inputs(spark)
    snap = P.project_snapshot(S.stock_table(stock), O.order_table_rows(lines), 7).where("slice = 'A'")
    got = {}
    for r in snap.collect():
        got.setdefault((r["store"], r["product"]), {})[r["day"]] = r["quantity"]
    as_list = {k: [v[d] for d in range(1, 8)] for k, v in got.items()}
    assert as_list[("Plouzané", "café")] == [200, 200, 200, 200, 188, 188, 188]
    assert as_list[("Plouzané", "miel")] == [10, 10, 10, 9, 9, 9, 9]
    assert as_list[("Plouzané", "chocolat")] == [20, 20, 20, 18, 18, 18, 18]
    assert as_list[("Plouzané", "cidre")] == [10] * 7
    assert as_list[("Shouffelweyersheim", "café")] == [150] * 7
    assert len(as_list) == 8


def test_sample_replay(spark):
    lines, stock = _inputs(spark)
    rep = R.replay_projections(lines, stock, 7).where("slice = 'A'")
    events = rep.select("branch", "store", "product", "event_at").distinct()
    assert events.count() == 12
    assert events.where("branch = 'on_stock'").count() == 8
    first_cafe = (
        rep.where("branch = 'on_order' AND product = 'café'")
        .orderBy("event_at", "day")
        .collect()
    )
    assert [r["quantity"] for r in first_cafe[:7]] == [200, 200, 200, 200, 193, 193, 193]
    assert [r["quantity"] for r in first_cafe[7:]] == [200, 200, 200, 200, 188, 188, 188]
