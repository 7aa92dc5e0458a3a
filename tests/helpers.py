"""Small builders of typed input frames for the tests."""

from pyspark.sql import types as T

LINES = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("deliver_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

STOCKS = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("arrived_at", T.TimestampType()),
        T.StructField("checked_at", T.TimestampType()),
        T.StructField("quantity", T.DoubleType()),
    ]
)


def lines_df(spark, rows):
    return spark.createDataFrame(rows, LINES)


def stocks_df(spark, rows):
    return spark.createDataFrame(rows, STOCKS)


def per_day(rows, slice_="A"):
    """{(event key...): [quantity per day]} from flat projection rows."""
    return [r["quantity"] for r in sorted(rows, key=lambda r: r["day"]) if r["slice"] == slice_]
