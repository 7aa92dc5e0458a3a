"""Record types of the domain (stock checks, orders, order lines, projections).

Column names are snake_case; the JSON wire format keeps the camelCase field
names and encodes instants as epoch milliseconds (see ``functions.codec``).
"""

from pyspark.sql import types as T

KEYS = ["store", "product"]
#: A record's place in its topic. Both inputs are keyed topics: a place never repeats.
PLACE = ["partition", "offset"]

# fixed values: order states and projection slices
ORDER_STATES = ["CAPTURED", "PREPARED", "DELIVERED", "CANCELED"]
SLICES = ["A", "B"]
DEFAULT_DAYS = 7

STOCK = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("checked_at", T.TimestampType()),
        T.StructField("quantity", T.DoubleType()),
    ]
)

ORDER_ITEM = T.StructType(
    [T.StructField("product", T.StringType()), T.StructField("quantity", T.DoubleType())]
)

ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("store", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("items", T.ArrayType(ORDER_ITEM)),
        T.StructField("deliver_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

# one element of the reduced order list kept per (store, product)
ORDER_INFO = T.StructType(
    [
        T.StructField("quantity", T.DoubleType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("deliver_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)
INFO_FIELDS = [f.name for f in ORDER_INFO.fields]

PROJECTION_LINE = T.StructType(
    [
        T.StructField("day", T.IntegerType()),
        T.StructField("slice", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
    ]
)

PROJECTION = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("current_quantity", T.DoubleType()),
        T.StructField("lines", T.ArrayType(PROJECTION_LINE)),
    ]
)

# JSON wire schemas: camelCase names, instants as epoch milliseconds
STOCK_JSON = T.StructType(
    [
        T.StructField("store", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("checkedAt", T.LongType()),
        T.StructField("quantity", T.DoubleType()),
    ]
)

ORDER_JSON = T.StructType(
    [
        T.StructField("orderId", T.StringType()),
        T.StructField("store", T.StringType()),
        T.StructField("createdAt", T.LongType()),
        T.StructField("items", T.ArrayType(ORDER_ITEM)),
        T.StructField("deliverAt", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

STOCK_KEY_JSON = T.StructType([T.StructField("store", T.StringType()), T.StructField("product", T.StringType())])
ORDER_KEY_JSON = T.StructType([T.StructField("orderId", T.StringType())])
