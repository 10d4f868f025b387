"""Declared schemas: sources are read with these, never by guessing types from the data."""

from pyspark.sql import types as T

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.IntegerType(), False),
        T.StructField("customer_id", T.IntegerType(), False),
        T.StructField("amount", T.DecimalType(10, 2), False),
        T.StructField("order_date", T.TimestampType(), True),
    ]
)

ORDERS_TRANSFORMED = T.StructType(
    [
        T.StructField("order_id", T.IntegerType(), True),
        T.StructField("customer_id", T.IntegerType(), True),
        T.StructField("amount", T.DecimalType(10, 2), True),
        T.StructField("processed_timestamp", T.TimestampType(), True),
    ]
)

CUSTOMER_TOTALS = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("total_spent", T.DoubleType(), True),
        T.StructField("avg_order_amount", T.DoubleType(), True),
        T.StructField("order_count", T.LongType(), False),
    ]
)

SENSOR_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType(), True),
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("device_id", T.IntegerType(), True),
        T.StructField("reading_value", T.DoubleType(), True),
    ]
)
