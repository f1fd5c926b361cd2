"""Record layouts of the sources and datasets."""

from pyspark.sql import types as T

# The field names and types below are those of the sources' records.

# Record as delivered by Spark's Kafka source (key and value are binary).
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])

# JSON payload carried in the Kafka value of a card transaction.
TRANSACTION_PAYLOAD = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("payment_channel", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("transaction_timestamp", T.TimestampType()),
    T.StructField("is_international", T.BooleanType()),
    T.StructField("status", T.StringType()),
])

# One watchlist entry per JSON object; every field arrives as text.
WATCHLIST_FIELDS = [
    "watchlist_id", "watch_type", "entity_id", "risk_level", "action",
    "reason_code", "reason_description", "status", "effective_from",
    "reported_by", "reported_source", "country", "city",
]
WATCHLIST_RECORD = T.StructType([T.StructField(f, T.StringType()) for f in WATCHLIST_FIELDS])

# Customer row as ingested from the operational database (bronze.customers).
CUSTOMER_RECORD = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("annual_income", T.DoubleType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("account_open_date", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("preferred_spending_min", T.DoubleType()),
    T.StructField("preferred_spending_max", T.DoubleType()),
    T.StructField("preferred_city", T.StringType()),
    T.StructField("preferred_country", T.StringType()),
    T.StructField("trusted_device_id", T.StringType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("card_type", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("transaction_limit", T.DoubleType()),
])

# Fixed formats of the inputs.
WATCHLIST_TIME_FORMAT = "dd-MMM-yyyy HH:mm:ss"
CUSTOMER_DATE_FORMAT = "yyyy-MM-dd"
