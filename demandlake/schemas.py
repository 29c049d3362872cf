"""Table schemas (the public column contract of each layer)."""

from pyspark.sql import types as T

RAW_COLUMNS = [
    "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session",
]

RAW_CSV = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

BRONZE = T.StructType(
    [T.StructField(f"{c}_raw", T.StringType(), True) for c in RAW_COLUMNS]
    + [
        T.StructField("_source_uri", T.StringType(), True),
        T.StructField("_ingested_at", T.TimestampType(), True),
        T.StructField("_load_id", T.StringType(), True),
        T.StructField("_load_month", T.DateType(), True),
    ]
)

MANIFEST = T.StructType([
    T.StructField("load_month", T.StringType(), True),
    T.StructField("snapshot_date", T.StringType(), True),
    T.StructField("file", T.StringType(), True),
    T.StructField("gcs_uri", T.StringType(), True),
])

SCORING_REQUEST = T.StructType([
    T.StructField("product_id", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("prev_month_sales", T.IntegerType(), True),
])

PREDICTION_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("request_payload", T.StringType(), True),
    T.StructField("prediction_score", T.DoubleType(), True),
    T.StructField("model_version", T.StringType(), True),
])

FCT_EVENTS_COLUMNS = [
    "event_id", "event_ts", "event_date", "event_type", "product_id", "category_id",
    "category_code", "category_l1", "category_l2", "category_l3", "brand", "price",
    "user_id", "user_session", "_source_uri", "_ingested_at", "_load_id", "_load_month",
    "_loaded_at",
]

CALENDAR_COLUMNS = [
    "calendar_date", "month", "week_of_year", "day_of_week", "is_weekend",
    "days_to_end_of_month",
]
