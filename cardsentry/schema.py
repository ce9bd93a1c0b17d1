"""Schemas and fixed values of the transaction / alert data model.

Internal transaction row (one flat DataFrame, the input of every detector):

    seq      BIGINT         arrival order / unique id (Kafka offset, event id)
    card_id  INT
    ts       TIMESTAMP_NTZ  payload time; batch windows run on it
    value    DECIMAL        any scale; sources that parse text use DECIMAL(38,18)
    user_id  INT
    lim      INT            the card's limit, carried on every row
    lat, lon DOUBLE         transaction position

A streaming source adds ``event_ts TIMESTAMP`` (the record timestamp), because
watermarks need a zoned timestamp.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
REASON_ABOVE_LIMIT = "Transaction above limit repeated within 24 hours"
REASON_LOW_VALUES = "5th percentile lower than 1.0"
REASON_LOCATION_PREFIX = "Localization changed too fast. Time between is "
REASON_LOCATION_HOURS = "hours. Computed velocity is: "
REASON_LOCATION_DISTANCE = " for distance "
REASON_LOCATION_FIRST_TS = ". One transaction timestamp is "
REASON_LOCATION_SECOND_TS = " the second is "
# Reason of the trailing-24h rule (Polish in the reference): prefix + user id + suffix.
REASON_TRAILING_PREFIX = "Użytkownik "
REASON_TRAILING_SUFFIX = " przekroczył limit co najmniej drugi raz w ciągu 24 godzin."
TRAILING_MIN_COUNT = 2
LOCATION_REASON_PATTERN = r"Localization changed too fast.*"

EARTH_RADIUS_KM = 6371.0
ABOVE_LIMIT_ALLOWED = 1        # groups with at most this many above-limit rows are fine
ABOVE_LIMIT_SKIP = 3           # alerts start at the 4th above-limit row of a group
LOW_VALUE_THRESHOLD = "1.0"    # strict decimal bound of the 5th percentile
LOW_VALUE_PERCENT = 0.05
MAX_CENTRE_DISTANCE_KM = 100.0
MIN_AIRPLANE_DISTANCE_KM = 300.0
MAX_CAR_VELOCITY_KMH = 150.0
MAX_AIRPLANE_VELOCITY_KMH = 900.0
CHART_LOW_VALUE = "0.5"

WINDOW_ABOVE_LIMIT = "24 hours"
WINDOW_LOW_VALUES = "7 days"
WINDOW_LOCATION = "1 day"

# Topic and CSV layout names of the reference deployment.
SOURCE_TOPIC = "Transactions"
ALERT_TOPIC = "Frauds"
CSV_FLUSH_ROWS = 10_000        # the dump scripts' rows per file: a choice of max_rows here
TX_CSV_HEADER = ["cardId", "timestamp", "value", "userId", "limit",
                 "localization.latitude", "localization.longitude"]
ALERT_CSV_HEADER = ["transaction.cardId", "transaction.timestamp", "transaction.value",
                    "transaction.userId", "transaction.limit",
                    "transaction.localization.latitude", "transaction.localization.longitude",
                    "isAboveLimit", "fraudReason"]

# ---------------------------------------------------------------------------
# Spark types
# ---------------------------------------------------------------------------
VALUE_TYPE = T.DecimalType(18, 2)
WIDE_VALUE_TYPE = T.DecimalType(38, 18)

LOCALIZATION = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# What the producer writes: numbers as JSON strings except the coordinates.
# Everything scalar is read as STRING and cast afterwards, so both "5" and 5
# are accepted (a typed INT field would turn "5" into NULL).
WIRE_SCHEMA = T.StructType([
    T.StructField("cardId", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("limit", T.StringType()),
    T.StructField("localization", LOCALIZATION),
])

TRANSACTION = T.StructType([
    T.StructField("cardId", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("value", VALUE_TYPE),
    T.StructField("userId", T.IntegerType()),
    T.StructField("limit", T.IntegerType()),
    T.StructField("localization", LOCALIZATION),
    T.StructField("aboveLimit", T.BooleanType()),
])

ALERT = T.StructType([
    T.StructField("transaction", TRANSACTION),
    T.StructField("fraudReason", T.StringType()),
])

TX_COLUMNS = ["seq", "card_id", "ts", "value", "user_id", "lim", "lat", "lon"]
ALERT_COLUMNS = TX_COLUMNS + ["above_limit", "fraud_reason"]

TX_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("card_id", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("value", VALUE_TYPE),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("lim", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])
