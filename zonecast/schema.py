"""Canonical schemas, alias lists and fixed constants.

Fixed values (must equal the behaviour being reproduced; stated plainly):
the alias lists, quality bounds, window sizes, defaults, thresholds and
sample sizes below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column aliases, in precedence order.
# ---------------------------------------------------------------------------
PICKUP_ALIASES = ["tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"]
DROPOFF_ALIASES = ["tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropoff_datetime"]
PU_LOCATION_ALIASES = ["PULocationID", "pu_location_id"]
DO_LOCATION_ALIASES = ["DOLocationID", "do_location_id"]
AMOUNT_ALIASES = ["total_amount", "fare_amount"]
PASSENGER_ALIASES = ["passenger_count"]
DISTANCE_ALIASES = ["trip_distance"]
TIP_ALIASES = ["tip_amount"]
PICKUP_LAT_ALIASES = ["pickup_latitude"]
PICKUP_LON_ALIASES = ["pickup_longitude"]
DROPOFF_LAT_ALIASES = ["dropoff_latitude"]
DROPOFF_LON_ALIASES = ["dropoff_longitude"]

# ---------------------------------------------------------------------------
# Quality bounds (all strict), box (inclusive), anomaly bounds.
# ---------------------------------------------------------------------------
MIN_DURATION_MIN, MAX_DURATION_MIN = 1.0, 180.0
MIN_DISTANCE_MI, MAX_DISTANCE_MI = 0.2, 100.0
MIN_SPEED_MPH, MAX_SPEED_MPH = 1.0, 80.0
MIN_AMOUNT, MAX_AMOUNT = 0.0, 500.0
MIN_TIP, MAX_TIP = 0.0, 100.0  # tip >= 0 and < 100
BOX_LAT = (40.4, 41.0)
BOX_LON = (-74.5, -73.5)
ANOMALY_SLOW_MPH, ANOMALY_FAST_MPH = 3.0, 45.0

# ---------------------------------------------------------------------------
# Windows, watermark, look-back, retention, sample sizes.
# ---------------------------------------------------------------------------
STREAM_WINDOW = "10 minutes"
STREAM_SLIDE = "5 minutes"
WATERMARK = "5 minutes"
TRAIN_WINDOW = "10 minutes"
WINDOW_MINUTES = 10
LOOKBACK_HOURS = 48
LIVE_RETENTION_MIN = 10
LIVE_SAMPLE = 200
LIVE_TABLE_ROWS = 20
TOP_ZONES = 6
TOP_STATIONS = 12
RECENT_SECONDS = 60
SHIFT_DAYS_PER_CYCLE = 31

# ---------------------------------------------------------------------------
# Producer defaults, prediction bands, surge, labels.
# ---------------------------------------------------------------------------
DEFAULT_ZONE = 161
DEFAULT_ZONE_LAT, DEFAULT_ZONE_LON = 40.7549, -73.9840
DEFAULT_PASSENGERS = 1
DEFAULT_DISTANCE = 1.0
DEFAULT_AMOUNT = 10.0
TIP_LOW_FACTOR, TIP_HIGH_FACTOR = 0.9, 1.1
FARE_FROM_TIP_FACTOR = 5.0
SURGE_MIN, SURGE_MAX = 1.0, 3.0
SURGE_HIGH, SURGE_MODERATE = 2.0, 1.3
SURGE_LABELS = ("High", "Moderate", "Normal")
MAPE_ZERO_TRUTH = 1e-6
UNKNOWN_ZONE_PREFIX = "Unknown Zone "
# trip-level feature fallbacks (clip ranges and defaults)
TRIP_DURATION_DEFAULT, TRIP_SPEED_DEFAULT = 10.0, 15.0
TRIP_HOUR_DEFAULT, TRIP_DOW_DEFAULT = 12, 0
# marker size rule: base + total / max(top, 1) * span
MARKER_BASE, MARKER_SPAN = 12.0, 20.0

# ---------------------------------------------------------------------------
# Model features, target and training schedule defaults.
# ---------------------------------------------------------------------------
TIP_FEATURES = [
    "pu_location_id",
    "hour",
    "day_of_week",
    "is_weekend",
    "avg_trip_distance",
    "avg_duration_min",
    "avg_speed_mph",
    "trip_count",
]
TARGET = "avg_tip_amount"
TRAIN_FRACTION = 0.8
VALIDATION_FRACTION = 0.1
VALIDATION_MIN_ROWS = 5000
TRAIN_BATCH_ROWS = 250_000
INIT_TREES = 120
TREES_PER_BATCH = 40
GBT_MAX_DEPTH = 5
GBT_STEP = 0.05
GBT_SUBSAMPLE = 0.9
GBT_FEATURE_SUBSET = "0.9"
GBT_SEED = 42
MIN_TRAIN_ROWS, MIN_TEST_ROWS = 10, 5
MIN_CORE_ROWS, MIN_VAL_ROWS = 10, 5

AGG_KEYS = ["window_start", "window_end", "pu_location_id"]
#: trip measures summed per training window
TRAIN_MEASURES = ["trip_distance", "duration_min", "speed_mph", "tip_amount"]
PARTIAL_SUMS = ["trip_count", *(f"{m}_sum" for m in TRAIN_MEASURES)]

# ---------------------------------------------------------------------------
# Field and column names of the wire format and the stored tables
# ---------------------------------------------------------------------------
TRIP_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("pickup_datetime", T.StringType()),
        T.StructField("dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("emitted_at", T.StringType()),
    ]
)
EVENT_FIELDS = [f.name for f in TRIP_EVENT_SCHEMA.fields]

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("location_id", T.IntegerType()),
        T.StructField("zone_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

TRAFFIC_AGG_COLUMNS = [
    "window_start",
    "window_end",
    "pu_location_id",
    "trip_count",
    "avg_speed_mph",
    "avg_duration_min",
    "avg_trip_distance",
    "avg_total_amount",
    "anomaly_count",
    "service_date",
]

PREDICTION_COLUMNS = [
    "pu_location_id",
    "window_start",
    "window_end",
    "trip_count",
    "avg_speed_mph",
    "avg_trip_distance",
    "predicted_avg_fare",
    "predicted_tip_low",
    "predicted_tip_high",
    "surge_multiplier",
    "prediction_for_window_start",
    "prediction_for_window_end",
    "prediction_generated_at",
]

LIVE_TRIP_COLUMNS = [
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pu_location_id",
    "do_location_id",
    "total_amount",
    "emitted_at",
]

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
