"""Schemas of the stored layers."""

from pyspark.sql import types as T

from fumarole.settings import SENSORS

RAW = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("reading_value", T.FloatType()),
    T.StructField("gas_type", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("load_batch_id", T.StringType()),
])

CLEANED_EXTRA = [
    "is_imputed", "rolling_avg", "moving_std", "outlier_flag", "reading_normalized", "reading_date",
]
FEATURES_EXTRA = [
    "hour_of_day", "is_weekend", "lag_1", "lag_5", "rolling_min", "rolling_max", "z_score",
    "rate_of_change", "peak_frequency", "stability_score", "anomaly_flag",
    "sensor_correlation", "gas_concentration_est",
]
FINAL_EXTRA = ["ml_anomaly", "anomaly_score"]
FINAL_COLUMNS = RAW.names + CLEANED_EXTRA + FEATURES_EXTRA + FINAL_EXTRA

# Types a stored column takes at the sink; computation stays in double and int.
SINK_TYPES = {
    "reading_value": "float", "reading_normalized": "float",
    "sensor_correlation": "float", "gas_concentration_est": "float",
    "is_imputed": "tinyint", "outlier_flag": "tinyint", "is_weekend": "tinyint",
    "anomaly_flag": "tinyint", "ml_anomaly": "tinyint",
}

CORRUPT = "_corrupt_record"


def message_schema(channels=tuple(SENSORS), corrupt: bool = True) -> T.StructType:
    """One JSON message: instant, feed, and a reading for every channel."""
    fields = [T.StructField("timestamp", T.StringType()), T.StructField("source", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in channels]
    fields.append(T.StructField("_received_at", T.StringType()))
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


NODES = T.StructType([
    T.StructField("tree_id", T.IntegerType()),
    T.StructField("node_id", T.IntegerType()),
    T.StructField("feature", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()),
    T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
])
