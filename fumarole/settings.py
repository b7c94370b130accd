"""Defaults of the telemetry model, shared by every operator."""

# Results depend on them, so they are stated once, as they are.
SENSORS = [f"S{i:02d}" for i in range(1, 17)]
N_CHANNELS = 16
TARGET_NAMES = ("class", "target")
FIRST_INSTANT = "2025-01-01 00:00:00"
GAS_TYPE = "mixed"
UNIT = "sensor_signal"
FEEDS = ("batch", "http_stream", "mqtt_stream", "http_received", "mqtt_received")
MAX_GAP = 3
WINDOW = 30
MIN_CLEAN = 5
THRESHOLD = 3.5
READING_RANGE = (-5000, 70000)
NORMALIZED_RANGE = (0, 1)
N_TREES = 150
SUBSAMPLE = 256
SEED = 42
CONTAMINATION = 0.03
ALERT = "SENSOR_ANOMALY"
TAIL_ROWS = 3000
RECENT_ALERTS = 100
MODEL_FEATURES = [
    "reading_value", "rolling_avg", "moving_std", "z_score", "rate_of_change",
    "sensor_correlation", "stability_score", "lag_1", "lag_5", "peak_frequency",
]
SUMMARY_FEATURES = [
    "rolling_avg", "z_score", "anomaly_flag", "hour_of_day", "is_weekend",
    "sensor_correlation", "moving_std", "peak_frequency", "rate_of_change", "stability_score",
]
ALERT_COLUMNS = ["timestamp", "sensor_id", "reading_value", "z_score", "anomaly_score"]

# Column names of the long model.
SENSOR = "sensor_id"
TIME = "timestamp"
VALUE = "reading_value"
KEYS = (SENSOR, TIME)

# Physical choices; they change plans, never results.
SMALL_BYTES = 64 << 20      # an input estimated below this fits one task or one broadcast
LOOKUP_ROWS = 1_000_000     # most rows a side may have to be sent to every executor
BLOCK_ROWS = 1_000_000      # a series longer than this is cut into blocks
MAX_BLOCKS = 50_000         # blocks grow instead of becoming more numerous than this
CELLS_PER_BLOCK = 16
