"""Record schemas and the fixed rule values of the sensor domain."""

from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("time", T.StringType()),
    T.StructField("DeviceId", T.IntegerType()),
    T.StructField("sensor1", T.DoubleType()),
    T.StructField("sensor2", T.DoubleType()),
    T.StructField("sensor3", T.DoubleType()),
    T.StructField("motor1", T.DoubleType()),
    T.StructField("motor2", T.DoubleType()),
    T.StructField("motor3", T.DoubleType()),
    T.StructField("isFail", T.BooleanType()),
])
"""Wire form. Motors arrive with decimals from some devices, so they are decoded as doubles and rounded."""

ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

NESTED_READING = T.StructType([
    T.StructField("device_id", T.IntegerType()),
    T.StructField("location", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("efficiency", T.DoubleType()),
    T.StructField("operation_hours", T.DoubleType()),
    T.StructField("sensors", T.StructType([
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("vibration", T.DoubleType()),
        T.StructField("power_consumption", T.DoubleType()),
    ])),
])

THRESHOLD = T.StructType([
    T.StructField("sensor_name", T.StringType()),
    T.StructField("min_val", T.DoubleType()),
    T.StructField("max_val", T.DoubleType()),
    T.StructField("unit", T.StringType()),
])

SENSORS = ("sensor1", "sensor2", "sensor3")
MOTORS = ("motor1", "motor2", "motor3")
MEASURES = SENSORS + MOTORS
REQUIRED = ("time", "DeviceId") + MEASURES + ("isFail",)
KEYS = ("DeviceId", "time")

# --- fixed values: must equal the rule book for right results ---------------------------------

RANGES = {
    "sensor1": (0, 100),
    "sensor2": (0, 100),
    "sensor3": (0, 150),
    "motor1": (0, 2000),
    "motor2": (0, 1500),
    "motor3": (0, 1800),
}
DEVICE_RANGE = (1, 5)
GATE_RANGE = (0, 100)                      # ingest gate: every sensor, the pressure one too
RATED_RPM = {"motor1": 2000.0, "motor2": 1500.0, "motor3": 1800.0}

CRITICAL_LIMITS = {"sensor1": 90.0, "sensor2": 85.0, "sensor3": 130.0}
WARNING_LIMITS = {"sensor1": 81.0, "sensor2": 76.5, "sensor3": 117.0}
WARNING_LIMITS_76 = {"sensor1": 81.0, "sensor2": 76.0, "sensor3": 117.0}

Z_LIMITS = {"sensor1": 3.0, "sensor2": 3.0, "sensor3": 3.0, "motor1": 2.5, "motor2": 2.5, "motor3": 2.5}
IQR_ROWS = 100
IQR_FACTOR = 1.5

STATUS_POINTS = {"CRITICAL": 0.4, "HIGH_WARNING": 0.3, "WARNING": 0.15, "NORMAL": 0.0, "DATA_MISSING": 0.2}
UNKNOWN_STATUS_POINTS = 0.2
ALERT_STATUSES = ("CRITICAL", "HIGH_WARNING")

MIN_COMPLETENESS = 0.95
KPI_TARGETS = {"completeness": 0.99, "accuracy": 0.95, "timeliness": 30.0, "consistency": 0.98}
MAX_DUPLICATE_RATIO = 0.02
MAX_DELAY_SECONDS = 60
EXPECTED_INTERVAL_SECONDS = 10
INTERVAL_TOLERANCE_SECONDS = 2

THRESHOLD_ROWS = [
    ("sensor1", 0.0, 100.0, "temperature"),
    ("sensor2", 0.0, 100.0, "humidity"),
    ("sensor3", 0.0, 150.0, "pressure"),
]

STORE_BY_CLASS = {"normal": "HDFS_MAIN", "failed": "HDFS_ALERT", "invalid": "HDFS_QUARANTINE"}
RETENTION_DAYS_BY_CLASS = {"normal": 365, "failed": 1095, "invalid": 30}
RETENTION_DAYS_BY_LAYER = {"raw": 30, "processed": 365, "alerts": 1095}
CODEC_BY_LAYER = {"raw": "gzip", "processed": "snappy", "alerts": "lz4"}

LOG_LEVEL_BY_SEVERITY = {"low": "INFO", "medium": "WARNING", "high": "ERROR", "critical": "CRITICAL"}
