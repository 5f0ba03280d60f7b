"""Column contracts of every layer, in order."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data contract.
LAT_MIN, LAT_MAX = 37.9, 38.1
LON_MIN, LON_MAX = 23.6, 23.9
REPAIRED_SPEED_MAX = 200.0
REPAIRED_ACCELERATION_MAX = 50.0
REPAIRED_TIME_MAX = 100000.0
COORDINATE_PLACES = 6
KINEMATIC_PLACES = 4
PARITY_TOLERANCE = 1e-6
MAX_REJECT_FRACTION = 0.01
HEADER_FIELDS = 4
FRAME_FIELDS = 6
RAW_VEHICLE_TYPES = ["Car", "Motorcycle", "Taxi", "Bus", "Medium Vehicle", "Heavy Vehicle"]
VEHICLE_TYPES = ["car", "motorcycle", "taxi", "bus", "medium vehicle", "heavy vehicle"]
RUN_STATUSES = ["success", "failed", "skipped"]

TRACK_KEY = ["source_file", "track_id"]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _schema(ddl: str, nullable: bool = False) -> T.StructType:
    columns = [column.split() for column in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], nullable) for name, kind in columns])


# One logical record: the physical lines that start in `block`, in order, joined by line feeds.
# `seq` 0 holds the lines of a file that come before its first record start.
RECORD = _schema("source_file string, block bigint, seq bigint, text string", nullable=True)

FRAME = _schema(
    "source_file string, track_id int, vehicle_type string, traveled_d_m double, avg_speed_ms double, "
    "lat double, lon double, speed_ms double, lon_acc_ms2 double, lat_acc_ms2 double, timestamp_s double"
)

SILVER = T.StructType(FRAME.fields + _schema("bronze_key string, ingested_at timestamp").fields)

RAW = T.StructType(
    _schema("id bigint, source_file string, file_hash string").fields
    + FRAME.fields[1:]
    + _schema("ingested_at timestamp").fields
)

STAGING = T.StructType(
    _schema("raw_id bigint, source_file string, file_hash string").fields
    + FRAME.fields[1:]
    + _schema("ingested_at timestamp").fields
)

SUMMARY = _schema(
    "source_file string, track_id int, vehicle_type string, frame_count bigint, start_time_s double, "
    "end_time_s double, duration_s double, traveled_d_m double, avg_speed_ms double, max_speed_ms double, "
    "min_speed_ms double, avg_lon_acc_ms2 double, avg_lat_acc_ms2 double, max_lon_acc_ms2 double, "
    "max_lat_acc_ms2 double, start_lat double, start_lon double, end_lat double, end_lon double"
)

VEHICLE_TYPE_DIM = _schema(
    "vehicle_type string, trajectory_count bigint, average_traveled_distance_m double, "
    "average_speed_ms double, average_duration_s double"
)

REJECT = _schema(
    "source_file string, path string, record_no bigint, track_id string, reason_code string, detail string",
    nullable=True,
)

LEDGER = _schema("path string, source_file string, size bigint, file_hash string, batch bigint", nullable=True)

RUN = _schema(
    "run_id string, dag_id string, task_id string, source_file string, file_hash string, status string, "
    "rows_loaded bigint, rows_rejected bigint, error_message string, started_at timestamp, "
    "finished_at timestamp, duration_s double",
    nullable=True,
)

FRAME_REQUIRED = ["track_id", "vehicle_type", "lat", "lon", "speed_ms", "timestamp_s"]
SUMMARY_EXACT = ["source_file", "track_id", "vehicle_type", "frame_count"]
SUMMARY_FLOATS = [f.name for f in SUMMARY.fields if isinstance(f.dataType, T.DoubleType)]


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
