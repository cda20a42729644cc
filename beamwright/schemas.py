"""Explicit schemas; nothing in the library infers one."""

from pyspark.sql import types as T

ENDPOINTS = "endpoint_key string, name string, uuid string, uri string, root_path string"
INVENTORY = (
    "endpoint_key string, rel_path string, name string, type string, "
    "size bigint, last_modified timestamp, checksum string"
)
TRANSFERS = (
    "task_id string, src_key string, dst_key string, rel_path string, status string, "
    "bytes bigint, bytes_checksummed bigint, files bigint, eff_bps double, "
    "start_ts timestamp, end_ts timestamp"
)
TASK_EVENTS = "task_id bigint, event_id bigint, ts timestamp, status string, nice_status string"
JOB_EVENTS = "job_id bigint, event_id bigint, ts timestamp, state string"
SCAN_META = (
    "scan_id string, key string, str_value string, num_value double, "
    "str_list array<string>, num_list array<double>"
)
ISSUES = "scan_id string, severity string, msg string, exception string"
FRAMES = "scan_id string, kind string, idx int, row int, values array<float>"
SLICES = "scan_id string, z int, y int, values array<double>"
SPECS = "line_no int, line string"
RULES = (
    "flow string, path_kind string, location string, delay_key string, "
    "source string, check string"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
