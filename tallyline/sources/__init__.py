"""Typed tables, month-partitioned facts, the raw lake, and network connectors."""

from tallyline.sources.connectors import kafka_sink, kafka_source, read_jdbc
from tallyline.sources.lake import (
    current_version, path_exists, publish_version, read_monthly, read_raw, write_monthly,
)
from tallyline.sources.schema import SCHEMAS, Tables, load, schema_of

__all__ = [
    "SCHEMAS", "Tables", "current_version", "kafka_sink", "kafka_source", "load", "path_exists",
    "publish_version", "read_jdbc", "read_monthly", "read_raw", "schema_of", "write_monthly",
]
