"""Text rules: endpoint paths and the wire format of instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_endpoint(url: Column) -> Column:
    """The path of a request: query string and fragment removed."""
    return F.substring_index(F.substring_index(url, "?", 1), "#", 1)


def iso_instant(ts: Column) -> Column:
    """ISO 8601 with zone offset; microseconds appear only when there are any."""
    return (
        F.when(F.unix_micros(ts) % 1_000_000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))
    )
