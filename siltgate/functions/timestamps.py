"""Event time from whichever columns carry it."""

from __future__ import annotations

from pyspark.sql import types as T

from siltgate.functions import sql


def first_timestamp(schema: T.StructType, *columns: str) -> str:
    """SQL for the first of the columns that holds a readable timestamp, else NULL.

    Text is parsed leniently (unreadable gives NULL). Zone-free columns stay
    zone-free as long as every candidate is zone-free or a date.
    """
    kinds = {column: schema[column].dataType for column in columns}
    zone_free = any(isinstance(k, T.TimestampNTZType) for k in kinds.values()) and all(
        isinstance(k, (T.TimestampNTZType, T.DateType)) for k in kinds.values()
    )
    target = "TIMESTAMP_NTZ" if zone_free else "TIMESTAMP"
    parsed = []
    for column, kind in kinds.items():
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            parsed.append(f"cast({sql.name(column)} AS {target})")
        else:
            parsed.append(f"try_to_timestamp(cast({sql.name(column)} AS STRING))")
    return f"coalesce({', '.join(parsed)})"
