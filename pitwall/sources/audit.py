"""The audit log that landing, loading and building write."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.sources.warehouse import Warehouse

TABLE = "load_audit"
# The day that an object's key is stamped with. Loads ask for the rows of their own objects' days only.
KEY_DAY = "key_day"
NO_DAY = "none"

AUDIT_COLUMNS = {
    "event": "string",
    "severity": "string",
    "service": "string",
    "object_key": "string",
    "source": "string",
    "endpoint": "string",
    "target_table": "string",
    "output_rows": "bigint",
    "schema_source": "string",
    "reason": "string",
    "logged_at": "timestamp",
}


def key_day(key: Column) -> Column:
    """The day in the stamp of an object's key, as yyyyMMdd."""
    day = F.regexp_extract(key, r"(\d{8})T\d{6}Z", 1)
    return F.coalesce(F.nullif(day, F.lit("")), F.lit(NO_DAY))


def write_audit(warehouse: Warehouse, rows: DataFrame, batch: str) -> None:
    """Add audit rows; columns that ``rows`` lacks are NULL, and the same ``batch`` replaces its own rows."""
    given = set(rows.columns)
    columns = [
        (F.col(name) if name in given else F.lit(None)).cast(dtype).alias(name) for name, dtype in AUDIT_COLUMNS.items()
    ]
    rows = rows.select(*columns).withColumn(KEY_DAY, key_day(F.col("object_key")))
    warehouse.append("raw", TABLE, rows, batch, (KEY_DAY,))


def write_events(warehouse: Warehouse, service: str, events: Sequence[dict], batch: str | None = None) -> None:
    """Add a few events of a driver program, logged now."""
    if not events:
        return
    schema = ", ".join(f"{name} {dtype}" for name, dtype in AUDIT_COLUMNS.items())
    rows = warehouse.spark.createDataFrame([{"service": service, **e} for e in events], schema)
    rows = rows.withColumn("logged_at", F.coalesce("logged_at", F.current_timestamp()))
    write_audit(warehouse, rows.coalesce(1), batch or f"{service}-{uuid.uuid4().hex}")


def audit_log(warehouse: Warehouse) -> DataFrame:
    """All audit rows with their load_batch; empty before the first."""
    columns = ", ".join(f"{name} {dtype}" for name, dtype in AUDIT_COLUMNS.items())
    if not warehouse.has("raw", TABLE):
        return warehouse.spark.createDataFrame([], f"{columns}, load_batch string, {KEY_DAY} string")
    return warehouse.appended("raw", TABLE)
