"""Packed columns of hashes, and runs of equal sorted keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = False
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def least(values: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The least value of each run, for every row."""
    return np.minimum.reduceat(values, np.flatnonzero(new))[np.cumsum(new) - 1] if len(values) else values


def bytes_of(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def values_of(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(np.uint64).ravel()


def arrow_schema(schema: str | StructType) -> pa.Schema:
    """The Arrow form of a schema."""
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)
