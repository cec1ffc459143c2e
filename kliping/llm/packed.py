"""Arrays packed into one value of a row, and rows of Arrow tables."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def _compressed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _expanded(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def pack(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on, which leaves little of small numbers."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return _compressed(planes.tobytes())


def unpack(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(_expanded(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def pack_all(**arrays: np.ndarray) -> bytes:
    return _compressed(pickle.dumps(arrays, 5))


def unpack_all(data: bytes) -> dict[str, np.ndarray]:
    return pickle.loads(_expanded(data))


def rows_of(table: pa.Table) -> Iterator[dict]:
    """The rows one by one, so that their values are not all copied at once."""
    for k in range(table.num_rows):
        yield table.slice(k, 1).to_pylist()[0]


def table_of(rows: list[tuple], schema: StructType) -> pa.Table:
    out = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [[] for _ in out]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)
