"""Zarr (version 2) arrays of ragged images, with attributes ``shape`` and ``object_number``.

Each chunk is a task's unit: the driver sees paths only, and no attribute list. Chunks are stored plainly
or by zlib, gzip or zstd; other compressors need the numcodecs library.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import path_columns

_CHUNKS = "path string, chunk int, first int, meta string, shapes string, numbers array<long>"
_EVENTS = "path string, zarr_idx int, object_number long, shape array<int>, pixels array<double>"
_EVENT_SCHEMA = pa.schema([("path", pa.string()), ("zarr_idx", pa.int32()), ("object_number", pa.int64()), ("shape", pa.list_(pa.int32())), ("pixels", pa.list_(pa.float64()))])


def _read(path: str, name: str) -> bytes | None:
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    try:
        with system.open_input_stream(f"{at}/{name}", compression=None) as f:
            return f.read()
    except FileNotFoundError:
        return None


def _inflate(data: bytes, how: dict | None) -> bytes:
    if how is None:
        return data
    if how["id"] in ("zlib", "gzip"):
        return zlib.decompress(data, 47)
    if how["id"] == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    try:
        import numcodecs
    except ImportError as e:
        raise ValueError(f"zarr compressor {how['id']!r} needs the numcodecs library") from e
    return bytes(numcodecs.get_codec(how).decode(data))


def ragged(data: bytes, kind: str) -> list[np.ndarray]:
    """The arrays of one chunk: their number, then each with its length in bytes before it."""
    n, at, out = int.from_bytes(data[:4], "little"), 4, []
    for _ in range(n):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 4))
        at += 4 + size
    return out


def _list_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            meta, attributes = (_read(path, n) for n in (".zarray", ".zattrs"))
            if meta is None or attributes is None:
                raise FileNotFoundError(f"{path} is no zarr array with attributes")
            m, a = json.loads(meta), json.loads(attributes)
            step = m["chunks"][0]
            for k, first in enumerate(range(0, m["shape"][0], step)):
                row = [path, k, first, meta.decode(), json.dumps(a["shape"][first : first + step]), a["object_number"][first : first + step]]
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=["path", "chunk", "first", "meta", "shapes", "numbers"])


def read(spark: SparkSession, paths: list[str], channels: list[int] | None = None, regex: str | None = None) -> DataFrame:
    """Image rows: event, path, zarr_idx, object_number, the groups of ``regex``, shape, pixels.

    ``channels`` picks channels while a chunk is decoded. An element that its chunk lacks has no pixels.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                meta = json.loads(row["meta"])
                kind = next((f["dtype"] for f in meta.get("filters") or [] if f["id"] == "vlen-array"), None)
                if kind is None:
                    raise ValueError(f"{row['path']}: a ragged array (filter vlen-array) is needed")
                data = _read(row["path"], str(row["chunk"]))
                held = ragged(_inflate(data, meta.get("compressor")), kind) if data is not None else []
                for k, (shape, number) in enumerate(zip(json.loads(row["shapes"]), row["numbers"])):
                    x = held[k].reshape(shape) if k < len(held) else None
                    if x is not None and channels is not None:
                        x = x[list(channels)]
                    values = [row["path"], row["first"] + k, number, list(shape if x is None else x.shape), None if x is None else x.ravel().astype(np.float64)]
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _EVENT_SCHEMA)], schema=_EVENT_SCHEMA)

    arrays = spark.createDataFrame([(p.rstrip("/"),) for p in paths], "path string")
    chunks = arrays.mapInArrow(_list_chunks, _CHUNKS)
    # chunks are dealt out evenly, however many arrays there are; pixels haven't been read yet
    events = chunks.repartition("path", "chunk").mapInArrow(load, _EVENTS)
    events = path_columns(events, regex)
    more = [c for c in events.columns if c not in ("shape", "pixels")]
    return events.select(F.concat_ws("#", "path", F.col("zarr_idx").cast("string")).alias("event"), *more, "shape", "pixels")
