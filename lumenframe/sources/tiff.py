"""TIFF files: one file a channel, or one file an event with a frame a channel.

The decoder reads classic TIFF, either byte order: 8 to 64-bit integers and floats, one sample a pixel,
strips or tiles, stored plainly, by deflate or by PackBits. Other files raise, naming the feature.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import path_columns

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
_CODES = {1: "B", 3: "H", 4: "I"}
_KINDS = {1: "u", 2: "i", 3: "f"}


def _unpack_bits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n, at = data[at], at + 1
        if n < 128:
            out += data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            out += data[at : at + 1] * (257 - n)
            at += 1
    return bytes(out)


_STORED = {1: bytes, 8: zlib.decompress, 32946: zlib.decompress, 32773: _unpack_bits}


def decode(data: bytes, wanted: list[int] | None = None) -> np.ndarray:
    """(frames, rows, columns) of a TIFF file; only the ``wanted`` frames, in that order, if given."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a classic TIFF file")
    at, directories = struct.unpack_from(order + "I", data, 4)[0], []
    while at and len(directories) < 65536:
        count = struct.unpack_from(order + "H", data, at)[0]
        tags = {}
        for k in range(count):
            tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            where = at + 10 + 12 * k
            if n * _SIZES.get(kind, 0) > 4:
                where = struct.unpack_from(order + "I", data, where)[0]
            if kind in _CODES:
                tags[tag] = struct.unpack_from(f"{order}{n}{_CODES[kind]}", data, where)
        directories.append(tags)
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * count)[0]
    frames = [_frame(data, directories[k], order) for k in (range(len(directories)) if wanted is None else wanted)]
    return np.stack(frames)


def _frame(data: bytes, tags: dict[int, tuple[int, ...]], order: str) -> np.ndarray:
    def one(tag: int, default: int) -> int:
        return tags.get(tag, (default,))[0]

    width, height, bits = one(256, 0), one(257, 0), one(258, 1)
    stored, differenced = one(259, 1), one(317, 1)
    if one(277, 1) != 1 or bits not in (8, 16, 32, 64) or stored not in _STORED or differenced not in (1, 2):
        raise ValueError(f"unsupported TIFF: {one(277, 1)} samples of {bits} bits, compression {stored}, predictor {differenced}")
    kind = np.dtype(f"{order}{_KINDS[one(339, 1)]}{bits // 8}")
    tiled = 324 in tags
    offsets, lengths = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    across, down = (one(322, width), one(323, height)) if tiled else (width, min(one(278, height), height))
    out = np.empty((height, width), kind)
    per_row = -(-width // across)
    for k, (offset, length) in enumerate(zip(offsets, lengths)):
        r, c = k // per_row * down, k % per_row * across
        rows = down if tiled else min(down, height - r)
        block = np.frombuffer(_STORED[stored](data[offset : offset + length]), kind, rows * across).reshape(rows, across)
        if differenced == 2:
            block = np.cumsum(block, axis=1, dtype=kind)
        out[r : r + rows, c : c + across] = block[: height - r, : width - c]
    return out


_DECODED = pa.schema([("path", pa.string()), ("shape", pa.list_(pa.int32())), ("pixels", pa.list_(pa.float64()))])


def _pixels(files: DataFrame, wanted: list[int] | None, single: bool) -> DataFrame:
    """(path, shape, pixels) of rows (path, content); ``single`` rounds values to 32-bit floats."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path"), batch.column("content")):
                x = decode(data.as_py(), wanted)
                x = (x.astype(np.float32) if single else x).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([x.shape], pa.list_(pa.int32())), pa.array([x.ravel()], pa.list_(pa.float64()))], schema=_DECODED)

    files.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    return files.select("path", "content").mapInArrow(read, "path string, shape array<int>, pixels array<double>")


def files(spark: SparkSession, paths: list[str], pattern: str, recursive: bool = False) -> DataFrame:
    """File rows; ``content`` is read only where it is selected."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(paths)


def channel_files(spark: SparkSession, paths: list[str], channels: list[str], regex: str) -> DataFrame:
    """Image rows of files that hold a channel each; ``regex`` names the groups id and channel.

    Only files of the listed channels are opened. An id without all channels is left out; a channel
    given twice takes its least path, and other groups the least value. ``path`` is the first channel's.
    """
    names = [str(c) for c in channels]
    found = path_columns(files(spark, paths, "*.tif*").select("path"), regex).where(F.col("channel").isin(names))
    others = [c for c in found.columns if c not in ("id", "channel", "path")]
    chosen = found.groupBy("id", "channel").agg(F.min("path").alias("path"), *(F.min(c).alias(c) for c in others))
    content = path_columns(files(spark, paths, "*.tif*").select("path", "content"), regex).where(F.col("channel").isin(names))
    decoded = _pixels(content, None, single=True)
    each = chosen.join(decoded, "path")
    one = [F.max(F.when(F.col("channel") == c, F.struct("path", "shape", "pixels"))).alias(f"_{k}") for k, c in enumerate(names)]
    out = each.groupBy("id").agg(*(F.min(c).alias(c) for c in others), *one).where(" AND ".join(f"_{k} IS NOT NULL" for k in range(len(names))))
    shape = F.array(F.lit(len(names)), F.element_at("_0.shape", -2), F.element_at("_0.shape", -1))
    return out.select(F.col("id").alias("event"), F.col("_0.path").alias("path"), *others, shape.alias("shape"), F.concat(*(F.col(f"_{k}.pixels") for k in range(len(names)))).alias("pixels"))


def frame_files(spark: SparkSession, paths: list[str], channels: list[int] | None = None) -> DataFrame:
    """Image rows of files whose frames are channels; ``group`` is the folder."""
    out = _pixels(files(spark, paths, "*.tiff", recursive=True), channels, single=False)
    return out.select(F.col("path").alias("event"), "path", F.regexp_extract("path", "(.*)/[^/]+$", 1).alias("group"), "shape", "pixels")
