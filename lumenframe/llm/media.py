"""Media columns: Netpbm and BMP codecs, area resizing by integral images, NPY tiles, difference hashes.

Edge cases: a null text is empty and padded to 64 zero bytes; equal payloads give equal values; any length
is taken whole, with row blocks bounding the resizer's working memory; a null image has null results; one
that can't be read, or has no pixels, has null results and a reason in ``_error``; samples are scaled by the
largest value that their format allows, so white is 255 in every tile; input columns named as added ones
give way to them; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, table, widened

WIDTH, TILE = 64, 32


def encode_pgm(image: np.ndarray) -> bytes:
    """Binary PGM of a (rows, columns) array of bytes, or PPM of (rows, columns, 3)."""
    kind = b"P6" if image.ndim == 3 else b"P5"
    return b"%s\n%d %d\n255\n" % (kind, image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


_FIELD = re.compile(rb"(?:\s|#[^\n]*\n)*(\d+)")


def decode_netpbm(data: bytes) -> tuple[np.ndarray, int]:
    """P1 to P6, plain and binary, of up to 16 bits a sample; and the largest value a sample may have."""
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    at, fields = 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        if not (m := _FIELD.match(data, at)):
            raise ValueError("a Netpbm header breaks off")
        fields.append(int(m[1]))
        at = m.end()
    width, height, top = *fields[:2], (fields + [1])[2]
    if not 0 < top < 65536:
        raise ValueError(f"a Netpbm image of samples up to {top}")
    shape = (height, width, 3) if kind in (b"P3", b"P6") else (height, width)
    n = int(np.prod(shape))
    if kind in (b"P2", b"P3"):
        return np.array(re.sub(rb"#[^\n]*", b"", data[at:]).split()[:n], np.uint16 if top > 255 else np.uint8).reshape(shape), top
    if kind == b"P1":
        bits = np.frombuffer(re.sub(rb"#[^\n]*|\s", b"", data[at:])[:n], np.uint8).reshape(shape) - 48
        if (bits > 1).any():
            raise ValueError("a bitmap of other digits than 0 and 1")
        return 1 - bits, 1
    at += 1
    if kind == b"P4":
        rows = np.frombuffer(data, np.uint8, (width + 7) // 8 * height, at).reshape(height, -1)
        return 1 - np.unpackbits(rows, axis=1)[:, :width], 1
    return np.frombuffer(data, ">u2" if top > 255 else np.uint8, n, at).reshape(shape), top


def encode_bmp(image: np.ndarray) -> bytes:
    """8-bit greyscale BMP, bottom-up, rows padded to 4 bytes."""
    h, w = image.shape
    stride = (w + 3) // 4 * 4
    body = np.zeros((h, stride), np.uint8)
    body[:, :w] = image[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4).copy()
    palette[:, 3] = 0
    start = 14 + 40 + 1024
    head = struct.pack("<2sIHHI", b"BM", start + body.size, 0, 0, start)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8, 0, body.size, 2835, 2835, 256, 0) + palette.tobytes() + body.tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits, bottom-up or top-down; grey if its palette is."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP image")
    start, size = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
    w, h, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
    if packing or bits not in (1, 4, 8, 24, 32):
        raise ValueError(f"a BMP of {bits} bits, compression {packing}, isn't supported")
    stride = (w * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)
    rows = rows[::-1] if h > 0 else rows
    if bits >= 24:
        return rows[:, : w * bits // 8].reshape(abs(h), w, bits // 8)[:, :, 2::-1]
    index = rows if bits == 8 else np.unpackbits(rows, axis=1) if bits == 1 else np.stack([rows >> 4, rows & 15], 2).reshape(abs(h), -1)
    n = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    palette = np.frombuffer(data, np.uint8, 4 * n, 14 + size).reshape(n, 4)[:, 2::-1]
    pixels = palette[index[:, :w]]
    return pixels[:, :, 0] if (palette == palette[:, :1]).all() else pixels


def decode_scaled(data: bytes) -> tuple[np.ndarray, int]:
    """The samples, and the largest value that one may have; what can't be read raises ValueError."""
    try:
        image, top = (decode_bmp(data), 255) if data[:2] == b"BM" else decode_netpbm(data)
    except (IndexError, struct.error, OverflowError, ZeroDivisionError) as e:
        raise ValueError(f"not a whole image: {e}") from e
    if not image.size:
        raise ValueError("an image without pixels")
    return image, top


def decode(data: bytes) -> np.ndarray:
    return decode_scaled(data)[0]


def _at(integral: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Values of an integral along axis 0 at fractional places."""
    whole = np.minimum(edges.astype(int), len(integral) - 1)
    part = (edges - whole).reshape(-1, *[1] * (integral.ndim - 1))
    return integral[whole] + part * (integral[np.minimum(whole + 1, len(integral) - 1)] - integral[whole])


def area_resize(image: np.ndarray, rows: int, columns: int, block: int = 16384) -> np.ndarray:
    """Exact area means, by an integral image over columns and then one over rows.

    The first runs over blocks of rows, which leaves ``columns`` sums a row.
    """
    h, w = image.shape
    edges = np.arange(columns + 1) * (w / columns)
    sums = np.empty((h + 1, columns))
    sums[0] = 0
    for a in range(0, h, block):
        part = np.zeros((w + 1, min(block, h - a)))
        np.cumsum(image[a : a + block].T, axis=0, out=part[1:], dtype=float)
        sums[a + 1 : a + 1 + part.shape[1]] = np.diff(_at(part, edges), axis=0).T
    np.cumsum(sums, axis=0, out=sums)
    return np.diff(_at(sums, np.arange(rows + 1) * (h / rows)), axis=0) / (h / rows * w / columns)


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each of 8 x 9 area means is below its right neighbour, as 16 hex digits."""
    small = np.round(area_resize(image, 8, 9), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy(image: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(image), allow_pickle=False)
    return out.getvalue()


def tile(image: np.ndarray, top: int = 255, side: int = TILE) -> bytes:
    """The image, of samples up to ``top``, as a square NPY tile of bytes."""
    grey = image if image.ndim == 2 else image.astype(float).mean(axis=2)
    small = area_resize(grey, side, side) * (255 / top) if top != 255 else area_resize(grey, side, side)
    return npy(np.clip(np.round(small, 6) + 0.5, 0, 255).astype(np.uint8))


def pad(payload: bytes) -> bytes:
    return payload + bytes((-len(payload)) % WIDTH if payload else WIDTH)


def store(payload: bytes, container: str = "pgm") -> bytes:
    """A payload of a positive multiple of 64 bytes as a greyscale image 64 wide, losslessly."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    return encode_bmp(image) if container == "bmp" else encode_pgm(image)


def media_columns(df: DataFrame, column: str = "media") -> DataFrame:
    """Add ``_pixels`` (the decoded samples), ``_tile`` (NPY), ``_hash`` and ``_error`` to frames with encoded images."""
    arrow_limits(df.sparkSession)
    df = df.drop("_pixels", "_tile", "_hash", "_error")
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x in batch.column(at).to_pylist():
                if x is None:
                    found.append((None, None, None, None))
                    continue
                try:
                    image, top = decode_scaled(x)
                except ValueError as e:
                    found.append((None, None, None, str(e)))
                    continue
                grey = image if image.ndim == 2 else image.astype(float).mean(axis=2)
                found.append((np.ascontiguousarray(image).tobytes(), tile(image, top), difference_hash(grey), None))
            added = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.binary(), pa.binary(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "_pixels", "_tile", "_hash", "_error"])

    return df.mapInArrow(run, widened(df, "_pixels binary, _tile binary, _hash string, _error string"))


def stored(docs: DataFrame, container: str = "pgm") -> DataFrame:
    """(doc_id, n_bytes, media): every whole text as an image."""
    arrow_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(r) for r in raw], pa.int64()), pa.array([store(pad(r), container) for r in raw], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media_columns(stored(table(spark, sf_dir, "documents").select("doc_id", "text")))
    tail = F.expr(f"substring(_pixels, -{WIDTH}, {WIDTH})")
    return out.select("doc_id", "n_bytes", F.octet_length("_pixels").cast("long").alias("payload_bytes"), F.sha2("_pixels", 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), F.col("_hash").alias("feature"), F.octet_length("_tile").cast("long").alias("tile_bytes"), F.sha2("_tile", 256).alias("tile_sha256"))
