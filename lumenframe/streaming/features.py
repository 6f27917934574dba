"""Features of image rows as their files arrive.

Steps that read one event at a time run as they do in batch. Correction images and extremes come from
an earlier batch, so that the stream keeps no state for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.features import features
from ..operators import filters, illumination, masking


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int = 100) -> DataFrame:
    """A stream of image rows from Parquet files that appear in ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def masked_features(images: DataFrame, names: list[str], types: list[str], method: str = "circle", meta: list[str] = ("event",), mask_filters: list[dict] | None = None, corrections: DataFrame | None = None, key: str = "group", **settings) -> DataFrame:
    """Correction by precomputed images, mask filters, one mask and its features, without state."""
    d = images if corrections is None else illumination.divide(images, F.broadcast(corrections) if _small(corrections) else corrections, key)
    d = filters.mask_filters(d, mask_filters, 0, len(names))
    d = masking.apply(masking.make(d, method, **settings), len(names))
    return features(d, names, types, list(meta))


def _small(corrections: DataFrame, most: int = 64 << 20) -> bool:
    """Whether all correction images together hold at most ``most`` bytes."""
    size = corrections.agg(F.sum(F.size("avg") * F.lit(8).cast("long"))).first()[0]
    return (size or 0) <= most


def write(stream: DataFrame, output: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append to a folder of Parquet; each event is written exactly once. ``once`` ends with what is there."""
    out = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start(output)
