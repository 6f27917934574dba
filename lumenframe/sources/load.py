"""Image rows by the ``load`` step of a configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import czi, tiff, zarr

FORMATS = ("zarr", "tiff", "multiframe_tiff", "czi", "parquet")


def load(spark: SparkSession, step: dict, paths: list[str]) -> DataFrame:
    """The images under ``paths``; parquet holds image rows already."""
    kind, kwargs = step.get("format"), step.get("kwargs") or {}
    channels = step.get("channels")
    if kind == "zarr":
        return zarr.read(spark, paths, channels, **kwargs)
    if kind == "tiff":
        return tiff.channel_files(spark, paths, channels, **kwargs)
    if kind == "multiframe_tiff":
        return tiff.frame_files(spark, paths, channels)
    if kind == "czi":
        return czi.read(spark, paths, **kwargs)
    if kind == "parquet":
        return spark.read.parquet(*paths)
    raise ValueError(f"unknown format {kind!r}; one of {FORMATS}")
