"""CZI events: scenes and tiles of files. The pixels need a decoder, which isn't part of this library."""

from __future__ import annotations

import importlib.util

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import path_columns

GROUP_KEYS = ("scene", "tile")


def events(scenes: DataFrame, wanted: None | str | list[str] = None, regex: str | None = None) -> DataFrame:
    """A row for each scene and tile of ``scenes`` (path, scenes array, tiles int).

    ``wanted`` is None for all scenes, a regular expression matched from the start, or a list of names.
    Groups of ``regex`` are taken from the scene's name.
    """
    out = scenes.select("path", F.explode("scenes").alias("scene"), "tiles")
    if isinstance(wanted, str):
        out = out.where(F.col("scene").rlike(f"^(?:{wanted})"))
    elif isinstance(wanted, list):
        out = out.where(F.col("scene").isin(wanted))
    elif wanted is not None:
        raise ValueError("scenes must be None, a regular expression or a list of names")
    out = out.where("tiles > 0").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")
    return path_columns(out, regex, "scene")


def read(spark: SparkSession, paths: list[str], **_) -> DataFrame:
    if importlib.util.find_spec("aicspylibczi") is None:
        raise NotImplementedError("CZI files need the aicspylibczi library, which isn't installed")
    raise NotImplementedError("CZI pixels can't be read yet; events() lists scenes and tiles")
