"""Sinks for the feature table and what belongs to it."""

from __future__ import annotations

import json
import logging
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parquet(df: DataFrame, output: str, filename: str = "features") -> str:
    """The wide table as a folder of parts, as many as the plan has partitions."""
    path = f"{output}/{filename}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def annotated(df: DataFrame, output: str, filename: str = "features") -> str:
    """An annotated matrix in portable form: ``X`` array<float> of the features, ``obs`` of the rest.

    The names along ``X`` go to ``<filename>.var.parquet``, in order.
    """
    features = [c for c in df.columns if c.startswith("feat_")]
    others = [c for c in df.columns if not c.startswith("feat_")]
    path = f"{output}/{filename}.annotated.parquet"
    x = F.array(*(F.col(f"`{c}`").cast("float") for c in features)) if features else F.array().cast("array<float>")
    df.select(x.alias("X"), F.struct(*(F.col(f"`{c}`") for c in others)).alias("obs")).write.mode("overwrite").parquet(path)
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "position int, name string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{output}/{filename}.var.parquet")
    return path


def boundaries(df: DataFrame, output: str, prefix: str = "") -> str:
    """A branch's extremes a group, as CSV in a folder of the branch's own."""
    path = f"{output}/channel_boundaries{'_' if prefix else ''}{prefix}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def label_masks(df: DataFrame, output: str, keys: list[str]) -> str:
    """The label masks of whole frames, partitioned by their group keys."""
    if not keys:
        raise ValueError("exporting label masks needs a group key")
    path = f"{output}/masks"
    df.select(*(c for c in ("event",) if c in df.columns), *keys, "shape", "label_mask").write.mode("overwrite").partitionBy(*keys).parquet(path)
    return path


SINKS = {"parquet": parquet, "anndata": annotated}


def timing(path: str, arguments: dict, seconds: float) -> None:
    with open(path, "w") as f:
        json.dump({**arguments, "runtime": seconds}, f)


def log_to(output: str, debug: bool = False) -> logging.Logger:
    """Everything to ``run.log`` in a local output folder, warnings (all if ``debug``) to the console."""
    log = logging.getLogger("lumenframe")
    log.setLevel(logging.DEBUG)
    for old in list(log.handlers):
        log.removeHandler(old)
        old.close()
    console = logging.StreamHandler()
    console.setLevel(logging.DEBUG if debug else logging.WARNING)
    log.addHandler(console)
    if "://" not in output:
        os.makedirs(output, exist_ok=True)
        log.addHandler(logging.FileHandler(os.path.join(output, "run.log")))
    return log
