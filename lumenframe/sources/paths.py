"""Columns from paths: named groups of a regular expression, pivoted channels."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def groups_of(regex: str) -> dict[str, int]:
    return dict(re.compile(regex).groupindex)


def path_columns(df: DataFrame, regex: str | None, column: str = "path") -> DataFrame:
    """Add a string column for each named group; rows that don't match are dropped.

    Named groups become plain ones, as their names needn't be valid in Java.
    """
    if not regex:
        return df
    java = re.sub(r"\(\?P<[^>]+>", "(", regex)
    out = df.where(F.col(column).rlike(java))
    return out.withColumns({name: F.regexp_extract(column, java, i) for name, i in groups_of(regex).items()})


def pivot_channels(paths: DataFrame, channels: list[str], key: str = "id", channel: str = "channel", path: str = "path") -> DataFrame:
    """One row a key with a path column for each channel; keys without all channels are dropped.

    Other groups take the least value of the key; a channel given twice takes its least path.
    """
    others = [c for c in paths.columns if c not in (key, channel, path)]
    one = [F.min(F.when(F.col(channel) == c, F.col(path))).alias(c) for c in channels]
    return paths.groupBy(key).agg(*(F.min(c).alias(c) for c in others), *one).na.drop(subset=channels)
