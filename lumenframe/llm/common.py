"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word: a run of code points other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Largest table, in rows and in bytes, that an operator broadcasts.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode."""
    if root := spark.conf.get("spark.checkpoint.dir", None):
        return root
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lumenframe-"))
    return sc.getCheckpointDir()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/lumenframe/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_limits(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(24 << 20))


def sized(small: DataFrame, *wide: str) -> DataFrame | None:
    """``small`` marked for broadcast if its measured size is within the bounds, else None.

    ``small`` must be cheap to read again (staged); ``wide`` are its string or binary columns.
    """
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(64))
    n, b = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(small) if n <= BROADCAST_ROWS and b <= BROADCAST_BYTES else None


def carry(df: DataFrame, *needed: str) -> DataFrame:
    """A struct ``_row`` of all columns and copies of the ``needed`` ones, so that no other name can clash."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), *needed)


def carry_rest(df: DataFrame, changed: str) -> DataFrame:
    """A struct ``_row`` of all columns but ``changed``, and that one: no name can clash, nothing goes twice."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns if c != changed)).alias("_row"), changed)


def carried(names: list[str], **changed) -> list[F.Column]:
    """The columns ``names`` of what ``carry_rest`` has packed, those ``changed`` as given."""
    return [changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`") for c in names]


def unit_hash(seed: str, *cols) -> F.Column:
    """A number in [0, 1) from 52 bits of MD5 over the seed and the columns (null: empty)."""
    text = F.concat_ws(":", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def widened(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` and then the columns of the DDL string ``more``."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])
