"""Spark sessions by mode."""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: ``jobqueue`` and ``mpi`` are clusters whose nodes a queue or launcher has started: external ones here.
MODES = ("local", "external", "debug", "jobqueue", "mpi")


def settings(nodes: int | None = None, cores: int | None = None, threads: int | None = None, gpu: int = 0, port: int | None = None, event_log: str | None = None, extra: list[str] = ()) -> dict[str, str]:
    """Spark settings for the size of a cluster, its GPUs and what a run reports; ``extra`` is key=value."""
    out = {"spark.executor.instances": nodes, "spark.executor.cores": cores, "spark.task.cpus": threads, "spark.ui.port": port}
    if gpu:
        out |= {"spark.executor.resource.gpu.amount": gpu, "spark.task.resource.gpu.amount": 1}
    if event_log:
        out |= {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log}
    for x in extra:
        key, equals, value = x.partition("=")
        if not equals:
            raise ValueError(f"{x!r} is no key=value")
        out[key] = value
    return {k: str(v) for k, v in out.items() if v is not None}


@contextlib.contextmanager
def until(spark: SparkSession, walltime: str | None) -> Iterator[None]:
    """Cancel all jobs once HH:MM:SS have passed; no limit if it is None."""
    if walltime is None:
        yield
        return
    h, m, s = map(int, walltime.split(":"))
    timer = threading.Timer(h * 3600 + m * 60 + s, spark.sparkContext.cancelAllJobs)
    timer.daemon = True
    timer.start()
    try:
        yield
    finally:
        timer.cancel()


def session(mode: str = "local", workers: int | None = None, memory: int = 4, master: str | None = None, local_directory: str | None = None, partitions: int | None = None, more: dict[str, str] | None = None) -> SparkSession:
    """``more`` are Spark settings. ``local`` takes ``workers`` threads (all cores if None), ``debug`` one; ``external`` a master address.

    ``external`` without an address leaves the master to the submission. ``memory`` is in GiB.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; one of {MODES}")
    builder = SparkSession.builder.appName("lumenframe").config("spark.sql.adaptive.enabled", "true")
    for key, value in (more or {}).items():
        builder = builder.config(key, value)
    if mode in ("external", "jobqueue", "mpi"):
        builder = builder.master(master) if master else builder
        builder = builder.config("spark.executor.memory", f"{memory}g")
    else:
        builder = builder.master("local[1]" if mode == "debug" else f"local[{workers or '*'}]").config("spark.driver.memory", f"{memory}g")
    if local_directory:
        builder = builder.config("spark.local.dir", local_directory)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()
