"""Command line: ``python -m lumenframe OUTPUT CONFIG [PATHS ...]``."""

from __future__ import annotations

import argparse
import os
import sys
import time

from pyspark.sql import SparkSession

from . import __version__
from .plans.pipeline import arguments, build, load_config, validate
from .session import MODES, session, settings, until
from .sinks import tables
from .sources.load import load


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lumenframe", description="Images to a table of features.")
    p.add_argument("output")
    p.add_argument("config")
    p.add_argument("paths", nargs="*")
    p.add_argument("--mode", choices=MODES, default="local")
    p.add_argument("--master", help="address of the cluster, in mode external")
    p.add_argument("--n-workers", type=int, help="threads of mode local")
    p.add_argument("--n-partitions", type=int, help="shuffle partitions")
    p.add_argument("--memory", type=int, default=4, help="GiB")
    p.add_argument("--local-directory")
    p.add_argument("--n-nodes", type=int, help="executors of mode external")
    p.add_argument("--n-cores", type=int, help="cores of an executor of mode external")
    p.add_argument("--n-threads", type=int, help="cores of a task")
    p.add_argument("--gpu", type=int, default=0, help="GPUs of an executor; the neural segmentation uses them")
    p.add_argument("--walltime", help="HH:MM:SS after which no further job starts and running ones are stopped")
    p.add_argument("--job-extra", action="append", default=[], metavar="KEY=VALUE", help="a Spark setting; may be repeated")
    p.add_argument("--port", type=int, help="of the Spark UI")
    p.add_argument("--event-log", help="folder for Spark's event log, from which the history server shows the profile")
    p.add_argument("--limit", type=int)
    p.add_argument("--with-replacement", action="store_true")
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--headless", action="store_true", help="replace the tables of an earlier run without asking")
    p.add_argument("--timing", help="file for the arguments and the seconds taken")
    p.add_argument("--debug", action="store_true")
    p.add_argument("--version", action="version", version=__version__)
    return p


def run(spark: SparkSession, output: str, config: dict, paths: list[str], limit: int | None = None, with_replacement: bool = False, seed: int = 0, gpu: bool = False) -> float:
    """Load, compute and write; the seconds taken."""
    began = time.monotonic()
    steps = validate(config)
    images = load(spark, config["load"], paths)
    meta = [c for c in images.columns if c not in ("shape", "pixels")]
    if gpu and (config.get("segment") or {}).get("method") == "cellpose":
        s = config["segment"]
        config = config | {"segment": {k: v for k, v in s.items() if k != "kwargs"} | {"settings": arguments(s, "segment") | {"gpu": True}}}
    result = build(config, images, meta, limit, with_replacement, output, seed, persist=True)
    export = steps["export"] or {}
    kind = export.get("format", "parquet")
    if kind not in tables.SINKS:
        raise ValueError(f"unknown export format {kind!r}; one of {sorted(tables.SINKS)}")
    tables.SINKS[kind](result.features, output, export.get("filename", "features"))
    for prefix, extremes in result.boundaries.items():
        tables.boundaries(extremes, output, prefix)
    result.release()
    return time.monotonic() - began


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if not a.paths:
        return 0
    remote = [p for p in (*a.paths, a.output) if "://" not in p and not os.path.isabs(p)]
    if a.mode in ("external", "jobqueue", "mpi") and remote:
        raise SystemExit(f"mode external needs absolute paths or addresses, not {remote[0]}")
    if not a.headless and os.path.isdir(a.output) and os.listdir(a.output):
        if input(f"{a.output} isn't empty; replace its tables? [y/N] ").strip().lower() != "y":
            return 1
    log = tables.log_to(a.output, a.debug)
    more = settings(a.n_nodes, a.n_cores, a.n_threads, a.gpu, a.port, a.event_log, a.job_extra)
    spark = session(a.mode, a.n_workers, a.memory, a.master, a.local_directory, a.n_partitions, more)
    log.info("lumenframe %s on %s: %s", __version__, spark.sparkContext.master, vars(a))
    with until(spark, a.walltime):
        seconds = run(spark, a.output, load_config(a.config), a.paths, a.limit, a.with_replacement, a.seed, bool(a.gpu))
    log.info("took %.3f seconds", seconds)
    if a.timing:
        tables.timing(a.timing, vars(a), seconds)
    return 0


if __name__ == "__main__":
    sys.exit(main())
