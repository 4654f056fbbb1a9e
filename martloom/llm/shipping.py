"""Makes this package known to the Python workers of a session."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's modules to the workers once a session, as ``--py-files`` does; they may lack it otherwise."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _sent.add(context.applicationId)


_kept: list = []


def kept(most: int):
    """A cache of a function's last results in a worker, until work that has no use for them runs there."""
    def register(function):
        cached = functools.lru_cache(maxsize=most)(function)
        _kept.append(cached)
        return cached

    return register


def shed() -> None:
    """Gives back the memory of what earlier work has ``kept`` in this worker; Spark hands workers on from job to job."""
    held = [f for f in _kept if f.cache_info().currsize]
    for f in held:
        f.cache_clear()
    if held:
        gc.collect()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)


def in_arrow(df: DataFrame, work, schema, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with this package at hand. Work that uses ``kept`` results keeps them for tasks to come."""
    ship(df.sparkSession)

    def run(batches):
        if not keeps:
            shed()
        return work(batches)

    return df.mapInArrow(run, schema)
