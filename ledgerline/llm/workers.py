"""Python workers that can import this library."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

import ledgerline

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(ledgerline.__file__)))
PART_BYTES = 1 << 20


def ready(df: DataFrame) -> DataFrame:
    """``df``, once workers started from now on look for the library where this process has it
    (on a cluster it is installed there, or shipped with ``--py-files``)."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return df


def parts(batch: pa.RecordBatch, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``limit`` bytes on average. What returns whole rows
    returns it by such parts, so texts are held once and not again as Python's strings, as a new
    column and as a batch on its way back."""
    rows = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def release() -> None:
    """Give back what a task no longer needs: its worker lives on, beside those of later stages."""
    pa.default_memory_pool().release_unused()
