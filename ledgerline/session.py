"""Session helpers: local sessions for tests and bench, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "ledgerline") -> SparkSession:
    """A local session for tests and bench. Clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder, because there every task runs on this machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="ledgerline-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_out(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Better than ``cut_lineage`` for large frames that several plans read in part, because
    each of them then scans only its own columns.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    scratch = _scratch.get()
    if scratch is not None:
        scratch.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# The scratch folders of the innermost ``own_scratch``. Every thread has its own.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what ``write_out`` writes inside, at the end. For jobs that return no frame.

    Only writes of the same thread count, so an operator that runs beside a job keeps its own.
    """
    folders: list[str] = []
    token = _scratch.set(folders)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in folders:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
