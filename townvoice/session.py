"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from itertools import count

from pyspark.sql import DataFrame, SparkSession

# Correct results never depend on these; they are what the operators are tuned for.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_root: dict[str, str] = {}
_scratch: ContextVar[tuple[str, Iterator[int]] | None] = ContextVar("scratch", default=None)


def session(app: str = "townvoice", cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benches; on a cluster pass your own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``, or our own in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_root:
        warnings.warn("spark.checkpoint.dir is unset: intermediate tables go to a local temporary folder", stacklevel=3)
        _local_root[context.applicationId] = tempfile.mkdtemp(prefix="townvoice-")
        context.setCheckpointDir(os.path.join(_local_root[context.applicationId], "rdd"))
    return _local_root[context.applicationId]


def shared_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(root: str) -> Iterator[None]:
    """Inside, :func:`materialize` writes below ``root`` and overwrites what an earlier block left.

    For jobs that come again and again: their intermediate tables do not pile up. Tables made
    inside must not be read after the block. An inner block goes on in the folder of the outer.
    """
    token = None if _scratch.get() else _scratch.set((root, count()))
    try:
        yield
    finally:
        if token:
            _scratch.reset(token)


def materialize(df: DataFrame, label: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage.

    Later stages then see one fixed copy, also when executors are lost. With ``row_group`` bytes
    to a row group, a file that holds most of the rows is read by several tasks.
    """
    inside = _scratch.get()
    path = f"{inside[0]}/{next(inside[1])}-{label}" if inside else shared_path(df.sparkSession, label)
    options = {} if row_group is None else {"parquet.block.size": str(row_group)}
    df.write.mode("overwrite" if inside else "errorifexists").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
