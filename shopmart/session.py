"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from shopmart.sources.files import Folder

#: What a task reads, of files and of shuffles. Both are compressed, and keys in a row
#: compress well: in memory the rows of a shuffle take twenty times as much.
PARTITION_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}
#: Input bytes for each partition of a shuffle before AQE joins small ones.
BYTES_PER_PARTITION = 4_000_000

SESSION_CONF = {
    **PARTITION_CONF,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One hot key may hold a third of a table: let AQE split it even where the
    # split costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "shopmart",
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build a session with the settings the models rely on.

    ``shuffle_partitions`` is the upper bound AQE coalesces from; on a cluster
    size it to (largest shuffle / 128 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of partitions grow with the input, so that a task's memory does not.

    Settings made by the user stay as they are, but for a number of partitions that is too low.
    """
    for key, value in PARTITION_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions")
    wanted = input_bytes // BYTES_PER_PARTITION
    if wanted > int(now):
        spark.conf.set(initial, str(wanted))


_local_dirs: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    a machine-local path is invisible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="shopmart-checkpoint-")
    return _local_dirs[app]


#: Folders written since each scratch began, the innermost last; a scratch of each thread's own.
_scratches: ContextVar[tuple[list[str], ...]] = ContextVar("scratches", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`materialize` writes in between.

    For runs whose results are stored elsewhere: a DataFrame that still reads
    what was written must not be used afterwards.
    """
    written: list[str] = []
    token = _scratches.set((*_scratches.get(), written))
    try:
        yield
    finally:
        _scratches.reset(token)
        for path in written:
            Folder(spark, path).remove()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """The address of a new folder below the shared one."""
    path = f"{checkpoint_dir(spark)}/shopmart/{label}-{uuid.uuid4().hex}"
    for written in _scratches.get()[-1:]:
        written.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike caching this survives the loss of executors, computes ``df`` once,
    and lets later readers prune columns.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
