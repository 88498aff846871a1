"""Session settings and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime settings every plan in this package relies on. Partition counts and memory stay with
# the cluster: AQE coalesces from whatever spark.sql.shuffle.partitions starts at.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is worse than one more shuffle, so split it even where that adds one.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Where every partition of the smaller side is measured to be below this, hash it instead of
    # sorting both sides: the wide participant rows then need no sort for their joins.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # The JVM never compiles methods above 8000 bytes of bytecode. The wide projections here
    # generate such methods; beyond the limit Spark splits them instead, five times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Settings that count only when the application starts.
LAUNCH_SETTINGS = {
    # Above 2000 shuffle partitions Spark keeps average block sizes, in which a hot key disappears;
    # this keeps the exact size of blocks five times the median, so that skew stays visible.
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_for(
    spark: SparkSession, shuffled_bytes: int, per_partition: int = 192 * 1024 * 1024, most: int = 50_000
) -> int:
    """Set the number of shuffle partitions so that each holds about ``per_partition`` bytes.

    Never below the session's current number; adaptive execution merges what turns out too small.
    Above ``most`` partitions grow instead and spill, because a shuffle tracks tasks times partitions.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(current, min(most, -(-shuffled_bytes // per_partition)))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def bytes_of(spark: SparkSession, *paths: str) -> int:
    """Stored bytes of files or folders; what is not there counts as empty."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        total += files.getContentSummary(place).getLength() if files.exists(place) else 0
    return total


def local_session(app_name: str = "medalstar", cores: str = "*", **overrides: str) -> SparkSession:
    """A session for tests and benches; on a cluster pass your own to ``configure``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**LAUNCH_SETTINGS, **SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local
    folder would be lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="medalstar-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def new_shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``new_shared_folder`` gives out in this thread inside the block are removed at its end.

    Whatever was read from them has to be written elsewhere by then.
    """
    made: list[str] = []
    before = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(before)
        for path in made:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package made, wherever Spark can reach it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
