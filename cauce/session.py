"""Session construction and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins from measured shuffle sizes and
# splits skewed partitions; session time zone is pinned so timestamp rendering is stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of post-shuffle partitions after AQE coalescing (splits skewed ones too)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "cauce",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide. Shuffle partitions default
    to Spark's own value; size them to the data (AQE coalesces small ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests) a folder is
    created and registered. Anywhere else the setting must point at shared storage (HDFS,
    S3, ...), and leaving it unset is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    root = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cauce-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root for intermediate tables."""
    root = checkpoint_root(spark)
    if root.startswith("file:"):
        local = root[len("file:"):]
        os.makedirs(local, exist_ok=True)
    return f"{root}/cauce-{name}-{uuid.uuid4().hex[:12]}"


# DataFrames the library persisted for reuse inside one job (measured join sides, sorted
# rows, value counts), per thread, so concurrent jobs release only their own. Job wrappers
# release them once their output is written.
_LOCAL = threading.local()


def _persisted() -> list:
    if not hasattr(_LOCAL, "items"):
        _LOCAL.items = []
    return _LOCAL.items


def persist_for_job(df):
    """Persist (memory, spilling to disk; recomputed from lineage if an executor is lost)
    and remember the DataFrame for ``release_persisted``."""
    from pyspark import StorageLevel

    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    _persisted().append(out)
    return out


def release_persisted() -> int:
    """Unpersist everything this thread's ``persist_for_job`` kept; returns the count."""
    items = _persisted()
    n = len(items)
    while items:
        items.pop().unpersist(blocking=False)
    return n
