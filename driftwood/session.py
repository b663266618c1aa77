"""Session construction and shared-storage locations.

The engine pins the session time zone to UTC so that instants, epoch values
and window boundaries are host independent, keeps ANSI mode on (every cast of
input text goes through a ``try_*`` function instead), and turns on adaptive
execution for batch jobs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoints (partial calls, profile aggregate, fitted models) are
    # removed from the shared folder once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Checkpoint files are raw rows unless compressed (spark.io codec).
    "spark.checkpoint.compress": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "driftwood",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session configured for the engine.

    On a cluster ``master`` stays ``None`` so the launcher decides. Local runs
    (tests, bench) pass ``local[N]`` and a matching shuffle partition count.
    """
    builder = SparkSession.builder.appName(app)
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
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    The cluster names it in ``spark.checkpoint.dir``; we only invent one when
    it is unset, which happens in local tests.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - an unreadable conf counts as unset
            root = None
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # One machine: a local folder is shared by all tasks.
        root = tempfile.mkdtemp(prefix="driftwood-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, also
    where the session was started outside the source folder. Once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_driftwood_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # The driver's own file server hands the archive to the executors.
    archive = os.path.join(tempfile.mkdtemp(prefix="driftwood-code-"), "driftwood.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("driftwood", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._driftwood_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "driftwood", f"{name}-{uuid.uuid4().hex[:12]}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, through the session's file
    system; a missing one is fine."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, by the session's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by the session's file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return [f.getPath().getName() for f in found]
