"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans shuffles at runtime (partition
# coalescing, skew-join splitting); the UI is off because no server may run.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parsing is CPU-bound per byte: let AQE keep small post-shuffle
    # partitions (a few MB would otherwise collapse into fewer tasks than
    # cores).  At scale total/parallelism is far above this floor.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "lograft",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master may
    leave it unset (tests): it gets a private folder.  Anywhere else executors
    could not see a folder of the driver's machine, so an unset folder is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (remote session: the server owns the folder)
        return _required(spark.conf.get("spark.checkpoint.dir", None))
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir and is_local(sc.master):
        conf_dir = tempfile.mkdtemp(prefix="lograft-ckpt-")
    _required(conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def is_local(master: str) -> bool:
    """One machine holds the driver and all executors."""
    return master == "local" or master.startswith("local[")


def _required(folder: str | None) -> str:
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def parallelism(spark: SparkSession, default: int = 8) -> int:
    """The cluster's default parallelism (total executor cores)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return default


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def open_folder(path: str):
    """(file system, path in it) of a shared folder, for tasks and the driver alike; needs no JVM."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def remove_folder(path: str) -> None:
    files, inner = open_folder(path)
    files.delete_dir(inner)
