"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

# Settings every job here relies on. Joins carry no broadcast hints: a side is broadcast
# only when its measured size is below spark.sql.autoBroadcastJoinThreshold, otherwise
# AQE runs a sort-merge join and splits partitions that a hot key has blown up.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Of a key that a JSON object repeats, the last entry counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Sessions of one visitor are merged inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting state rows costs a lookup per write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def get_session(app_name: str = "clickwell", time_zone: str = "UTC", **conf: str) -> SparkSession:
    """Build (or reuse) a session. On a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**ENGINE_CONF, "spark.sql.session.timeZone": time_zone, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the engine settings to a session somebody else made. Its time zone is kept: it
    decides where a day begins."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


# Shuffles begin with that many partitions where adaptive execution joins small ones again, so that a
# task's share stays near spark.sql.adaptive.advisoryPartitionSizeInBytes however large the input is.
FIRST_PARTITIONS = 1_000


def finely_cut(spark: SparkSession) -> SparkSession:
    """A session of its own with the caller's settings, whose shuffles are cut finely at first."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(FIRST_PARTITIONS))
    return own


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is configured it is one of our own below the
    warehouse, which all executors reach as well; on a local disk it goes with the process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    application = spark.sparkContext.applicationId
    if application not in _own_dirs:
        own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work-{uuid.uuid4().hex[:12]}"
        place = urlparse(own)
        if place.scheme in ("", "file"):
            atexit.register(shutil.rmtree, place.path, ignore_errors=True)
        _own_dirs[application] = own
    return _own_dirs[application]


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_dir(spark)}/clickwell/{name}-{uuid.uuid4().hex[:12]}"


def files_at(spark: SparkSession, path: str):
    """The file system of a path in shared storage, and the path as it wants it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def drop_folder(spark: SparkSession, path: str) -> None:
    files, folder = files_at(spark, path)
    files.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, folder = files_at(spark, path)
    return files.exists(folder)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished folder its name. One step on file systems; `target` must not exist."""
    files, folder = files_at(spark, source)
    place = files_at(spark, target)[1]
    files.mkdirs(place.getParent())
    if not files.rename(folder, place):
        raise OSError(f"cannot move {source} to {target}")


def touch(spark: SparkSession, path: str) -> None:
    files, place = files_at(spark, path)
    files.create(place, True).close()
