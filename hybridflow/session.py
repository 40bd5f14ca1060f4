"""Session settings and the shared folder every written table goes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import hybridflow

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{STATE}.providerClass": ROCKSDB,
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def build_session(app: str = "hybridflow", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a ``local`` master may do without the setting: there one machine is the
    whole cluster, so a temporary folder is shared by definition.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    one_machine = spark.sparkContext.master.startswith("local")
    if configured:
        own = tempfile.gettempdir().rstrip("/")
        if not one_machine and configured.rstrip("/") in (own, f"file://{own}", f"file:{own}"):
            raise RuntimeError(f"{configured} is a machine's own temporary folder; executors would not share it")
        return configured.rstrip("/")
    if not one_machine:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="hybridflow-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; two runs never meet in one path."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store. A commit then writes what changed, not all state."""
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)


def prepare(spark: SparkSession) -> None:
    """Settings the queries rely on, for a session someone else built.

    Times without a zone are read as UTC, and functions of this package travel to the
    executors with the job, so it need not be installed there.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    cloudpickle.register_pickle_by_value(hybridflow)
