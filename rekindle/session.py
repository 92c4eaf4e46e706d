"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        # Skips the call-site capture that slows every column function down.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-warehouse-"),
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("rekindle")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a driver that is its
    own executor gets a temporary folder; executors elsewhere could not see one, so any other
    master is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(
            "executors share no folder that is named: set spark.checkpoint.dir to a path on a "
            "file system that all of them reach"
        )
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-scratch-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no other run uses."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
