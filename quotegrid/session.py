"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: str = "8", app: str = "quotegrid", partitions: int = 8, **conf: str
) -> SparkSession:
    """A session for tests and single-node benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("QUOTEGRID_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder of the cluster.

    The shared folder is ``spark.checkpoint.dir``; where it is unset, a folder below the
    warehouse. On a cluster a warehouse on the driver's own disk is an error, as other
    machines would not see it.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        home = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        master = spark.conf.get("spark.master", None) or "local"
        own_disk = home.startswith(("/", "file:"))
        if own_disk and not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        shared = f"{home}/_quotegrid"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
