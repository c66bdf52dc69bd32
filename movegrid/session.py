"""Session helpers: a local builder for tests/bench and checkpoint-dir handling."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query in this package assumes (all are safe on a cluster).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "movegrid") -> SparkSession:
    """Build (or reuse) a local session for tests and the benchmark."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("MOVEGRID_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint directory of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Where nothing is configured a local session (tests, bench) gets a scratch folder; a cluster
    raises, as no folder of one machine would do there.  Under Spark Connect there is no
    driver-side context; the server's own setting applies.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="movegrid-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the checkpoint directory, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/movegrid-{label}-{uuid.uuid4().hex}"
