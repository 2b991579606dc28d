"""Session helpers: a configured local session and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

from cdcflow.operators.protect import REDACTED_CALLS, REDACTION_CONF

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "cdcflow") -> SparkSession:
    """Session used by tests and the bench: AQE on, UTC, no UI."""
    b = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config(REDACTION_CONF, REDACTED_CALLS)
        .config("spark.driver.memory", os.environ.get("CDCFLOW_DRIVER_MEMORY", "8g"))
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder.

    Uses the folder already set on the context, else the session conf
    ``spark.checkpoint.dir`` (a shared folder on a cluster).  Only a local-mode
    session with neither gets a scratch folder of its own (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")
        conf = tempfile.mkdtemp(prefix="cdcflow-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf
