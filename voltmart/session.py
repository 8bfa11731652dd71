"""Session construction and lineage cutting.

On a cluster the session already exists and names a shared checkpoint folder in
``spark.checkpoint.dir``; we only read it. Tests and the local bench build their
own session and, only when the setting is absent, point it at a fresh scratch
folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Fixed session settings every model relies on (H3 ANSI, H9 time zone).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "voltmart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; cluster jobs use their own session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Runtime-settable parts of BASE_CONF (for sessions built elsewhere)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, BASE_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, honouring ``spark.checkpoint.dir``.

    Only when the cluster names none (local tests) is a private scratch folder
    created; a machine-local folder is never chosen when the setting exists.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="voltmart-ckpt-", dir=os.environ.get("VOLTMART_SCRATCH", "/tmp"))
    sc.setCheckpointDir(scratch)
    return scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate files."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
