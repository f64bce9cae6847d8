"""Session settings shared by tests, the bench and the queries."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the queries expect (UTC, AQE, Arrow)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioforge")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Only where the session names none (tests, a laptop) and runs in one process is a local
    folder made; on a cluster without the setting this fails, because a machine-local
    folder cannot outlive its executor.
    """
    sc = spark.sparkContext
    set_dir = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not set_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        set_dir = tempfile.mkdtemp(prefix="folioforge-checkpoint-")
    sc.setCheckpointDir(set_dir)
    return set_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage with a reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
