"""Spark session helpers.

The library never creates a session implicitly; jobs receive one.  These
helpers exist for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins and coalesces partitions at
# runtime, skew-join splits hot join partitions, and a fixed UTC session zone
# keeps date arithmetic identical on every executor.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str = "local[8]",
    app_name: str = "opsanalytics",
    shuffle_partitions: int | None = None,
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master, whose executors share the driver's disk, may leave it
    unset (tests, bench): one folder per session is then made and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        _register_checkpoint_dir(spark, configured)
        return configured
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="opsanalytics-ckpt-"))
    return str(sc.getCheckpointDir())


def _register_checkpoint_dir(spark: SparkSession, path: str) -> None:
    """Point the context's reliable-checkpoint folder at ``path`` (classic sessions;
    a Connect session has no context and reads ``spark.checkpoint.dir`` itself)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        return
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)
