"""Session settings and the shared folder that durable intermediate data lives in."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every model relies on. They are applied only where the session does
# not set them already, so a cluster's own tuning wins.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Initial shuffle partitions so each holds about ``target_bytes`` of input.

    AQE coalesces small partitions after each map stage, so starting high is
    cheap; starting low forces every reducer to hold (and spill) too much.
    100 TB at 256 MB gives about 400,000.
    """
    return max(1, -(-int(input_bytes) // int(target_bytes)))


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Pin the settings the models depend on (UTC, ANSI, AQE) when unset.

    The time zone is always forced to UTC (day boundaries of every model are
    UTC days, as in the reference's only write path) and so is ANSI mode (a
    value that does not cast is an error, never NULL). With ``input_bytes``, the
    initial shuffle partition count is sized from it unless the cluster sets one.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if input_bytes is not None and spark.conf.get(initial, None) in (None, "<undefined>"):
        spark.conf.set(initial, str(shuffle_partitions_for(input_bytes)))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakeops") -> SparkSession:
    """A local session for tests and benches. On a cluster, build your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAKEOPS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is read from the session. Only in local mode, where
    nothing is set, a fresh folder is created and registered; a cluster without
    the setting is an error, as its machines share no temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return (sc.getCheckpointDir() or configured).rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lakeops-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path inside the shared folder; ``unique`` adds a fresh run folder."""
    pieces = [checkpoint_dir(spark), "lakeops", *parts]
    if unique:
        pieces.append(f"run-{uuid.uuid4().hex[:12]}")
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(pieces))
