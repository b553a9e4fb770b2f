"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import logging
import tempfile

from pyspark.sql import SparkSession


#: The JVM never compiles a method above 8000 bytes of bytecode.  Wide projections (scores
#: and labels of every reading) exceed that when fused into one method and then run several
#: times slower, so such stages are generated per operator instead.
JIT_METHOD_LIMIT = "8000"
#: Stored readings unpack to more than ten times their bytes; a task that sorts those of one split of this size
#: has them in memory.
SPLIT_BYTES = "16m"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session someone else has built."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    return spark


def build_session(master: str = "local[8]", app_name: str = "wattlake", **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster leave ``spark.sql.shuffle.partitions`` to the submitter (2-3 per core);
    AQE coalesces small shuffles and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
        .config("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can read, taken from ``spark.checkpoint.dir``.

    A local master has one machine, so there an unset value falls back to a fresh
    temporary folder, which is logged.  On a cluster an unset value is an error: a
    machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="wattlake-")
    logging.getLogger(__name__).warning("spark.checkpoint.dir is unset; intermediates go to %s", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder that belongs to this application only."""
    return "/".join([shared_root(spark), f"wattlake-{spark.sparkContext.applicationId}", *parts])
