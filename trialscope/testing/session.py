"""A local SparkSession for tests and the benchmark (the library itself never
creates sessions)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None) -> SparkSession:
    scratch = scratch or tempfile.mkdtemp(prefix="trialscope-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trialscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TRIALSCOPE_DRIVER_MEMORY", "8g"))
        # release broadcasts, shuffle files and checkpoints of finished
        # queries promptly (the cleaner acts after a JVM GC)
        .config("spark.cleaner.periodicGC.interval", "1min")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.local.dir", os.path.join(scratch, "local"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        # tests only: a local folder stands in for the cluster's shared one
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return spark
