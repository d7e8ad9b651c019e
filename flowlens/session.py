"""Session helpers.

Library code never creates its own session; it takes the caller's.  ``get_session`` is for
tests, the bench and the entry point.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from
the session (the cluster's shared folder).  Where it is unset it makes a fresh scratch folder
under a local master, which is the test case, and raises under any other.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "flowlens") -> SparkSession:
    master = master or os.environ.get("FLOWLENS_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("FLOWLENS_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """Shared checkpoint folder of the session; a scratch folder is made only when unset.
    Under Spark Connect there is no driver context here: the server's own
    ``spark.checkpoint.dir`` applies and is only read."""
    try:
        jsc = spark.sparkContext._jsc.sc()
    except Exception:  # noqa: BLE001 - Spark Connect session
        try:
            return spark.conf.get(_CKPT_KEY, None)
        except Exception:  # noqa: BLE001
            return None
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    configured = spark.sparkContext.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="flowlens-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return jsc.getCheckpointDir().get()
