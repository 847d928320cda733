"""SparkSession construction and the few session-level settings the engine relies on.

Everything here is plain Spark configuration:

* AQE on, with partition coalescing and skew-join splitting, so a client that owns a large share of the purchases
  does not end up as one straggler task in the silver joins.
* Session time zone UTC: the test tables store dates as timestamps; casting them to DATE must not shift days.
* The checkpoint directory is read from the session (``spark.checkpoint.dir``, a shared folder on a cluster).
  A default is set only when the session has none, which is the local/test case.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "retentia", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` is only applied when given; on a cluster the launcher decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators need to a session someone else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # skewed joins and the rebalanced writes of ``save_table`` rely on adaptive execution
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory; set a local one only if none is configured and the master is local.

    On a cluster a folder on the driver's own disk would not be seen by the executors, so a missing setting is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="retentia-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured
