"""Session construction and the shared scratch location.

On a cluster the session is created by the platform; the library only reads
its settings.  ``build_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every agora job relies on.  UTC is required: epoch seconds are turned
# into calendar days, and the day must not depend on the machine's zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Coalesce shuffle partitions to a target size instead of keeping one per
    # core: no swarm of tiny reducer tasks on small inputs, ~128 MB reducers
    # on large ones (size spark.sql.shuffle.partitions for the largest stage).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # No broadcast from size *estimates* (compressed file sizes understate data):
    # a broadcast is either an explicit hint on a side bounded by construction
    # or by a row count, or AQE's runtime choice on a measured shuffle size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "agora",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a local session configured like a production job."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    conf = {**REQUIRED_CONF, **(extra_conf or {})}
    if "spark.checkpoint.dir" not in conf:
        # Local runs only: a cluster passes its shared folder in the conf.
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="agora-ckpt-")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the jobs rely on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is.  Only when nothing is configured (tests, local runs) a folder under
    the system temp dir is created and set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext: use its conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        return configured or tempfile.mkdtemp(prefix="agora-ckpt-")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    local = tempfile.mkdtemp(prefix="agora-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    path = f"{base}{sep}agora/{purpose}/{uuid.uuid4().hex}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
