"""Session helpers.

The library never creates its own cluster settings behind the user's back: jobs take
the ``SparkSession`` they are given. ``local_session`` is for tests, the bench and
small local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

# Settings every session used with this library should have. ANSI stays on (Spark 4
# default); all parsing goes through try_* functions instead.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method of more bytecode than this. Wide cleaning and rounding
    # projections exceed it when fused into one method; run apart, their code is compiled.
    HUGE_METHOD_LIMIT: "8000",
}


def compiled_methods(spark: SparkSession) -> None:
    """Let this session run no generated method that the JVM would only interpret. The registered
    queries call it; the operators themselves leave the session's settings alone."""
    spark.conf.set(HUGE_METHOD_LIMIT, RECOMMENDED_CONF[HUGE_METHOD_LIMIT])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "herdfeed") -> SparkSession:
    """A local session for tests and benchmarks (UI off, loopback driver host)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("HERDFEED_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset (local tests)
    fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="herdfeed-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, how: str = "persist") -> DataFrame:
    """Materialise a DataFrame that several outputs share.

    ``persist``: MEMORY_AND_DISK cache; lost blocks are recomputed from lineage.
    ``checkpoint``: reliable checkpoint into ``spark.checkpoint.dir`` (cuts lineage).
    ``none``: leave lazy.
    """
    if how == "none":
        return df
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    raise ValueError(f"unknown materialize mode {how!r}")
