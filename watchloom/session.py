"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Runtime settings the operators rely on. A skewed join is split even where the
# aggregate behind it could have reused the join's partitioning.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "watchloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC timestamps."""
    builder = SparkSession.builder.appName(app)
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare_session(spark: SparkSession) -> None:
    """The same settings on a session built elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir``. Only a local-mode session without it gets
    a folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would not be seen by other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="watchloom-")
    return _local_root


_local_root: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a
    result used several times is computed once and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
