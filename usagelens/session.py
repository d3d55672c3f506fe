"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from usagelens.schemas import TelemetryError

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where the next step could have reused the join's partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods above this size; Spark then splits the projection instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # up to so many wanted ids reach the Bloom filters of the id index
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of its own only where a single machine runs all."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not re.match(r"local($|\[)", sc.master):
            raise TelemetryError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="usagelens-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/usagelens/{label}-{uuid.uuid4().hex}"
