"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from chainlake.sources.store import qualified

# UTC keeps `dt` and age arithmetic independent of the driver's zone. AQE coalesces small shuffle
# partitions and splits skewed join partitions; both are on by default and stated here for clarity.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configured(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder the cluster names in `spark.checkpoint.dir`.

    Only a session whose tasks share the driver's disk may leave that unset: a temporary folder stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="chainlake-")
    # With its scheme, so that tasks which write files themselves write where Spark looks.
    return qualified(spark, f"{base.rstrip('/')}/chainlake/{purpose}-{uuid.uuid4().hex}")
