"""Session defaults. Sizes are settings of the cluster, never of the code."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Applied only where the caller has not set them. Catalyst picks broadcast
# joins from estimated and (under AQE) measured sizes against the threshold,
# so no operator in this package hints a broadcast of data that can grow.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "formflow", **conf: str) -> SparkSession:
    """A session with the package defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Where it is unset, a local folder is made and set if the session is local
    (unit tests); on a cluster executors would not share it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="formflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found
