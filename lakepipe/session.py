"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed around.  AQE coalesces and splits shuffle
# partitions at run time, so the initial count can stay generous on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # recording the Python line of every column expression makes plans slow to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int = 8, app: str = "lakepipe", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks (no web page); its checkpoint folder is a new one unless given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    scratch = {} if "spark.checkpoint.dir" in settings else {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")}
    for key, value in {**SETTINGS, **scratch, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the folder the cluster names in spark.checkpoint.dir.

    Where the setting is missing a folder is made up on a local master, whose executor is this very process; on a cluster
    that is an error, because executors could not see such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of a result that several branches of a plan read, and
    survives the loss of executors.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
