"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; its skew-join rule splits the partitions of hot
# account keys that the deal-fact joins produce.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(cpus: int | None = None, app: str = "cohortlens",
                  shuffle_partitions: int | None = None,
                  driver_memory: str = "6g") -> SparkSession:
    """Local session for tests and the benchmark; on a cluster, use the
    session the platform provides and call :func:`configure` on it."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


_LOCAL_CHECKPOINT_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a folder every executor can reach). Where it is unset, a
    local session gets a folder of its own, once per application; any other
    master is refused, as its executors couldn't see a folder of the driver."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        path = _LOCAL_CHECKPOINT_DIRS.get(sc.applicationId) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        _LOCAL_CHECKPOINT_DIRS[sc.applicationId] = path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path
