"""Session construction and the shared folder that cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


# Settings of our own sessions; a cluster may do without, it is then slower.  Long column expressions compile to methods the JVM refuses to
# optimise (over 8000 bytes of bytecode); below that limit Spark splits such a stage by operator,
# which is several times faster for the curve and estimate queries.  Collecting the samples of a
# link falls back to sorting after 128 groups; short lists allow far more groups in memory.
TUNING = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
}


def local_session(cores: str = "8", app: str = "roadlens", memory: str = "16g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    )
    return builder.config(map=TUNING).getOrCreate()


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the session names.

    Only a session that names none (tests on one machine) gets a temporary folder, and only
    when its master is local: on a cluster a machine-local folder would not survive an executor.
    """
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_KEY} to a shared folder before running iterative operators")
            configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        context.setCheckpointDir(configured)
    return frame.checkpoint()
