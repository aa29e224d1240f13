"""Session settings and lineage cuts shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans in this package are written for.  One-to-many
# lookups rely on AQE to split a hot key; forcing the split keeps it even when
# a later operator then needs one more exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that Python sees at a time: texts are long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # The JVM does not compile methods over this size; Spark then makes shorter ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to a running session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hedonic")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder: the session's own, else a scratch one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            shared = tempfile.mkdtemp(prefix="hedonic-checkpoints-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage; later reads prune columns and know the size.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    # This codec works in the heap; others hold native buffers for every file until a collection.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


cut = settle


def release(*frames: DataFrame) -> None:
    """Delete the files of settled frames that nothing reads any more."""
    for df in frames:
        for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file)
            if path.getName().startswith("table-"):
                path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
