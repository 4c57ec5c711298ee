"""Where intermediate tables go: the shared folder that the session names, or a local one in local sessions alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a local folder in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


def held(df: DataFrame) -> DataFrame:
    """The rows written out by checkpoint(): cuts lineage and survives lost executors."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(df.sparkSession))
        path = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
        path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return df.checkpoint()
