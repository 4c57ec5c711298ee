"""The sanitising plan over a stream of files, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termsieve.operators import rules


def sanitize_stream(spark: SparkSession, source: str, schema: str, allowed: DataFrame, query_col: str, sink: str, checkpoint: str, expand=None) -> int:
    """Sanitises all files there are, a batch at a time, and returns the number of batches.

    A batch is written under its number and replaces what an earlier try of it wrote, so a rerun after a failure
    leaves each row once. expand turns a batch into query rows first.
    """
    listed = allowed.distinct().cache()

    def batch(rows: DataFrame, number: int) -> None:
        rows = expand(rows) if expand else rows
        kept = rules.sanitized(rules.flag(rows, listed, query_col))
        kept.withColumn("batch", F.lit(number)).write.option("partitionOverwriteMode", "dynamic").partitionBy("batch").mode("overwrite").parquet(sink)

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    listed.unpersist()
    return len(query.recentProgress)
