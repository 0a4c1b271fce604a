"""Dump files as a stream: new files are upserted as they arrive (IN5, IN6).

The checkpoint remembers which files have been read, which is the resume of an interrupted load.
An extension: the batch functions give the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stemma.sources import buckets


def upsert_stream(spark: SparkSession, folder: str, schema: str, keys: list[str], target: str, checkpoint: str, files_per_batch: int = 8) -> StreamingQuery:
    """Reads JSON-lines files of ``folder`` as they come and upserts them into the bucketed table at ``target``.

    Repeated keys of one batch keep one row.  A batch is a delta of the keys' buckets, numbered like the
    batch, so that one which runs again after a failure replaces itself; see ``buckets.read``.  Stops
    when all files that are there have been read.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    if buckets.layout(spark, target) is None:
        buckets.create(spark, target, spark.createDataFrame([], schema), keys)

    def write(batch: DataFrame, number: int) -> None:
        buckets.upsert(batch.sparkSession, target, batch.dropDuplicates(keys), delta=number + 1)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
