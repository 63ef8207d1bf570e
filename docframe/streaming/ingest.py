"""Documents as a stream: files are parsed as they come, checked and upserted by (doc_id, content_hash)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


FILE = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, path: str, pattern: str = "*.docx") -> DataFrame:
    stream = spark.readStream.schema(FILE).format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return stream.where(~F.element_at(F.split("path", "/"), -1).rlike(r"^(~\$|\._)"))


def with_hash(stream: DataFrame) -> DataFrame:
    return stream.withColumn("content_hash", F.sha2("content", 256))


def once(stream: DataFrame, event_time: str = "modificationTime", delay: str = "1 day") -> DataFrame:
    """Equal contents within the delay pass once; state older than the delay is dropped."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["content_hash"])


def windowed_counts(stream: DataFrame, event_time: str, width: str, delay: str, *keys: str) -> DataFrame:
    """Rows in each event-time window and key; a window is final once the watermark passes its end."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *keys).agg(F.count("*").alias("n"))


def run_batches(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All files that are there now, in batches; process must take a batch again after a failure (an upsert does)."""
    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
