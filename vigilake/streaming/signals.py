"""Streams: deduplication, first and last seen, windows; each runs to the end of what has arrived (``availableNow``).

State lives in the checkpoint folder of the session; results are files there, never the driver's memory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigilake.tables import checkpoint_dir


def arriving(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream over the parquet files of table ``name`` in ``folder``."""
    path = f"{folder}/{name}.parquet"
    schema: StructType = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}.parque[t]")


def finished(stream: DataFrame, mode: str = "append", folder: str | None = None) -> DataFrame:
    """Everything the stream yields for the files there are, as a table.

    ``folder`` keeps state and results between runs: a later run reads only files that came since, and its result holds that of the earlier ones. Without it the run stands
    alone. Delete the folder to start anew.
    """
    spark = stream.sparkSession
    at = folder or f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{at}/state")
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", f"{at}/out").start()
    else:
        query = writer.outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{at}/out")).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def once(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key, whenever repeats arrive. The state is a row per key and grows with them; it lies in the state store, not in memory."""
    return stream.dropDuplicates(keys)


def seen_spans(stream: DataFrame, key: str, at: str) -> DataFrame:
    """``(key, first_seen, last_seen, n)``, kept up to date."""
    return stream.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("n"))


def windows(stream: DataFrame, at: str, length: str = "1 day") -> DataFrame:
    """``(start, kind, n)`` per tumbling window, for the mode "complete": late rows count and windows still open come out. The state is a row
    per window and kind. Rows without a time are in no window.
    """
    timed = stream.withColumn("__at", F.col(at).cast("timestamp"))
    return timed.groupBy(F.window("__at", length), F.col("event_type").alias("kind")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "kind", "n")
