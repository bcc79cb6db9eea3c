"""The stateless text stages on a stream of files.

Cleaning, tokenizing, chunking and the like hold no state, so the functions that work on a
table work on a streaming DataFrame unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def stream_parquet(spark: SparkSession, folder: str, schema: str, name_filter: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", name_filter).parquet(folder)


def run_available(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Apply a stage to everything that has arrived, append to out and return.

    The checkpoint remembers which files were taken, so a later call continues there.
    """
    writer = stream.transform(stage).writeStream.format("parquet").outputMode("append")
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    running.awaitTermination()
