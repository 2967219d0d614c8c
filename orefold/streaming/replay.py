"""Raw to typed as a stream: each micro-batch is merged into a keyed table, latest wins, and rewrites only the folders its keys fall in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.merge import latest
from ..sources.keyed import Keyed
from ..sources.stored import stored


def merge_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    folder: str,
    name: str,
    keys: list[str],
    order: list[Column],
    *,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int = 1000,
    buckets: int = 64,
) -> DataFrame:
    """Reads new Parquet files of ``source``, transforms them and merges them; runs until what is there has been read.

    A batch that runs again finds its own rows in the table and replaces no folder. The table is Keyed at ``folder/name``; each commit is labelled with the
    batch's number. A new ``checkpoint`` replays everything, and changes nothing where everything is in already.
    """
    typed = transform(spark.createDataFrame([], schema)).schema
    table = Keyed(spark, f"{folder}/{name}", typed, tuple(keys), tuple(order), buckets)

    def merge(batch: DataFrame, number: int) -> None:
        rows = stored(latest(transform(batch), keys, order), "batch")
        Keyed(batch.sparkSession, table.where, typed, table.keys, table.order, buckets).merge(rows, f"batch {number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return table.read()
