"""Shards that arrive while a query runs: a file source whose checkpoint plays the ledger's part."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sonolode.functions.hashing import shard_id
from sonolode.operators.metrics import KEYS, group_state
from sonolode.sinks import write_dataset


def follow(spark: SparkSession, folder: str, output: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], schema: str, files_per_trigger: int = 25) -> StreamingQuery:
    """Prepare and write every new file once, and append the state of its statistics per shard.

    A micro-batch that is repeated after a failure overwrites its own folder, so that nothing is doubled.
    """

    def batch(rows: DataFrame, number: int) -> None:
        kept = prepare(rows.withColumn("shard_id", shard_id(F.input_file_name()))).persist()
        try:
            write_dataset(kept, f"{output}/data/batch={number:08d}", mode="overwrite")
            group_state(kept, ("shard_id", *KEYS)).coalesce(1).write.mode("overwrite").parquet(f"{output}/state/batch={number:08d}")
        finally:
            kept.unpersist()

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
