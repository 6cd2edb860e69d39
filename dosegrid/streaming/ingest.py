"""Incremental work: chunks consolidated, growing folders ingested with a checkpoint, pairs not yet scored."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from dosegrid.sources.sinks import write_batch


def consolidated(chunks: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Union of chunk outputs without repeated rows."""
    return chunks.dropDuplicates(list(keys)) if keys else chunks.dropDuplicates()


def ingest(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, reason: Column, rejects: str, files_per_batch: int = 1, fmt: str = "parquet", step: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """New files of a folder since the last call, a few at a time; rows with a reason go to the reject log. The checkpoint says what is done, so a stopped job goes on where it was; a batch that is done again replaces what it had written. Sink and rejects have the batch's number as a column."""

    def write(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("reason", reason)
        write_batch(step(marked.where("reason is null").drop("reason")), sink, number)
        write_batch(marked.where("reason is not null"), rejects, number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def not_done(pairs: DataFrame, written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs that no output has yet."""
    return pairs.join(written.select(*keys).distinct(), list(keys), "left_anti")
