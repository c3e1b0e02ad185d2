"""Starting and finishing streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eddyline.session import STATE_STORE, new_folder

BatchHandler = Callable[[DataFrame, int], None]


def to_table(stream: DataFrame, path: str, checkpoint: str, name: str = "eddyline") -> DataFrame:
    """Append a stream's finished rows to parquet, working off what is there now."""
    query = (
        stream.writeStream.format("parquet")
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def each_batch(
    stream: DataFrame, handler: BatchHandler, checkpoint: str, mode: str, name: str = "eddyline"
) -> None:
    """Hand every micro-batch to ``handler``, working off what is there now."""
    use_state_store(stream.sparkSession)
    query = (
        stream.writeStream.foreachBatch(handler)
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def collected(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over its present input into a table of its own and read that table."""
    spark = stream.sparkSession
    use_state_store(spark)
    folder = new_folder(spark, name)
    return to_table(stream, f"{folder}/rows", f"{folder}/checkpoint", name)


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors need the RocksDB state store; large window state gains from it too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
