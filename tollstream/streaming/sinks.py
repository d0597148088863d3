"""Sinks (K1-K3): text files, log/console, Kafka, for batch and streaming.

Streaming sinks always get a checkpoint folder under the shared
``spark.checkpoint.dir``; a restarted query resumes from it, and the file
sink's commit log makes the output exactly-once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import ORDER_COL
from ..session import scratch_path

ROLL_INTERVAL = "1 second"


def vehicle_key(value: Column) -> Column:
    """The vehicle of a report line (field 2): the record key under which a
    vehicle's records stay in one partition, in order."""
    return F.get(F.split(value, ","), 2)


def to_kafka_frame(df: DataFrame, value_col: str = "value", key_col: str | None = ORDER_COL,
                   by_vehicle: bool = False) -> DataFrame:
    """K3: ``key, value`` text columns as the Kafka sink expects; the key is
    the source sequence number as text, null, or with ``by_vehicle`` the
    line's vehicle, which topics of several partitions need."""
    if by_vehicle:
        key = vehicle_key(F.col(value_col))
    else:
        key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.col(value_col).cast("string").alias("value"))


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str | None = None,
                value_col: str = "value", key_col: str | None = ORDER_COL,
                by_vehicle: bool = False) -> StreamingQuery | None:
    frame = to_kafka_frame(df, value_col, key_col, by_vehicle)
    if df.isStreaming:
        return (frame.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
                .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, "kafka-ckpt"))
                .start())
    frame.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers) \
        .option("topic", topic).save()
    return None


def text_sink(df: DataFrame, path: str, text_col: str = "text", checkpoint: str | None = None,
              trigger: str = ROLL_INTERVAL) -> StreamingQuery | None:
    """K1: one line per row. A stream rolls a new file per micro-batch, one
    batch per ``trigger`` interval (the 1 s roll of the original);
    ``trigger="availableNow"`` processes what is there and stops."""
    out = df.select(F.col(text_col).cast("string").alias("value"))
    if df.isStreaming:
        w = (out.writeStream.format("text").option("path", path)
             .option("checkpointLocation", checkpoint or scratch_path(df.sparkSession, "text-ckpt")))
        w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
        return w.start()
    out.write.mode("errorifexists").text(path)
    return None


def log_sink(df: DataFrame, text_col: str = "text", path: str | None = None,
             checkpoint: str | None = None, trigger: str = ROLL_INTERVAL) -> StreamingQuery | None:
    """K2: a durable log is a text sink; without a path the console (debug)."""
    if path is not None:
        return text_sink(df, path, text_col, checkpoint, trigger)
    out = df.select(text_col)
    if df.isStreaming:
        return (out.writeStream.format("console").option("truncate", "false")
                .trigger(processingTime=trigger).start())
    out.show(truncate=False)
    return None
