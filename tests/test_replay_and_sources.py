"""Replay prefix, text source line numbers, JSON value, Kafka options."""

import os

from helpers import rep, reports_df

from tollstream.operators.replay import replay_prefix
from tollstream.session import scratch_path
from tollstream.sources.json_value import json_value_text
from tollstream.sources.kafka import kafka_lines, kafka_options
from tollstream.sources.text import read_lines, write_lines


def test_replay_is_a_prefix(spark):
    df = reports_df(spark, [rep(0, 0, 1), rep(1, 5, 2), rep(2, 1, 3)])
    assert [r["offset"] for r in replay_prefix(df, 1).collect()] == [0]
    assert sorted(r["offset"] for r in replay_prefix(df, 4).collect()) == [0, 1, 2]


def test_text_lines_numbered_in_file_order(spark):
    path = scratch_path(spark, "t-lines")
    df = spark.range(0, 5000).selectExpr("id AS offset", "concat('line-', id) AS value")
    write_lines(df, path, partitions=7)
    got = read_lines(spark, path).collect()
    assert len(got) == 5000
    assert all(r["value"] == f"line-{r['offset']}" for r in got)


def test_order_value_is_the_same_order(spark):
    path = scratch_path(spark, "t-order")
    df = spark.range(0, 3000).selectExpr("id AS offset", "concat('line-', id) AS value")
    write_lines(df, path, partitions=5)
    scan = read_lines(spark, path, order="value", ingest_ts="at")
    plan = scan._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan
    rows = scan.orderBy("offset").collect()
    assert [r["value"] for r in rows] == [f"line-{k}" for k in range(3000)]
    assert all(r["at"] is not None for r in rows)


def test_natural_name(spark):
    from pyspark.sql import functions as F

    from tollstream.sources.text import natural_name
    names = ["/a/part-99999-x", "/a/part-100000-x", "/a/part-2-x"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r["n"] for r in df.orderBy(natural_name(F.col("n"))).collect()]
    assert got == ["/a/part-2-x", "/a/part-99999-x", "/a/part-100000-x"]


def test_kafka_partitions_need_a_vehicle_key(spark):
    import pytest

    from tollstream.streaming.sinks import to_kafka_frame
    raw = spark.createDataFrame(
        [(None, bytearray(b"0,1,2,3,4,5,6,7,8"), "lrb", p, 41, None) for p in (0, 1)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    with pytest.raises(Exception, match="more than one partition"):
        kafka_lines(raw).collect()
    assert [r["offset"] for r in kafka_lines(raw, keyed_by_vehicle=True).collect()] == [41, 41]
    lines = spark.createDataFrame([(7, "0,1,25,3"), (8, "0,2,31,3")], "offset long, value string")
    assert [r["key"] for r in to_kafka_frame(lines, by_vehicle=True).collect()] == ["25", "31"]


def test_log_sink(spark, capsys):
    from tollstream.streaming.sinks import log_sink
    df = spark.createDataFrame([("a line",)], "text string")
    path = scratch_path(spark, "k2")
    log_sink(df, path=path)
    assert [r.value for r in spark.read.text(path).collect()] == ["a line"]
    log_sink(df)
    assert "a line" in capsys.readouterr().out
    stream = spark.readStream.schema("value string").text(path).withColumnRenamed("value", "text")
    out = scratch_path(spark, "k2-out")
    log_sink(stream, path=out, trigger="availableNow").awaitTermination()
    assert [r.value for r in spark.read.text(out).collect()] == ["a line"]


def test_ingest_time(spark):
    import datetime as dt

    from tollstream.functions.parse import with_ingest_time
    at = dt.datetime(2024, 5, 1, 12)
    df = spark.createDataFrame([(1, at)], "id int, record_ts timestamp")
    assert with_ingest_time(df, "record_ts").first()["ingest_ts"] == at
    clock = with_ingest_time(df).first()["ingest_ts"]
    assert abs((clock - dt.datetime.now()).total_seconds()) < 24 * 3600


def test_json_value(spark):
    df = spark.createDataFrame([('{"k": 69}',), (None,)], "props string")
    got = [r[0] for r in df.select(json_value_text(df.props)).collect()]
    assert got == ['{"value":{"k":69}}', "{}"]


def test_kafka_options_and_projection(spark):
    opts = kafka_options("broker:9092", max_offsets_per_trigger=100_000)
    assert opts["subscribe"] == "lrb" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "100000"
    raw = spark.createDataFrame(
        [(None, bytearray(b"0,1,2,3,4,5,6,7,8"), "lrb", 0, 41, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    row = kafka_lines(raw).collect()[0]
    assert (row["offset"], row["value"]) == (41, "0,1,2,3,4,5,6,7,8")


def test_historical_tolls_reader(spark):
    from tollstream.sources.text import read_historical_tolls
    path = scratch_path(spark, "hist")
    spark.createDataFrame([("1,1,0,12",), ("2,69,3,0",)], "value string").coalesce(1).write.text(path)
    rows = [tuple(r) for r in read_historical_tolls(spark, path).orderBy("vid").collect()]
    assert rows == [(1, 1, 0, 12), (2, 69, 3, 0)]


def test_kafka_frame_keys_and_text_sink(spark):
    from pyspark.sql import functions as F

    from tollstream.streaming.sinks import text_sink, to_kafka_frame
    df = spark.createDataFrame([(7, "0,1,2"), (8, "0,1,3")], "offset long, value string")
    keyed = sorted(tuple(r) for r in to_kafka_frame(df).collect())
    assert keyed == [("7", "0,1,2"), ("8", "0,1,3")]
    unkeyed = to_kafka_frame(df, key_col=None).collect()
    assert all(r["key"] is None for r in unkeyed)               # null key, as the producer sends
    path = scratch_path(spark, "k1")
    assert text_sink(df.select(F.col("value").alias("text")), path) is None
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["0,1,2", "0,1,3"]
