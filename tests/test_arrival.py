"""Statistics in arrival order against the loop over the reports."""

import random

import pytest
from helpers import rep, reports_df
from pyspark.sql import functions as F
from test_reference_loop import random_rows, replay_global, replay_keyed

from tollstream.functions.parse import with_minute
from tollstream.operators.arrival import Seen, arrival_history, in_chunks, scan
from tollstream.operators.filters import position_reports
from tollstream.plans.global_ import toll_notifications_global
from tollstream.plans.keyed import toll_notifications_keyed
from tollstream.schema import SEGMENT_KEYS


def shuffled(seed, n=2500, late=600, **kw):
    """Rows whose arrival order is not their event time order."""
    rnd = random.Random(seed)
    rows = random_rows(seed, n=n, **kw)
    order = sorted(range(n), key=lambda k: k + rnd.randrange(late))
    return [(at, *rows[k][1:]) for at, k in enumerate(order)]


def answers(df):
    return {r["offset"]: (r["lav"], r["num_vehicles"], r["toll"]) for r in df.collect()}


@pytest.mark.parametrize("late", [1, 600, 2500])
def test_keyed_is_the_loop(spark, late):
    rows = shuffled(late, late=late, vids=300, minutes=10, xways=1, segs=2)
    got = answers(toll_notifications_keyed(reports_df(spark, rows).repartition(3), emit_zero=True, statistics="arrival"))
    assert got == replay_keyed(rows)
    if late > 1:  # the input tells the two forms apart
        assert got != answers(toll_notifications_keyed(reports_df(spark, rows), emit_zero=True))


@pytest.mark.parametrize("late", [1, 2500])
def test_global_is_the_loop(spark, late):
    rows = shuffled(late + 7, late=late, vids=300)
    assert answers(toll_notifications_global(reports_df(spark, rows).repartition(3), statistics="arrival")) == \
        replay_global(rows)


def test_chunk_size_does_not_matter(spark):
    rows = shuffled(5, n=600, late=300, vids=40, xways=1, segs=2)
    df = with_minute(position_reports(reports_df(spark, rows)))
    cols = ["offset", "lav", "num_vehicles"]
    want = sorted(map(tuple, arrival_history(df).select(cols).collect()))
    for chunk_rows in (10, 50):
        got = arrival_history(df, chunk_rows=chunk_rows).select(cols)
        assert sorted(map(tuple, got.collect())) == want


def test_hot_segment_is_spread(spark):
    """One segment with a third of all rows lies in every chunk, and no chunk
    is larger than the others."""
    rows = [rep(k, 300 + k // 20, k % 97, seg=5 if k % 3 == 0 else k % 50 + 10) for k in range(3000)]
    df = with_minute(position_reports(reports_df(spark, rows)))
    sizes = {r["_chunk"]: (r["n"], r["hot"]) for r in in_chunks(df, chunk_rows=100).groupBy("_chunk").agg(
        F.count("*").alias("n"), F.sum((F.col("seg") == 5).cast("int")).alias("hot")).collect()}
    assert len(sizes) >= 20
    assert max(n for n, _ in sizes.values()) <= 300
    assert max(h for _, h in sizes.values()) <= 120


def test_state_of_earlier_input(spark):
    """A scan that goes on from what an earlier one has added is one scan."""
    rows = shuffled(9, n=900, late=400, vids=60, xways=1, segs=2)
    df = with_minute(position_reports(reports_df(spark, rows)))
    cols = ["offset", "lav", "num_vehicles"]
    want = sorted(map(tuple, arrival_history(df).select(cols).collect()))
    got, minutes, vehicles = [], None, None
    for a, b in ((0, 250), (250, 400), (400, 900)):
        part = df.where((F.col("offset") >= a) & (F.col("offset") < b))
        out = scan(part, seen=Seen(minutes, vehicles) if minutes is not None else None, chunk_rows=60)
        got += map(tuple, out.answers.select(cols).collect())
        both = out.minutes if minutes is None else minutes.unionByName(out.minutes)
        minutes = both.groupBy(*SEGMENT_KEYS, "minute").agg(*[F.sum(c).alias(c) for c in ("reports", "speed_sum", "cars")])
        vehicles = out.vehicles if vehicles is None else vehicles.unionByName(out.vehicles)
    assert sorted(got) == want
    assert vehicles.count() == vehicles.distinct().count()


def test_first_minute_and_gap(spark):
    rows = [rep(0, 59, 1), rep(1, 10, 2), rep(2, 61, 3, speed=20), rep(3, 30, 4, speed=90), rep(4, 65, 5), rep(5, 361, 6)]
    got = {r["offset"]: (r["lav"], r["num_vehicles"]) for r in
           arrival_history(with_minute(position_reports(reports_df(spark, rows)))).collect()}
    assert got == {0: (0, 0), 1: (0, 0), 2: (50, 2), 3: (0, 0), 4: (63, 3), 5: (35, 0)}


def test_empty_input(spark):
    assert toll_notifications_keyed(reports_df(spark, []), statistics="arrival").collect() == []
    with pytest.raises(ValueError):
        toll_notifications_keyed(reports_df(spark, []), statistics="other")
