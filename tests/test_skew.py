"""Hot keys: one vehicle holding a third of all rows."""

import random

from helpers import reports_df
from pyspark.sql import functions as F
from test_reference_loop import replay_global, replay_keyed

from tollstream.operators.skew import hot_threshold, join_with_hot_split
from tollstream.operators.vehicle import first_reports
from tollstream.plans.global_ import toll_notifications_global
from tollstream.plans.keyed import toll_notifications_keyed


def skewed_rows(seed=11, n=6000):
    rnd = random.Random(seed)
    times = sorted(rnd.randrange(0, 600) for _ in range(n))
    rows = []
    for off, t in enumerate(times):
        vid = 0 if off % 3 == 0 else rnd.randrange(1, 400)       # vid 0: a third of the rows
        rows.append((off, 0, t, vid, rnd.randrange(0, 60), 0, rnd.randrange(5), rnd.randrange(2),
                     rnd.randrange(2), 0))
    return rows


def test_hot_split_equals_plain_join(spark):
    df = reports_df(spark, skewed_rows())
    small = first_reports(df)
    count_col = [c for c in small.columns if c.endswith("rows")][0]
    threshold = spark.range(1).select(hot_threshold(df, 8)).first()[0]
    hot = [r["vid"] for r in small.where(F.col(count_col) > threshold).collect()]
    assert hot == [0]
    plain = df.join(small, "vid")
    split = join_with_hot_split(df, small, "vid", count_col, partitions=8)
    assert "_key_salt" in split._jdf.queryExecution().optimizedPlan().toString()   # the split path ran
    assert split.count() == plain.count() == 6000
    assert split.exceptAll(plain.select(*split.columns)).count() == 0


def test_tolls_with_hot_vehicle(spark):
    rows = skewed_rows()
    df = reports_df(spark, rows)
    got = {r["offset"]: (r["lav"], r["num_vehicles"], r["toll"])
           for r in toll_notifications_keyed(df, emit_zero=True).collect()}
    assert got == replay_keyed(rows)
    g = {r["offset"]: (r["lav"], r["num_vehicles"], r["toll"])
         for r in toll_notifications_global(df).collect()}
    assert g == replay_global(rows)
