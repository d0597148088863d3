"""Edge cases of the toll rules on hand-written rows (keyed and global)."""

from helpers import by_offset, rep, reports_df

from tollstream.plans.global_ import toll_notifications_global
from tollstream.plans.keyed import toll_notifications_keyed


def keyed(spark, rows, emit_zero=True):
    return by_offset(toll_notifications_keyed(reports_df(spark, rows), emit_zero=emit_zero),
                     "lav", "num_vehicles", "toll")


def minute_one(cars, speed, seg=5, start_vid=1000):
    """`cars` vehicles in minute 1 of segment `seg`, one report each."""
    return [rep(i, 10, start_vid + i, speed=speed, seg=seg) for i in range(cars)]


def probe(offset, time, seg=5, vid=1, lane=1):
    return rep(offset, time, vid, speed=50, seg=seg, lane=lane)


def test_car_threshold(spark):
    for cars, expected in ((50, 0), (51, 2)):
        rows = minute_one(cars, 39) + [probe(10_000, 60)]
        assert keyed(spark, rows)[10_000] == (39, cars, expected)


def test_lav_threshold(spark):
    for speed, expected in ((39, 200), (40, 0)):
        rows = minute_one(60, speed) + [probe(10_000, 60)]
        assert keyed(spark, rows)[10_000] == (speed, 60, expected)


def test_zero_tolls_dropped_by_default(spark):
    rows = minute_one(50, 39) + [probe(10_000, 60)]
    assert 10_000 not in keyed(spark, rows, emit_zero=False)
    rows = minute_one(51, 39) + [probe(10_000, 60)]
    assert keyed(spark, rows, emit_zero=False)[10_000] == (39, 51, 2)


def test_lav_rounds_half_up(spark):
    rows = [rep(0, 5, 100, speed=2), rep(1, 6, 101, speed=3), probe(2, 61)]
    assert keyed(spark, rows)[2][0] == 3


def test_first_minute_has_no_history(spark):
    rows = [rep(0, 0, 100, speed=20), probe(1, 59)]
    assert keyed(spark, rows)[1] == (0, 0, 0)


def test_gap_minute(spark):
    base = [rep(0, 10, 100, speed=10), rep(1, 130, 101, speed=30)]  # minutes 1 and 3
    in4 = keyed(spark, base + [probe(2, 190)])[2]                    # minute 4
    assert in4 == (20, 1, 0)
    in5 = keyed(spark, base + [probe(2, 250)])[2]                    # minute 5, minute 4 absent
    assert in5 == (20, 0, 0)


def test_history_horizon(spark):
    base = [rep(0, 10, 100, speed=10)]                               # minute 1 only
    assert keyed(spark, base + [probe(1, 310)])[1][0] == 10          # minute 6 sees minute 1
    assert keyed(spark, base + [probe(1, 370)])[1][0] == 0           # minute 7 does not


def test_exit_lane_counts_but_gets_no_toll(spark):
    rows = minute_one(51, 30)
    rows[0] = rep(0, 10, 1000, speed=30, lane=4)                     # exit lane in minute 1
    out = keyed(spark, rows + [probe(10_000, 60), probe(10_001, 61, vid=2, lane=4)])
    assert out[10_000] == (30, 51, 2)
    assert 10_001 not in out


def test_return_to_first_segment(spark):
    rows = [rep(0, 0, 7, seg=5), rep(1, 30, 7, seg=6), rep(2, 60, 7, seg=5)]
    from tollstream.operators.vehicle import flag_new_segment, keep_first_segment
    flags = by_offset(flag_new_segment(reports_df(spark, rows)), "in_new_seg")
    assert flags == {0: (True,), 1: (True,), 2: (False,)}
    kept = sorted(r["offset"] for r in keep_first_segment(reports_df(spark, rows)).collect())
    assert kept == [0, 2]


def test_vehicle_state_is_shared_across_xways(spark):
    rows = [rep(0, 0, 7, seg=5, xway=0), rep(1, 30, 7, seg=5, xway=1)]
    from tollstream.operators.vehicle import flag_new_segment
    flags = by_offset(flag_new_segment(reports_df(spark, rows)), "in_new_seg")
    assert flags == {0: (True,), 1: (False,)}


def test_global_dialect_pools_segments_and_keeps_zero(spark):
    # 51 cars spread over two segments in minute 1: keyed sees 26 / 25, global 51.
    rows = [rep(i, 10, 1000 + i, speed=30, seg=i % 2) for i in range(51)]
    rows.append(rep(100, 60, 1, speed=30, seg=0))
    rows.append(rep(101, 60, 2, speed=30, seg=1, lane=4))
    g = by_offset(toll_notifications_global(reports_df(spark, rows)), "lav", "num_vehicles", "toll")
    assert g[100] == (30, 51, 2)
    assert 101 not in g                      # exit lane
    assert g[0] == (0, 0, 0)                 # zero tolls are emitted
    k = keyed(spark, rows)
    assert k[100] == (30, 26, 0)
