"""Expected values of FIXTURES.md §3 (computed there with DuckDB)."""

import pytest
from pyspark.sql import functions as F

from tollstream.plans.catalog import QUERIES

EXPECTED = {
    # sf: (keyed toll>0 rows, keyed toll sum, emit_zero rows, max lav, max cars,
    #      global kept, global rows, global toll>0 rows, global toll sum)
    "0.001": (0, None, 325, 57, 13, 512, 399, 0, 0),
    "0.01": (1207, 1695632, 2940, 56, 91, 5475, 4336, 4145, 24000048),
    "0.1": (14841, 15190804694, 30971, 51, 851, 52812, 42403, 40602, 74664717202),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_fixture_values(spark, sf):
    d = f"/root/testdata/sf{sf}"
    k = QUERIES["toll_notifications_keyed"](spark, d).agg(F.count("*"), F.sum("toll")).first()
    z = QUERIES["toll_notifications_keyed_all"](spark, d).agg(
        F.count("*"), F.max("lav"), F.max("num_vehicles")).first()
    kept = QUERIES["vehicle_same_segment"](spark, d).count()
    g = QUERIES["toll_notifications_global"](spark, d).agg(
        F.count("*"), F.sum((F.col("toll") > 0).cast("int")), F.sum("toll")).first()
    assert (*k, *z, kept, *g) == EXPECTED[sf]
