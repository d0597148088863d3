"""Joining a large table to a per-key table whose keys may be hot.

AQE splits skewed partitions only when both join inputs are plain shuffle
stages. A per-key aggregate joined back on its own key is not one (its output
is already partitioned by the key, so no new exchange is planned), and a key
holding a third of all rows would land in one task.

Here the per-key table carries each key's row count; keys above
``count / (2 * partitions)`` rows are *hot*. There are fewer than
``2 * partitions`` of them (pigeonhole), so the hot part of the table has a
proven size bound and is broadcast. One scan of the large side:

1. broadcast left join to the hot rows (map-side, no shuffle);
2. hot rows get a salt ``1 + hash(row) mod partitions`` (deterministic, so a
   retried task sees the same rows), cold rows salt 0;
3. left join to the cold rows on one struct column ``(key, salt)``: cold
   rows meet their key, hot rows match nothing there and are spread over all
   partitions by the salt instead of piling into one. A single struct key
   matters: joined on ``key`` and ``salt`` as two keys, the planner may reuse
   the per-key table's existing partitioning by ``key`` alone (it satisfies
   clustering on both) and shuffle the large side by ``key``, which puts a
   hot key back into one task (seen in a 5 million row test).

No row is dropped or capped; the result equals the inner join.

The split is planned at every size; where no key is hot its side is empty
and AQE prunes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"
_JOIN_KEY = "_key_salt"


def hot_threshold(big: DataFrame, partitions: int):
    """Scalar column: ``count(big) / (2 * partitions)``, evaluated once. A row
    count reads no column of the large side."""
    return big.select((F.count(F.lit(1)) / F.lit(2 * max(partitions, 1))).alias("t")).scalar()


def join_with_hot_split(big: DataFrame, small: DataFrame, key: str, count_col: str,
                        partitions: int | None = None, salt_cols: list[str] | None = None,
                        counted: DataFrame | None = None) -> DataFrame:
    """Inner join of ``big`` to ``small`` (one row per ``key``, with the number
    of rows of that key in ``count_col``: rows of ``counted``, by default of
    ``big``; the bound on the hot keys needs the threshold from the same rows
    as the counts). The salt hashes ``salt_cols`` (default: all columns of
    ``big``; a unique column is enough and keeps the scan pruned)."""
    values = [c for c in small.columns if c != key]
    p = partitions or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(count_col) > hot_threshold(big if counted is None else counted, p)
    hot = F.broadcast(small.where(is_hot).select(key, *[F.col(c).alias(f"_h{c}") for c in values]))
    cold = small.where(~is_hot).select(F.struct(F.col(key), F.lit(0).alias(_SALT)).alias(_JOIN_KEY),
                                       *[F.col(c).alias(f"_c{c}") for c in values])
    probe = F.col(f"_h{values[0]}")
    hashed = F.hash(*[F.col(c) for c in (salt_cols or big.columns)])
    salt = F.when(probe.isNull(), F.lit(0)).otherwise(1 + F.pmod(hashed, F.lit(p)))
    staged = big.join(hot, key, "left").withColumn(_JOIN_KEY, F.struct(F.col(key), salt.alias(_SALT)))
    j = staged.join(cold, _JOIN_KEY, "left")
    merged = [F.coalesce(F.col(f"_h{c}"), F.col(f"_c{c}")).alias(c) for c in values]
    return j.select(*big.columns, *merged).where(F.col(values[0]).isNotNull())
