import hashlib
import math
import zlib

from llm_helpers import edge_docs, edge_rows, no_docs

from tollstream.llm import sharding


def winner(key, weights):
    def score(s):
        text = f"{'null' if key is None else key}/{s}/"
        u = (int(hashlib.md5(text.encode()).hexdigest()[:12], 16) + 0.5) / 2.0 ** 48
        return -weights[s] / math.log(u)

    return max(range(len(weights)), key=score)


def test_odd_rows(spark):
    weights, grown = [1.0, 2.0, 0.5], [1.0, 2.0, 0.5, 1.0]
    got = sharding.assign(edge_docs(spark), weights, grown).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), winner(i, weights), winner(i, grown))
            for i, t, *_ in edge_rows()]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got),
                  key=str) == sorted(want, key=str)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert sharding.assign(no_docs(spark), weights).count() == 0


def test_growth_and_weights(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'x' AS text")
    got = sharding.assign(docs, [1.0] * 8 + [0.0], [1.0] * 8 + [2.0]).toPandas()
    moved = got[got["shard"] != got["grown_shard"]]
    assert (moved["grown_shard"] == 8).all()
    assert abs(len(moved) / len(got) - 0.2) < 0.02
    assert (got.groupby("shard").size() / len(got) - 0.125).abs().max() < 0.01
    assert (got.sort_values("slot").groupby("shard")["slot"].apply(list).map(lambda x: x == list(range(len(x))))).all()


def test_slots_follow_the_key_in_many_ranges(spark, monkeypatch):
    """More rows than a range, a third of them one repeated row: slots are
    the rank by (key, checksum, size) in each shard."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", 500)
    docs = spark.range(12000).selectExpr("if(id % 3 = 0, 7, id * 7919 % 100003) AS doc_id", "'x' AS text")
    got = sharding.assign(docs.repartition(4), [1.0] * 8).toPandas()
    assert len(got) == 12000
    for _, rows in got.groupby("shard"):
        by_slot = rows.sort_values("slot")
        assert by_slot["slot"].tolist() == list(range(len(rows)))
        assert by_slot["doc_id"].is_monotonic_increasing


def test_sql_keeps_repeated_rows_above_a_range(spark, tmp_path, monkeypatch):
    import duckdb

    monkeypatch.setattr(sharding, "RANGE_ROWS", 300)
    path = str(tmp_path / "t")
    rows = spark.range(2000).selectExpr("nullif(if(id % 3 = 0, 7, id), 1) AS doc_id", "concat('t', id % 2) AS text")
    rows.write.parquet(f"{path}/documents.parquet")
    got = sharding.query(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({sharding.SQL})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
