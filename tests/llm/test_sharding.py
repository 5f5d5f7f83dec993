import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from commwatch.llm.sharding import assign_shards, jump_hash, shard_manifest


def published_jump(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_are_those_of_the_published_loop(spark):
    draw = random.Random(1)
    keys = [draw.randrange(-(2**63), 2**63) for _ in range(300)] + [0, 1, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 16, 17, 61):
        got = df.select("k", jump_hash(F.col("k"), n).alias("s")).collect()
        assert all(r.s == published_jump(r.k, n) for r in got), n


def test_growing_moves_rows_only_into_the_new_shard(spark):
    rows = shard_manifest(spark.range(3000).selectExpr("id AS doc_id", "'x' AS text")).collect()
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert {r.grown_shard for r in moved} == {16} and 90 < len(moved) < 280


def test_manifest_of_odd_rows(odd, odd_rows, none):
    got = shard_manifest(odd).collect()
    rows = sorted(((r.doc_id is not None, r.doc_id), r.size, r.text_crc32) for r in got)
    size = [(k, (t or "").encode()) for k, t, *_ in odd_rows]
    assert rows == sorted(((k is not None, k), len(b) + 1, zlib.crc32(b)) for k, b in size)
    slots = defaultdict(list)
    for r in got:
        assert r.shard == published_jump(r.doc_id or 0, 16) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_manifest(none).count() == 0


def test_a_hot_repeated_row_gets_all_its_slots(spark):
    df = spark.range(500).selectExpr("if(id < 300, 7, id) AS doc_id", "'same' AS text")
    got = shard_manifest(df).where("doc_id = 7").collect()
    assert len({r.slot for r in got}) == 300 and len({r.shard for r in got}) == 1


def test_assigning_is_narrow(spark):
    df = assign_shards(spark.range(10).withColumnRenamed("id", "doc_id"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
