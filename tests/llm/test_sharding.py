import random

from pyspark.sql import functions as F

from skygrid.llm import sharding
from skygrid.llm.common import text_bytes


def run(spark, rows, limit, **options):
    docs = spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "doc_id long, text string, depth int, shard string")
    out, directory = sharding.extendible_shards(docs, ["doc_id"], text_bytes(), limit, **options)
    return out.collect(), {r.shard: r for r in directory.collect()}


def test_shortest_prefixes_that_fit(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 5, 40, 300])) for i in range(400)] + [(1000, None), (1001, "y" * 5000)]
    out, directory = run(spark, rows, 900)
    assert len(out) == len(rows)
    total = {}
    for r in out:
        for k in range(len(r.shard) + 1):
            total[r.shard[:k]] = total.get(r.shard[:k], 0) + r.n_bytes
    for r in out:
        assert r.depth == len(r.shard) and r.shard_bytes == total[r.shard] == directory[r.shard].shard_bytes
        assert all(total[r.shard[:k]] > 900 for k in range(len(r.shard)))
        assert total[r.shard] <= 900 or r.shard_rows == 1
    assert [s for s, d in directory.items() if d.oversized] == [r.shard for r in out if r.doc_id == 1001]
    names = sorted(directory)
    assert not any(b.startswith(a) for a in names for b in names if a != b)


def test_hot_key_splits_on_ties(spark):
    docs = spark.createDataFrame([("hot", i, "x" * 100) for i in range(200)] + [("cold", i, "x" * 100) for i in range(20)], "k string, i int, text string")
    out, directory = sharding.extendible_shards(docs, ["k"], text_bytes(), 1000, tie_cols=["i"])
    assert out.count() == 220 and directory.where("oversized").count() == 0
    out, directory = sharding.extendible_shards(docs, ["k"], text_bytes(), 1000)
    assert out.count() == 220 and directory.where("oversized").count() == out.where("oversized").count() == 0
    same, whole = sharding.extendible_shards(docs, ["k"], text_bytes(), 1000, tie_cols=())
    assert {(r.shard_rows, r.oversized) for r in whole.collect()} == {(200, True), (20, True)}
    assert same.count() == 220


def test_all_in_one_and_none(spark):
    out, directory = run(spark, [(1, "a"), (1, "a"), (2, "b")], 100)
    assert {(r.shard, r.depth) for r in out} == {("", 0)} and directory[""].shard_bytes == 3 and len(out) == 3
    docs = spark.createDataFrame([], "doc_id long, text string")
    out, directory = sharding.extendible_shards(docs, ["doc_id"], text_bytes(), 10)
    assert out.count() == 0 and directory.count() == 0


def test_null_keys(spark):
    out, _ = run(spark, [(None, "a" * 60), (None, "b" * 60), (1, "c" * 60)], 100)
    assert len(out) == 3 and max(r.shard_bytes for r in out) == 60
    out, _ = run(spark, [(None, "a" * 60), (None, "a" * 60), (1, "c" * 60)], 100)
    assert len(out) == 3 and {(r.shard_bytes, r.oversized) for r in out} == {(120, True), (60, False)}


def test_native(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for df in sharding.extendible_shards(docs.withColumn("n", F.lit(1)), ["doc_id"], text_bytes(), 10):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
