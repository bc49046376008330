import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skygrid.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, list int, v string"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [None if x is None else float(x) for x in v], 1, "x") for i, v in enumerate(vectors)], SCHEMA)


def brute(vectors, ids, every, k):
    x = np.asarray(vectors, np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


@pytest.mark.parametrize("spread", [0.3, 10.0])
def test_recall_and_scores(spark, monkeypatch, spread):
    """Clustered and shapeless vectors, a third of them nearly equal, over small blocks."""
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 32))
    x = centres[rng.integers(0, 8, 3000)] + spread * rng.standard_normal((3000, 32))
    x[::3] = centres[0] + 0.01 * rng.standard_normal((1000, 32))
    want = brute(x, np.arange(3000), 50, 5)
    got = {}
    for r in ann.nearest(frame(spark, x), F.col("vec_id") % 50 == 0, sample_rows=400).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(g[0] in {w[0] for w in want[q]} for q, row in got.items() for g in row.values())
    assert hits / (5 * len(want)) >= 0.9
    unit = np.asarray(x, np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for q, row in got.items():
        scores = [row[k][1] for k in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        assert all(abs(s - unit[q] @ unit[v]) < 1e-12 for v, s in row.values())


def test_ties_and_unusable_vectors(spark):
    vectors = [[1, 0], [2, 0], [3, 0], [0, 1], None, [], [0, 0], [1, None], [1, float("nan")], [float("inf"), 1], [1, 2, 3][:1], [1, 1]]
    got = ann.nearest(frame(spark, vectors), F.lit(True), k=3).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    assert sorted(by) == [0, 1, 2, 3, 11]
    assert sorted(by[0]) == [(1, 1, 1.0), (2, 2, 1.0), (3, 11, round(0.5**0.5, 9))]
    assert sorted(by[3])[0] == (1, 11, round(0.5**0.5, 9))


def test_few_and_none(spark):
    assert [(r.query_id, r.vec_id) for r in ann.nearest(frame(spark, [[1, 0], [0, 1]]), F.col("vec_id") == 0).collect()] == [(0, 1)]
    assert ann.nearest(frame(spark, [[1, 0]]), F.lit(True)).count() == 0
    assert ann.nearest(frame(spark, [None]), F.lit(True)).count() == 0
    same = ann.nearest(frame(spark, [[1, 2]] * 9), F.col("vec_id") == 4, k=3).collect()
    assert sorted((r["rank"], r.vec_id) for r in same) == [(1, 0), (2, 1), (3, 2)]


def test_abandoned_early_yet_right():
    """With no sample to bound them, blocks give the exact best; with bounds, what is within them."""
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((500, 40)), rng.standard_normal((20, 40))
    none = np.zeros(0, np.int64)
    index = ann.Index(np.linalg.qr(rng.standard_normal((40, 40)))[0], (x[:1, :20], x[:1, 20:]), 1, x[:0], none, none, 5, 100)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    cos = unit(q) @ unit(x).T
    fifth = np.sort(cos, axis=1)[:, -5]
    for bounds in (np.full(20, 4.0), 2 - 2 * fifth):
        who, ids, score = ann.scan_block(index, np.arange(500), x, 1000 + np.arange(20), q, bounds)
        found = sum(len(set(ids[who == 1000 + i]) & set(np.argsort(-cos[i])[:5])) for i in range(20))
        assert found >= 97 and np.allclose(score, cos[who - 1000, ids])


def test_one_overlong_vector_leaves_the_others(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [1.0] * 9)], "vec_id long, embedding array<float>")
    assert sorted(r.vec_id for r in ann.usable(df, "vec_id", "embedding").collect()) == [1, 2, 3]
    assert ann.usable(df.where("false"), "vec_id", "embedding").count() == 0


def test_recall_of_the_registered_query(spark, sf_dir):
    """The answers over the table, which come from the lists alone, against brute force."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want, got = brute(x, ids, 50, 5), {}
    for r in queries.op7_adaptive_scan(spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(abs(g[1] - w[1]) < 1e-9 for q, row in want.items() for w, g in zip(row, [got[q][k] for k in range(1, 6)], strict=True))
    among = sum(g[0] in {w[0] for w in want[q]} for q, row in got.items() for g in row.values())
    assert max(hits, among) / (5 * len(want)) >= 0.9


def test_copies_and_repeated_ids(spark):
    """Of many equal vectors the smallest ids are found; an id that repeats is one candidate."""
    vectors = [[1, 2, 3]] * 300 + [[1, 2, 3.1], [3, 1, 0], [0, 1, 5]]
    both = frame(spark, vectors).unionByName(frame(spark, vectors[:4])).unionByName(frame(spark, [[1, 2, 3.1]], first=302))
    got = {}
    for r in ann.nearest(both, F.col("vec_id").isin(2, 200, 300, 302), k=4).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got[2] == [0, 1, 3, 4] and got[200] == [0, 1, 2, 3] and got[300][0] == 302 and got[300][1:] == [0, 1, 2]
    assert len(got[302]) == len(set(got[302])) == 4
    many = ann.nearest(frame(spark, vectors[295:]), F.lit(True), k=50)
    assert {r["count"] for r in many.groupBy("query_id").count().collect()} == {7}


def test_few_lists_of_clustered_vectors(spark):
    """50,000 vectors in 400 clusters: nine tenths of the neighbours are found in a fifth of the rows at most."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((400, 32))
    x = (centres[rng.integers(0, 400, 50_000)] + 0.4 * rng.standard_normal((50_000, 32))).astype(np.float32)
    ids = np.arange(50_000)
    df = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 32).cast(pa.list_(pa.float32()))})).repartition(8)
    want = brute(x, ids, 500, 5)
    found = {}
    for r in ann.nearest(df, F.col("vec_id") % 500 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(found[q] & {w[0] for w in row}) / 5 for q, row in want.items()])
    share = ann.scanned_share(df, F.col("vec_id") % 500 == 0)
    assert recall >= 0.9 and share < 0.2, (recall, share)
