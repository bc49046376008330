import random

import pytest
from brute import WORD, mixed

from skygrid.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, key string, cell string"


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    names = ["b", "a", "é", "A", None, "zz"]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 3, 10, 400])) + rng.choice(["", " ", "\t\n", "\x0bx"]), rng.choices(names, weights=[40, 3, 3, 3, 3, 8])[0]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "c") for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("digits", [1, 3])
def test_against_rounds_of_clamping(spark, monkeypatch, seed, digits):
    monkeypatch.setattr(mixing, "CELL_DIGITS", digits)
    rows = corpus(seed) + [(500, None, "a"), (501, "", "b"), (502, "only words here", "lone")]
    got = sorted(map(tuple, mixing.mix(frame(spark, rows)).collect()))
    want = sorted(mixed(rows))
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    by_source = {}
    for i, _, source in rows:
        by_source.setdefault(source, []).append(i)
    taken = {g[0]: g for g in got}
    for ids in by_source.values():
        assert abs(sum(taken[i][4] for i in ids) - taken[ids[0]][3]) <= 1
    assert all(g[4] <= 2 * g[1] for g in got)


def test_reruns_agree_and_seeds_differ(spark):
    rows = corpus(5)
    first, again = (sorted(map(tuple, mixing.mix(frame(spark, rows).repartition(n)).collect())) for n in (1, 5))
    other = sorted(map(tuple, mixing.mix(frame(spark, rows), seed=9).collect()))
    assert first == again and first != other


def test_word_count(spark):
    texts = ["a b", " a\x0bb\x0cc\r\n", "", None, "é 日本", "a\x1cb", "   "]
    got = [r.n for r in spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.word_count(mixing.F.col("t")).alias("n")).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]


def test_rows_as_often_as_taken(spark):
    docs = frame(spark, corpus(7))
    rows = mixing.mixed_rows(docs)
    assert rows.schema == docs.schema
    count = {}
    for r in rows.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    for r in mixing.mix(docs).collect():
        assert abs(count.get(r.doc_id, 0) * r.size - r.taken) * 2 <= r.size


def test_empty_tables(spark):
    none = frame(spark, corpus(1)).where("false")
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0
    assert [tuple(r) for r in mixing.mix(frame(spark, [(1, None, None), (2, "", "a")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_native(spark):
    plan = mixing.mix(frame(spark, corpus(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_one_id_keep_their_own_number(spark):
    """Texts under one id, or under none, are taken each by itself."""
    rows = [(7, "a " * 40, "s"), (7, "b", "s"), (None, "c " * 30, "s"), (None, "d d", "t"), (8, None, "t"), (9, "e " * 50, "t")]
    docs = frame(spark, rows)
    got = {}
    for r in mixing.mixed_rows(docs).collect():
        got[r.doc_id, r.text] = got.get((r.doc_id, r.text), 0) + 1
    taken = {}
    for r in mixing.mix(docs).collect():
        taken.setdefault((r.doc_id, r.size), r.taken)
    for i, t, _ in rows:
        size = len((t or "").split())
        assert abs(got.get((i, t), 0) * size - taken[i, size]) * 2 <= size
