import random

from skygrid.llm import fixity

SCHEMA = "at long, url string, html string, node int, hash string"


def run(spark, left, right, fanout=4):
    frames = [spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA) for rows in (left, right)]
    found = fixity.fixity_audit(*frames, "at", ["url", "html"], fanout).collect()
    return {r.offset: r.status for r in found}


def want(left, right):
    """By comparing all records of each offset."""
    at = lambda rows, k: sorted(map(str, (r for r in rows if (r[0] if r[0] is not None else -1) == k)))
    keys = {(r[0] if r[0] is not None else -1) for r in left + right}
    return {k: "missing" if not at(right, k) else "extra" if not at(left, k) else "changed" for k in keys if at(left, k) != at(right, k)}


def test_random_damage(spark):
    rng = random.Random(1)
    for n, fanout in ((200, 12), (90, 64), (3, 2)):
        left = [(rng.randrange(5 * n), f"u{k}", rng.choice([None, "", "text", "é" * k])) for k in range(n)]
        right = [(a, u, (h or "") + "!" if rng.random() < 0.03 else h) for a, u, h in left if rng.random() > 0.03] + [(10 * n + 1, "new", "x")]
        assert run(spark, left, right, fanout) == want(left, right)


def test_equal_replicas_have_one_root(spark):
    rows = [(k * 7, "u", str(k)) for k in range(100)]
    assert run(spark, rows, rows[::-1]) == {}
    trees = [fixity.tree(spark.createDataFrame([(*r, 1, "z") for r in x], SCHEMA), "at", ["url", "html"], 4) for x in (rows, rows[::-1])]
    roots = [t[-1].collect() for t in trees]
    assert roots[0] == roots[1] and len(roots[0]) == 1 and roots[0][0].node == 0
    # Nothing below equal roots is read: it needn't even be there.
    assert fixity.audit([None] * (len(trees[0]) - 1) + trees[0][-1:], [None] * (len(trees[1]) - 1) + trees[1][-1:], 4).count() == 0


def test_descent_reads_ranges_of_the_scan(spark, monkeypatch):
    """One damaged record of many: its leaf is sought with a range that reaches the files; many suspects are joined."""
    rows = [(k, "u", str(k)) for k in range(600)]
    rows2 = [(k, "u", str(k) + ("!" if k == 77 else "")) for k in range(600)]
    a, b = (fixity.tree(spark.createDataFrame([(*r, 1, "z") for r in x], SCHEMA), "at", ["url", "html"], 8) for x in (rows, rows2))
    seen = []
    monkeypatch.setattr(fixity, "written", lambda df: seen.append(df) or df)
    assert [tuple(r) for r in fixity.audit(a, b, 8).collect()] == [(77, "changed")]
    plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(node,72), LessThanOrEqual(node,79)") >= 2
    assert [tuple(r) for r in fixity.audit(a, b, 8, listed=0).collect()] == [(77, "changed")]


def test_large_and_negative_offsets(spark):
    top = (1 << 63) - 1
    rows = [(top - k, "u", "x") for k in range(5)] + [(-top + k, "u", "x") for k in range(5)] + [(k, "u", "x") for k in range(-9, 9)]
    for gone in (top - 3, -9):
        assert run(spark, rows, [r for r in rows if r[0] != gone], 64) == {gone: "missing"}


def test_edges(spark):
    rows = [(None, None, None), (-5, "a", "b"), (0, "a", ""), (0, "a", "")]
    assert run(spark, rows, rows) == {}
    assert run(spark, rows, [(None, None, ""), (-5, "a", "b"), (0, "a", "")]) == {-1: "changed", 0: "changed"}
    assert run(spark, rows, []) == {-1: "missing", -5: "missing", 0: "missing"}
    assert run(spark, [], rows) == {-1: "extra", -5: "extra", 0: "extra"}
    assert run(spark, [], []) == {}
    assert run(spark, [(1, "ab", "c")], [(1, "a", "bc")]) == {1: "changed"}


def test_columns_of_clashing_names(spark):
    """Columns named as the trees' own are content or left out as any other."""
    rows = [(k, f"u{k}", f"h{k}", k, "x", 3, 1, "s") for k in range(300)]
    schema = "at long, hash string, node string, up long, level string, offset int, digest int, status string"
    left = spark.createDataFrame(rows, schema)
    right = spark.createDataFrame([(*r[:2], r[2] + "!" * (r[0] == 7), *r[3:]) for r in rows if r[0] != 9] + [(400, "a", "b", 1, "c", 0, 0, "d")], schema)
    assert sorted((r["offset"], r["status"]) for r in fixity.fixity_audit(left, right, "at", ["hash", "node"], 4).collect()) == [(7, "changed"), (9, "missing"), (400, "extra")]
