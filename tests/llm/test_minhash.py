import random

import numpy as np
import pytest
from brute import near_duplicates, shingles

from skygrid.llm import graph, minhash


def texts(seed=3):
    """Groups of near copies at many similarities, exact copies, short texts and clean ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    out = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([30, 60, 200]))]
        out.append(" ".join(base))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy).title() if rng.random() < 0.3 else "  ".join(copy))
    out += [" ".join(word() for _ in range(n)) for n in (1, 2, 4, 5, 6, 50)] * 2
    rng.shuffle(out)
    return out


def test_against_all_pairs(spark):
    docs = [(10 * k + 3, t) for k, t in enumerate(texts())] + [(5000, None), (5001, ""), (5002, " \t\n"), (5003, "a b\x0bc d e\x1cf g")]
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, rep int, h string, n_shingles int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame).collect()}
    assert got == near_duplicates(docs)
    kept = minhash.one_of_each(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {c for _, c in got.values()}


def test_links_that_the_first_of_a_bucket_misses(spark):
    """A chain in which each text is near the next only; and a large group whose members are near few others."""
    rng = random.Random(4)
    base = ["w%d" % k for k in range(200)]
    chain = []
    for _ in range(30):
        chain.append(" ".join(base))
        for _ in range(2):
            base[rng.randrange(200)] = "x%d" % rng.randrange(10**6)
    order = list(range(30))
    rng.shuffle(order)
    docs = [(order[k], t) for k, t in enumerate(chain)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == near_duplicates(docs)


def test_blocks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "LEADER_LINKS", 2)
    rng = random.Random(6)
    base = ["w%d" % k for k in range(60)]
    docs = []
    for i in range(40):
        copy = list(base)
        for k in rng.sample(range(60), rng.randint(0, 3)):
            copy[k] = "y%d" % rng.randrange(5)
        docs.append((i, " ".join(copy)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == near_duplicates(docs)


def test_repeated_rows_long_texts_and_no_rows(spark):
    long = " ".join("v%d" % (k % 30011) for k in range(60000))
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A B C D E F"), (3, long), (4, long + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame).collect())
    assert [(i, c, k) for i, _, c, k in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 3, False)]
    assert got[3][1] == len(shingles(long))
    assert minhash.near_duplicates(frame.where("false")).count() == 0


def test_super_minhash_by_hand():
    """Signatures against one element at a time with a whole permutation."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 3, 40, 700)]
    slots = 16
    got = minhash.super_minhash(np.concatenate(sets), np.array([len(s) for s in sets]), slots)
    for s, signature in zip(sets, got, strict=True):
        want = [None] * slots
        for element in s:
            order = list(range(slots))
            for step in range(slots):
                drawn = int(minhash.mix64(np.array([element]) + np.uint64((step * 0xD1342543DE82EF95) & (2**64 - 1)))[0])
                place = (drawn >> 32) % (slots - step) + step
                order[step], order[place] = order[place], order[step]
                value = (step << 32) | (drawn & 0xFFFFFFFF)
                if want[order[step]] is None or value < want[order[step]]:
                    want[order[step]] = value
        assert signature.tolist() == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(200):
        both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (80, 10, 10))
        pair = [np.concatenate([both, x]) for x in (a, b)]
        s = minhash.super_minhash(np.concatenate(pair), np.array([90, 90]), 80)
        errors.append((s[0] == s[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.01 and np.var(errors) < 0.8 * 0.2 / 80


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(20)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hidden_links_between_blocks(spark, monkeypatch):
    """Members of small blocks, in a largest component and outside it: as brute force over all pairs says."""
    monkeypatch.setattr(minhash, "BLOCK", 2)
    sets = {i: sorted({100 * (i // 2) + k for k in range(20)} | {-i - 1}) for i in range(11)}
    comp = {i: 0 if i in (0, 2, 4, 6) else i for i in sets}
    members = spark.createDataFrame([(7, i, comp[i]) for i in sets], "h long, rep long, comp long")
    table = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>")
    found = {tuple(sorted((r.u, r.v))) for r in minhash.hidden_links(members, table, 80).collect()}
    assert found == {(i, i + 1) for i in range(0, 10, 2)}


@pytest.mark.parametrize("turn", [1, -1])
def test_one_id_with_several_texts(spark, turn):
    """Each text of an id is a document of its own, in whatever order the rows come."""
    base = [f"w{k}" for k in range(60)]
    a, near_a, b, c = (" ".join(x) for x in (base, [*base[:-1], "x"], base[::-1], [f"v{k}" for k in range(9)]))
    rows = [(1, a, "x", 0), (5, near_a, "x", 0), (5, b, "x", 0), (5, c, "x", 0), (2, b, "x", 0), (5, c, "x", 0), (None, a, "x", 0), (7, None, "x", 0)][::turn]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone string, T int").repartition(3)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, 56, 0, True), (1, 56, 1, True), (2, 56, 2, True), (5, 5, 5, True), (5, 5, 5, True), (5, 56, 1, False), (5, 56, 2, False), (7, 0, 7, True)]
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(0, a), (1, a), (2, b), (5, c), (5, c), (7, "")])
