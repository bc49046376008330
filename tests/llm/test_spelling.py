import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from skygrid.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(docs, length=7, least=2):
    seen = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and h % 31 == 0:
                word = word[: h % len(run)] + word[h % len(run) + 1 :]
            seen[word] += 1
    return {w: n for w, n in seen.items() if len(w) >= length and n >= least}


def apart(a, b):
    """Whether two words differ by exactly one edit."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if v != w and apart(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = [best if best and words[best] >= 10 * n else None, n, len(near)]
    rows = set()
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, near, form and words[form]))
    return rows


def corpus(rng, words, n):
    letters = "abcdeéü×"
    out = []
    for _ in range(n):
        w = rng.choice(words)
        if rng.random() < 0.2:
            k, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:k] + (rng.choice(letters) if kind else "") + w[k + (kind < 2) :]
        out.append(w.upper() if rng.random() < 0.05 else w)
    return " ".join(out)


@pytest.mark.parametrize("group", [3, 256])
def test_groups_against_all_pairs(spark, monkeypatch, group):
    """With groups of three nearly every group is dealt again, to the last character."""
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(spelling, "MERGED", 200 if group == 3 else 1 << 22)
    rng = random.Random(group)
    base = ["".join(rng.choices("abcdé", k=rng.randint(6, 14))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababababab", "ba" * 3000, "b" + "ba" * 3000, "schlussß"]
    docs = [(k, corpus(rng, base, 60), "x", 3) for k in range(60)] + [(1, corpus(rng, base, 90), "x", 3)] * 2
    docs += [(None, corpus(rng, base, 50), None, 1), (70, None, "x", 1), (71, "", "x", 1), (72, "123 -- 日本語 ABC", "x", 2), (73, "x" * 300_000, "y", 1), (74, "x" * 300_000, "y", 1), (75, "x" * 299_999 + " " + "x" * 299_999, "y", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, word string, n int").repartition(6)
    words = spelling.counted(spelling.runs(df, 7, 31))
    want = plain_words([d[:2] for d in docs])
    assert {r.word: r.n for r in words.collect()} == want
    got = [tuple(r) for r in spelling.spelling_groups(words).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_groups(want) and sum(r[4] for r in got) > 200


def test_chains_of_forms_end_at_one_root(spark):
    words = {"a" * (9 - k) + "b" * k: 2 * 10**k for k in range(6)} | {"ccccccc": 5, "cccccccc": 50, "ccccccd": 50}
    got = {tuple(r) for r in spelling.spelling_groups(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got == plain_groups(words) and ("a" * 9, "a" * 8 + "b", "aaaabbbbb", 2, 1, 20) in got and ("ccccccc", "cccccccc", "cccccccc", 5, 2, 50) in got


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(spelling.counted(spelling.runs(none, 7, 31))).collect() == []


def test_count_filter_keeps_every_near_pair_and_few_others(monkeypatch):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcdefgh", k=rng.randint(7, 9))) for _ in range(300)})
    words = sorted({*words, *(w[:3] + rng.choice("abcdefgh") + w[4:] for w in words[:80]), *(w[:-1] for w in words[:80] if len(w) > 7)})
    points = np.array([ord(c) for w in words for c in w], np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    merged = lambda: {(int(a), int(b)) for x, y in spelling._merged(points, offsets, np.zeros(len(words), np.int64)) for a, b in zip(x, y, strict=True)}
    near = {(i, j) for j in range(len(words)) for i in range(j) if apart(words[i], words[j])}
    assert merged() == near and len(near) > 100
    monkeypatch.setattr(spelling, "_one_edit", lambda p, o, a, b: np.ones(len(a), bool))
    assert near <= merged() and len(merged()) < 0.05 * len(words) ** 2 / 2
