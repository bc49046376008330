import hashlib
import random

import numpy as np
import pytest
from brute import repeats

from skygrid.llm import suffixes


def corpus(seed=2):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices("abcd é\n", k=n))
    passages = [text(n) for n in (30, 49, 50, 51, 80, 200, 1000)]
    docs = [text(rng.randint(0, 400)) + "".join(rng.choice(passages) + text(rng.randint(0, 80)) for _ in range(rng.randint(0, 4))) for _ in range(80)]
    docs += [docs[3], docs[3], "", None, "ab" * 300, "x" * 49, "x" * 50, "x" * 51, "x" * 120, docs[5][:-30] + "!" + docs[5][-30:]]
    return list(enumerate(docs))


def check(spark, docs, width=50):
    frame = spark.createDataFrame([(i, t, 1, "x", b"y") for i, t in docs], "doc_id long, text string, dp int, sha string, blob binary")
    options = {"width": width, "gram": min(24, width // 2)}
    got = {r.doc_id: r for r in suffixes.repeats_cut(frame, **options).collect()}
    rest = suffixes.without_repeats(frame, **options)
    assert rest.schema == frame.schema
    left = {r.doc_id: r for r in rest.collect()}
    want = repeats(docs, width)
    assert got.keys() == want.keys()
    for i, (n, gone, spans, kept) in want.items():
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, gone, spans, hashlib.sha256(kept).hexdigest()), i
        text = left[i].text
        assert (text or "") == kept.decode("utf-8", "ignore") and (text is None) == (dict(docs)[i] is None) and left[i].sha == "x"


def test_against_all_windows(spark):
    check(spark, corpus())


def test_many_parts_and_single_windows(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 1500)
    monkeypatch.setattr(suffixes, "MANY", 5)
    check(spark, corpus(7))


@pytest.mark.parametrize("width", [9, 16, 33, 64])
def test_other_widths(spark, width):
    check(spark, corpus(width), width)


def test_repeated_rows_long_texts_and_no_rows(spark):
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefghij ", k=300_000))
    rows = [(1, "q" * 60), (1, "q" * 60), (2, long), (3, long[1000:200_000])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in suffixes.repeats_cut(frame).collect())
    assert got == [(1, 0), (1, 0), (2, 0), (3, 199_000)]
    odd = spark.createDataFrame([(5, "r" * 10 + long[:70]), (5, long[:60]), (7, long[5:65]), (None, long[3:60])], "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in suffixes.repeats_cut(odd).collect()}
    assert got == {(None, 57): 0, (5, 80): 57, (5, 60): 57, (7, 60): 60}
    assert suffixes.repeats_cut(frame.where("false")).count() == 0


def test_suffix_array_and_intervals():
    """Against sorting strings, on stretches over two letters."""
    rng = random.Random(3)
    for width in (4, 8, 11, 50):
        stretches = [bytes(rng.choices(b"ab" if width < 20 else b"a", k=rng.randint(width, width + 26))) for _ in range(12)]
        stretches = list(dict.fromkeys(stretches))
        data, size = np.frombuffer(b"".join(stretches), np.uint8), np.array([len(s) for s in stretches])
        order, prefix = suffixes.repeated_suffixes(data, size, width)
        start = np.cumsum(size) - size
        tail = {int(a) + k: s[k:] for a, s in zip(start, stretches, strict=True) for k in range(len(s) - width + 1)}
        heads = [s[:width] for s in tail.values()]
        assert sorted(order.tolist()) == sorted(p for p, s in tail.items() if heads.count(s[:width]) > 1)
        sorted_ = [tail[p] for p in order.tolist()]
        assert sorted_ == sorted(sorted_)
        common = [next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b))) for a, b in zip(sorted_, sorted_[1:], strict=False)]
        assert [c if c >= width else 0 for c in common] == prefix[1:].tolist()
        length, first, last = suffixes.prefix_intervals(prefix, width)
        got = set(zip(length.tolist(), first.tolist(), last.tolist(), strict=True))
        want = set()
        for i in range(len(common)):
            for j in range(i, len(common)):
                m = min(common[i : j + 1])
                if m >= width and (i == 0 or common[i - 1] < m) and (j + 1 == len(common) or common[j + 1] < m):
                    want.add((m, i, j + 1))
        assert got == want


def test_groups_have_all_occurrences(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    shared = text(60)
    docs = [(k, text(100) + shared + text(100)) for k in range(5)] + [(9, text(300))]
    found = suffixes.repeat_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert found and any(r.length == 60 for r in found)
    for r in found:
        places = [(o.doc_id, o.begin) for o in r.occurrences]
        strings = {dict(docs)[i][b : b + r.length] for i, b in places}
        assert len(strings) == 1
        want = [(i, b) for i, t in docs for b in range(len(t)) if t.startswith(next(iter(strings)), b)]
        assert sorted(places) == sorted(want)


def test_groups_have_the_copies_of_one_part(spark):
    """Whole copies, and a passage of 200 bytes, within one part: all bytes and all documents are in groups."""
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choices("abcdefghij", k=n))
    copy, passage = noise(400), noise(200)
    docs = {1: copy, 2: copy, 3: copy, 4: noise(90) + passage + noise(30), 5: noise(10) + passage + noise(70)}
    want = {1: set(range(400)), 2: set(range(400)), 3: set(range(400)), 4: set(range(90, 290)), 5: set(range(10, 210))}
    got = {i: set() for i in docs}
    for length, places in suffixes.repeat_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect():
        passages = {docs[p.doc_id][p.begin : p.begin + length] for p in places}
        assert len(passages) == 1 and length >= 50
        ids = {p.doc_id for p in places}
        assert ids == ({1, 2, 3} if 1 in ids else {4, 5})
        for p in places:
            got[p.doc_id] |= set(range(p.begin, p.begin + length))
    assert got == want


@pytest.mark.parametrize("many", [2000, 3])
def test_long_repeats_are_joined(spark, monkeypatch, many):
    """Passages of many stretches, at several places and within one document, are one group each with all occurrences, however often they occur."""
    monkeypatch.setattr(suffixes, "MANY", many)
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choices("abcdefghij", k=n))
    one, two = noise(700), noise(333)
    fill = lambda k, n: chr(65 + k) * n
    docs = {k: fill(k, 40 + k) + one + fill(k, 30) for k in range(6)} | {10: two + fill(10, 45) + two, 11: fill(11, 20) + two}
    got = {(r.length, tuple(sorted((o.doc_id, o.begin) for o in r.occurrences))) for r in suffixes.repeat_groups(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert (700, tuple((k, 40 + k) for k in range(6))) in got and (333, ((10, 0), (10, 378), (11, 20))) in got
    assert all(len({docs[d][b : b + n] for d, b in places}) == 1 for n, places in got)
    assert len(got) == 2


def test_ids_that_repeat_or_are_missing_part(spark, monkeypatch):
    """Texts under one id, or none, are dealt to many parts, and the result stays."""
    monkeypatch.setattr(suffixes, "PART_BYTES", 2000)
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh", k=70))
    rows = [(rng.choice([None, 7, 8]), "".join(rng.choices("abcdefgh", k=rng.randint(0, 200))) + chr(0x4E00 + k) + passage) for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    parts, n = suffixes.parted(frame, "doc_id", "text")
    assert n > 2 and parts.where("doc_id = 7").select("dp").distinct().count() > 2
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffixes.repeats_cut(frame).collect())
    assert got == sorted((i or 0, len(t.encode()), 70 if i else 0) for i, t in rows)


def test_columns_of_clashing_names(spark):
    text = "".join(random.Random(9).choices("abcdefgh ", k=400))
    rows = [(k, text[10 * k :], k, "b", 1, 2.0, "c") for k in range(4)] + [(9, None, 0, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, begin string, rest int, c0 double, n_bytes string")
    got = {r.doc_id: r.n_removed for r in suffixes.repeats_cut(docs).collect()}
    assert got == {0: 0, 1: 390, 2: 380, 3: 370, 9: 0}
    left = suffixes.without_repeats(docs)
    assert left.columns == docs.columns and sorted((r.doc_id, len(r.text or ""), r.part, r.begin) for r in left.collect()) == [(0, 400, 0, "b"), (1, 0, 1, "b"), (2, 0, 2, "b"), (3, 0, 3, "b"), (9, 0, 0, None)]


def test_rows_between_parts_grow_with_the_input(spark, monkeypatch):
    """Each part sends a row to each part of the hashes: sixteen times the text may give some sixteen times these rows, not 256."""
    monkeypatch.setattr(suffixes, "PART_BYTES", 500)
    monkeypatch.setattr(suffixes, "FEW_PARTS", 4, raising=False)
    rng = random.Random(5)
    docs = [(k, "".join(rng.choices("abcdefgh", k=200))) for k in range(1600)]
    few, many = (suffixes.parted(spark.createDataFrame(docs[:n], "doc_id long, text string"), "doc_id", "text")[1] for n in (100, 1600))
    assert few > 4 and many**2 <= 1.2 * 16 * few**2


def test_parts_that_grow(spark, monkeypatch):
    """More sections and larger parts give the same bytes."""
    monkeypatch.setattr(suffixes, "PART_BYTES", 1500)
    monkeypatch.setattr(suffixes, "FEW_PARTS", 2, raising=False)
    monkeypatch.setattr(suffixes, "MANY", 5)
    check(spark, corpus(17))


def test_copies_meet_and_go_on_once(spark):
    """A table that is repeated with shifted ids: of each text one copy has leaders, all others are covered whole."""
    docs = corpus(6)[:30]
    docs += [(i + 1000 * k, t) for k in (1, 2) for i, t in docs]
    check(spark, docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    parts, _ = suffixes.parted(frame, "doc_id", "text")
    tables = [parts.where(parts.dp == r.dp).toArrow() for r in parts.select("dp").distinct().collect()]
    led = sum(len(suffixes.Part(t, 50, 24).doc) for t in tables)
    assert led == len(suffixes.Part(parts.where("doc_id < 1000").toArrow(), 50, 24).doc)


def test_a_text_of_very_many_copies_parts(spark, monkeypatch):
    """Copies of one text, and empty texts, are dealt out to several parts; equal ids don't cover each other."""
    monkeypatch.setattr(suffixes, "PART_BYTES", 2000)
    text = "".join(random.Random(6).choices("abcdefgh", k=300))
    rows = [(max(k, 2), text) for k in range(90)] + [(k, None) for k in range(90)] + [(None, text[:49]), (200, "z" + text[:60])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    parts, n = suffixes.parted(frame, "doc_id", "text")
    assert n > 2 and all(parts.where(which).select("dp").distinct().count() > 2 for which in ("length(text) = 300", "text IS NULL"))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffixes.repeats_cut(frame).collect())
    assert got == sorted([(max(k, 2), 300, 300 * (k > 2)) for k in range(90)] + [(k, 0, 0) for k in range(90)] + [(0, 49, 0), (200, 61, 60)])
