import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from skygrid.llm import automata, middle
from skygrid.llm.common import joined_bytes

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the rules, token by token."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = TOKEN.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    form = "spm" if h4 % 100 < 20 else "psm"
    return len(units), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


def odd_texts():
    rng = random.Random(5)
    letters = "aZé 1<PSM>日😀\n-"
    return ["", None, "a", " ", "<P", "<P>x", "a<S>b", "<<M", "\x00a\x00", "ab" * 70_000, "-" * 140_000, "é" * 50_000 + "x", "word " * 40_000, *("".join(rng.choices(letters, k=rng.choice([1, 5, 63, 64, 65, 300]))) for _ in range(150)), *("".join(rng.choices("abé 😀", k=rng.randint(40_000, 200_000))) for _ in range(6))]


def test_documents_are_cut_between_tokens(spark):
    texts = odd_texts()
    rows = [(k, t, k, "x", 1) for k, t in enumerate(texts)] + [(3, texts[9], 0, "x", 1), (3, texts[9], 0, "x", 1), (None, "of no id", 0, None, 2), (None, texts[10], 0, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, form string, h1 int").repartition(7)
    made = middle.fill_in_middle(docs).withColumn("back", middle.restored(F.col("form"), F.col("output")))
    got = sorted(map(str, made.collect()))
    want = []
    for i, t, *_ in rows:
        n, form, p, m, out = plain(i, t)
        want.append(str(Row(doc_id=i, n=n, form=form, prefix_chars=p, middle_chars=m, output=out, back=t or "")))
    assert got == sorted(want)


def test_no_rows(spark):
    assert middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000, 5000])
def test_any_automaton_is_composed_from_blocks(size):
    """Random automata of four states, all states of entry, against reading byte by byte."""
    rng = np.random.default_rng(size)
    delta, emits = rng.integers(0, 4, (5, 4)), rng.integers(0, 2, (5, 4))
    delta[4], emits[4] = np.arange(4), 0
    automaton = automata.Automaton(rng.integers(0, 4, 256).astype(np.uint8), delta, emits, idle=4)
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (size, 0, 3, size + 7)]
    scan = automata.scanned(automaton, *joined_bytes(pa.array(texts, pa.binary())))
    for t, text in enumerate(texts):
        for entry in range(4):
            state, hits = entry, []
            for k, byte in enumerate(text):
                kind = automaton.classes[byte]
                hits += [k] * emits[kind, state]
                state = delta[kind, state]
            assert (scan.ends_of_texts()[t, entry], scan.counts_of_texts()[t, entry]) == (state, len(hits))
            assert scan.places(np.full(len(hits), t), np.full(len(hits), entry), np.arange(len(hits))).tolist() == hits


def test_chunks_resolve_to_one_text(spark, monkeypatch):
    """With chunks of 50 bytes each text is joined from many, cut within characters and words."""
    monkeypatch.setattr(middle, "CHUNK", 50)
    rows = [(k, t) for k, t in enumerate(odd_texts()) if len(t or "") < 5000]
    got = {r.doc_id: tuple(r)[1:] for r in middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: plain(i, t) for i, t in rows}
