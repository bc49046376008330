import hashlib
import os
import random
import re

import pytest

from skygrid.llm import grammar, queries, secrets

ASSIGN = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def plain_base(text):
    """The base spans as the rules have them: match, then drop what fails."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


ODD = [None, "", "token=", "token=abc token=abcdefgh", "TOKEN : 'abcdefghij'", "api_key=\"x.y-z_/+=ab", "apikey:=abcdefghij", "toKen=abcdefghij", "paſſword=abcdefghij", "password=secret=token=abc", "é😀 secret: 12345678é", "AKIA" + "A" * 11, "AKIA" + "A" * 12, "xAKIAAKIA" + "B7" * 6 + "c", "AKIA" * 4, "a" * 31, "a" * 32, "g" + "0f" * 40 + "G", "token = \"" + "ab12" * 10 + "\" x", "ab12" * 100_000, "y " * 200_000 + "token=" + "q" * 50]


@pytest.mark.parametrize("seed", [0, 1])
def test_base_spans_follow_the_rules(seed):
    rng = random.Random(seed)
    parts = ["token", "Secret", "api_key", "=", ":", " ", "\"", "'", "AKIA", "A1B2", "deadbeef", "0f" * 9, "x", "é", ".", "passwd", "\n"]
    for text in [t or "" for t in ODD] + ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(2000)]:
        spans = secrets.base_spans(text)
        assert [s[:3] for s in spans] == plain_base(text)
        tokens = [(m.start(), m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_.=-]{8,}", text) if all(m.end() <= a or m.start() >= b for a, _, b in plain_base(text))]
        assert list(secrets.other_tokens(text, spans)) == tokens


def prose(rng, n):
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 11))) for _ in range(400)]
    return " ".join(rng.choice(words) if rng.random() > 0.03 else rng.choice(["2024-11-28", "mail7.example.com", "www.example.org/path", f"{rng.randrange(10**16):016}", "-----------", "555-77134"]) for _ in range(n))


def test_formats_of_labelled_credentials_are_found_elsewhere(spark):
    """Access keys whose start isn't AKIA's own place, and tokens that stand without a name, by their learned form; prose stays clean."""
    rng = random.Random(3)
    key = lambda: "sk-" + "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789", k=28))
    docs = [(k, prose(rng, 80) + f" secret: {key()} " + prose(rng, 30)) for k in range(200)]
    docs += [(1000 + k, prose(rng, 40) + f" ({key()}) " + prose(rng, 40)) for k in range(60)]
    docs += [(2000 + k, prose(rng, 200)) for k in range(400)] + [(None, "token=abcdefgh1"), (7, docs[7][1]), (9000, None), (9001, "")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, spans string, value int").repartition(9)
    got = secrets.find_secrets(df).collect()
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        base = [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.spans if s.base]
        assert base == plain_base(texts[r.doc_id] or "")
        added = [texts[r.doc_id][s.start : s.end] for s in r.spans if not s.base]
        assert all(x.startswith("sk-") for x in added)
    found = {r.doc_id for r in got if any(not s.base for s in r.spans)}
    assert len([i for i in found if i and 1000 <= i < 1060]) >= 57 and not [i for i in found if i and i >= 2000]
    assert sorted(map(str, secrets.find_secrets(df.repartition(2)).collect())) == sorted(map(str, got))


def test_odd_rows_and_no_rows(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.spans if s.base] for r in secrets.find_secrets(df).collect()}
    assert got == {i: plain_base(t or "") for i, t in enumerate(ODD)}
    assert secrets.find_secrets(df.where("false")).collect() == []


def test_query_columns(spark, sf_dir):
    sf_dir, n = f"{os.path.dirname(sf_dir)}/sf0.01", 0
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.QUERIES["op13_secret_grammars"](spark, sf_dir).collect():
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest() and set(filter(None, listed(base).split(","))) <= set(r.spans.split(","))
        n += len(base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
    assert n > 10


def test_inference_tells_states_apart():
    """(ab)* with an end after each b only: two states, and likelihoods that sum to one over all strings."""
    rng = random.Random(1)
    words = [b"ab" * min(40, 1 + int(rng.expovariate(0.4))) for _ in range(3000)]
    g = grammar.inferred(words, smoothing=1e-6)
    # After the last b of the longest words too few are left to be told apart, so a few more states may be kept.
    assert 2 <= len(g.log_p) <= 4
    s = g.scores([b"ab", b"abab", b"aba", b"ba", b""])
    assert s[0] > -2 and s[1] < s[0] and s[2] < -10 and s[3] < -10
    import math
    assert abs(sum(math.exp(x) for x in g.scores([b"ab" * k for k in range(1, 60)])) - 1) < 0.01
    flat = grammar.inferred([bytes(rng.choices(b"0123456789abcdef", k=40)) for _ in range(800)])
    assert len(flat.log_p) <= 3 and flat.scores([b"0f" * 20])[0] > -40 * 2.9 - 5 > flat.scores([b"zz" * 20])[0]
