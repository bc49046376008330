import os

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skygrid.llm import common, minhash, pieces, tokens


def test_intermediates_go(spark):
    """What is written inside a scratch block is gone after it, what was discarded before that too."""
    with common.scratch(spark):
        kept, gone = common.written(spark.range(5)), common.written(spark.range(3).selectExpr("id", "id * 2 as b"), by="b")
        paths = [f.removeprefix("file://").rsplit("/", 1)[0] for f in kept.inputFiles()]
        assert kept.count() == 5 and sorted(r.id for r in gone.collect()) == [0, 1, 2] and all(map(os.path.exists, paths))
        common.discard(gone)
        assert kept.count() == 5
    assert paths and not any(map(os.path.exists, paths))


def test_names_that_are_free(spark):
    df = spark.createDataFrame([(1, 2)], "A int, a_ int")
    assert common.free_name(df, "a") == "a__" and common.free_name(df, "b") == "b"


def thue_morse(n, a="a", b="b"):
    """Two different words with equal sums of letter times power, modulo 2**64, for every odd base."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


def test_hashes_of_spans():
    """Equal for equal bytes anywhere, different for words made to agree modulo 2**64."""
    one, two = thue_morse(2048)
    data = np.frombuffer(f"x{one}yy{two}{one}".encode(), np.uint8)
    start = np.array([1, 2051, 4099, 1, 2])
    got = common.span_hashes(data, start, np.array([2049, 4099, 6147, 1, 2]))
    assert got[0] == got[2] != got[1] and got[3] == got[4]


@pytest.mark.parametrize("query", ["op4", "op5", "op6"])
def test_words_made_to_collide(spark, query):
    one, two = thue_morse(1024)
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{one} {two}")], "doc_id long, text string").coalesce(1)
    if query == "op4":
        plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        got = {r.doc_id: r.ids for r in tokens.encoded(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()}
        assert got == {r.doc_id: [*plain.encode(r.text, add_special_tokens=False).ids, 0] for r in docs.collect()}
    elif query == "op5":
        path = public_tokenizers.path("piece_bpe_32k.model")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert {r.doc_id: (r.ids, r.exact) for r in pieces.encode_pieces(docs, path).collect()} == {r.doc_id: (model.encode(r.text), True) for r in docs.collect()}
    else:
        assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 3}


@pytest.mark.parametrize("hashed", [lambda d, a, b: (b - a).astype(np.uint64) | np.uint64(1), lambda d, a, b: np.full(len(a), 7, np.uint64)])
def test_words_of_one_hash_are_told_apart(monkeypatch, hashed):
    monkeypatch.setattr(pieces.Memory, "_hashed", staticmethod(hashed))
    memory = pieces.Memory(lambda words: [np.frombuffer(w.encode(), np.uint8).astype(np.int32) for w in words])
    text = b"one two six ten a bb one nine four two"
    data, start = np.frombuffer(text, np.uint8), np.array([0, *(k + 1 for k, c in enumerate(text) if c == 32)])
    for _ in range(2):
        ids, counts = memory.encode(data, np.array([0, 12, len(text)]), start)
        assert bytes(ids.astype(np.uint8)) == text and counts.tolist() == [12, len(text) - 12]
