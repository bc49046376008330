import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb2

from skygrid.llm import pieces
from skygrid.llm.common import joined_bytes

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b   c    d", " " * 40 + "x" + " " * 35, "日本語 text ñandú €uro 😀😀", "\n\n a\n b", "hello world" * 300, "   é", "x" * 2000, "tab\there\r\n", "<s> <0x41> </s> <unk>", "aaaaaaaaa bbbbbbbbb abababab", "don't  stop   ", "\x00\x01"]


def noise(n=400, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(["a", "b", "the", "ing", " ", "  ", "er", "é", "日", "\n", "1", "ab", "st", "ion"], k=rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_librarys(spark):
    texts = ODD + noise()
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(9000, None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, exact string")
    encoded = pieces.encode_pieces(docs, PATH)
    got = {r.doc_id: r for r in encoded.collect()}
    want = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(texts)
    for i, ids in enumerate(want):
        assert got[i].ids == ids and got[i].n_tokens == len(ids) and got[i].exact, repr(texts[i])
    assert got[9000].ids == []
    back = {r.doc_id: r.text for r in pieces.decode_pieces(encoded, PATH).collect()}
    assert all(back[i] == t for i, t in enumerate(texts)) and back[9000] == ""
    assert pieces.encode_pieces(docs.where("false"), PATH).count() == 0


def test_blank_marks_in_texts():
    codec, plain = pieces.Codec(pieces.load(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("a▁b ▁▁ c", "▁", "▁x"):
        ids, _ = codec.encode(*joined_bytes(pa.array([text])))
        assert ids.tolist() == plain.encode(text)


def test_best_sum_of_scores(tmp_path):
    """A unigram model, against the library and against all segmentations."""
    proto = pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    rng = random.Random(3)
    keep = [p for p in proto.pieces if p.type != 1] + [p for p in proto.pieces if p.type == 1 and (len(p.piece) == 1 or p.piece.strip("▁").isascii()) and set(p.piece) != {"▁"}]
    keep.append(pb2.ModelProto.SentencePiece(piece="▁", score=-9.0, type=1))
    for p in keep:
        p.score = -rng.uniform(3, 12) - (4 if len(p.piece) == 1 else 0)
    del proto.pieces[:]
    names = set()
    for p in keep:
        if p.piece not in names:
            names.add(p.piece)
            proto.pieces.append(p)
    proto.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    codec, plain = pieces.Codec(pieces.load(str(path))), sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = [t for t in noise(200, 2) if t.isascii() and "\n" not in t]
    ids, counts = codec.encode(*joined_bytes(pa.array(texts)))
    ends = np.concatenate([[0], np.cumsum(counts)])
    score = {i: p.score for i, p in enumerate(proto.pieces)}
    for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        best = plain.encode(t)
        assert sum(score[i] for i in ids[a:b].tolist()) == pytest.approx(sum(score[i] for i in best), abs=1e-3), repr(t)


def test_other_models_raise(tmp_path):
    proto = pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        pieces.load(str(tmp_path / "m"))


def test_memory_is_bounded_and_grows():
    seen = []
    memory = pieces.Memory(lambda words: seen.extend(words) or [[len(w)] for w in words], most=3)
    texts = ["aa b", "ccc dddd", "b e ff", "aa b"]
    for t in texts * 2:
        data = np.frombuffer(t.encode(), np.uint8)
        start = np.array([0, *[i for i, c in enumerate(t) if c == " "]])
        ids, counts = memory.encode(data, np.array([0, len(data)]), start)
        assert ids.tolist() == np.diff([*start, len(t)]).tolist() and counts.tolist() == [len(start)]
    assert len(seen) > len(set(seen)) and len(memory.begin) <= 6


def long_words():
    rng = random.Random(5)
    han = "".join(rng.choices("的一是在不了有和人这中大为上个国我以要他", k=30_000))
    digits = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=1_000_000))
    periods = ["x" * 30_000, "ab" * 9_000, "abc" * 5_000 + "x" * 5_000, "=" * 4_001, "the" * 3_000, "ＡＢ" * 3_000, "日" * 5_000, "é" * 2_049, "aaaaaaaaaaa-" * 700]
    joined = "".join(rng.choices(["the", "ing", "station", "tion", "er", "é", "日本", "€", "😀", "xx", "===="], k=9_000))
    return [han, digits, *periods, joined, "a " + joined[:3_000] + "  b " + "x" * 3_000 + "\n" + joined[:2_500]]


def test_long_texts_without_blanks():
    """A million characters in one word, words with periods, and scripts without blanks: the library's ids, in linear time."""
    codec, plain = pieces.Codec(pieces.load(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in long_words():
        began = time.process_time()
        ids, _ = codec.encode(*joined_bytes(pa.array([text])))
        assert ids.tolist() == plain.encode(text), (text[:20], len(text))
        assert time.process_time() - began < 5 + len(text) / 50_000


def test_windows_that_share_no_piece(monkeypatch):
    """Steps that no period divides, so that windows have to move."""
    monkeypatch.setattr(pieces, "STEP", 701)
    codec, plain = pieces.Codec(pieces.load(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in [t for t in long_words() if len(t) < 31_000]:
        assert codec.encode(*joined_bytes(pa.array([text])))[0].tolist() == plain.encode(text)


def test_repeated_rows_and_clashing_names(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [(1, "some words, again", 5, "x")] * 3 + [(1, "other words", 5, "x"), (None, "some words, again", 5, "y")]
    got = pieces.encode_pieces(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").repartition(3), path)
    plain = sentencepiece.SentencePieceProcessor(model_file=path)
    assert got.columns == ["doc_id", "n_tokens", "ids", "exact"]
    assert sorted((r.doc_id or 0, r.ids, r.exact) for r in got.collect()) == sorted((i or 0, plain.encode(t), True) for i, t, *_ in rows)
