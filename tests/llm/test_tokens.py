import glob
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skygrid.llm import tokens
from skygrid.llm.common import joined_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "a", "a b", "a  b", "a \n b", "a\n\nb", "x  y", "x  y", "日本 語", "é à ñ", " lead", "trail ", "don't  stop\t\t!", "1 2 3", "<|endoftext|> a<|endoftext|> b", "a\r\nb", "😀 😀 x", "\u0085 z", "a\x1c b", "é\né", "l " * 3000, "x" * 5000, "Ünï cödé\n"]


def test_ids_are_the_tokenizers(spark):
    encoder, plain = tokens.Encoder(PATH, False), Tokenizer.from_file(PATH)
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.encode(*joined_bytes(pa.array(ODD)), 0)
        ends = np.concatenate([[0], np.cumsum(counts)])
        for text, a, b in zip(ODD, ends[:-1], ends[1:], strict=True):
            assert ids[a:b].tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 0], repr(text)
    plain.encode_special_tokens = True
    ids, _ = tokens.Encoder(PATH, True).encode(*joined_bytes(pa.array(["a <|endoftext|>"])), None)
    assert ids.tolist() == plain.encode("a <|endoftext|>", add_special_tokens=False).ids


@pytest.mark.parametrize("encoding", ["delta", "dictionary"])
def test_file_format_and_digest(spark, tmp_path, encoding):
    rows = [(7 * k % 101, ODD[k % len(ODD)], "x", 5) for k in range(101)] + [(3, "again", "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, n_tokens int").repartition(5)
    tokens.write_tokens(docs, f"file://{tmp_path}/t", PATH, encoding=encoding)
    table = tokens.read_tokens(spark, f"file://{tmp_path}/t")
    got = sorted(map(tuple, tokens.token_digest(table).collect()), key=lambda r: r[1])
    plain, start = Tokenizer.from_file(PATH), 0
    assert [r[0] for r in got] == sorted(r[0] for r in rows)
    for doc_id, at, n, crc in got:
        ids = {(*plain.encode(t or "", add_special_tokens=False).ids, 0) for i, t, _, _ in rows if i == doc_id}
        assert at == start and (n, crc) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids}
        start += n
    for f in glob.glob(f"{tmp_path}/t/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            ids = meta.row_group(g).column(4)
            assert ids.path_in_schema.startswith("ids") and ids.has_offset_index and meta.row_group(g).column(2).has_column_index
            assert ("DELTA_BINARY_PACKED" if encoding == "delta" else "RLE_DICTIONARY") in ids.encodings
    plan = table.where("doc_id = 5").select("n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5)]" in plan and "ids" not in plan.split("ReadSchema")[1]
    with pytest.raises(ValueError):
        tokens.write_tokens(docs, str(tmp_path / "u"), PATH, encoding="other")


def test_no_rows(spark, tmp_path):
    tokens.write_tokens(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/t", PATH)
    assert tokens.token_digest(tokens.read_tokens(spark, f"file://{tmp_path}/t")).count() == 0


def test_very_long_texts(spark):
    """Two million characters with and without blanks, next to short rows, in one partition."""
    texts = ["word " * 400_000, "abcdefghij" * 20_000, "x", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    plain = Tokenizer.from_file(PATH)
    got = {r.doc_id: r.ids for r in tokens.encoded(docs, PATH).collect()}
    assert got == {k: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
