import os
import random

import sentencepiece
import pytest
from brute import mixed, near_duplicates, repeats
from conftest import cells

import corpus_pipeline
from skygrid.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    assert cells(queries.QUERIES[name](spark, sf_dir).toPandas()) == cells(duck.sql(queries.ORACLES[name]).df())


def test_near_duplicates_of_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op6_super_minhash"](spark, sf_dir).collect()}
    assert got == near_duplicates(rows)


def test_held_out_accuracy_of_documents(spark, sf_dir):
    found = queries.QUERIES["op3_kneser_ney"](spark, sf_dir).where("held_out")
    both = found.join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(both) > 30 and (both.lang == both.lang_pred).mean() > 0.97


def test_every_query_has_one_stable_name():
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, len(queries.QUERIES) + 1))


def test_pipeline_against_brute_force(spark, sf_dir):
    """Every stage after the first by plain rules, on what the stage before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "repeated_passages", "mixing", "sentence_pieces"]
    known = stages["language_id"](spark, docs, sf_dir)
    assert known.columns == docs.columns
    rows = {r.doc_id: r for r in known.collect()}
    assert len(rows) >= 0.99 * docs.count()
    kept = near_duplicates([(i, r.text) for i, r in rows.items()], percent=80)
    rows = {i: r for i, r in rows.items() if kept[i][1] == i}
    cut = {i: x[3].decode("utf-8", "ignore") for i, x in repeats([(i, r.text) for i, r in rows.items()]).items()}
    model = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for i, size, _, _, taken in mixed([(i, cut[i], rows[i].source) for i in rows]):
        copies = (2 * taken + size) // (2 * size) if size else 0
        ids = model.encode(cut[i]) if copies else []
        want += [(i, len(ids), ids, True)] * copies
    got = sorted((r.doc_id, r.n_tokens, r.ids, r.exact) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == sorted(want)


def test_language_stage_rejects_planted_junk(spark, sf_dir):
    """Random letters, another script and letterless texts (unlabelled, so not learned from) among the documents go; nearly all documents stay."""
    docs = spark.read.parquet(f"{os.path.dirname(sf_dir)}/sf0.1/documents.parquet")
    rng = random.Random(1)
    junk = ["".join(rng.choices("bcdfghjklmnpqrstvwxz  ", k=rng.randint(200, 900))) for _ in range(20)] + ["Съешь же ещё этих мягких французских булок. " * 4, "1234 5678 -- ..", "", None]
    rows = [(10_000_000 + i, t, None, "src0", len(t or "")) for i, t in enumerate(junk)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, both, sf_dir).collect()}
    assert not [i for i in kept if i >= 10_000_000] and len(kept) >= 0.99 * docs.count()


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls everywhere, repeated rows and no rows: each stage gives the columns of its input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (2, "a", "en", "s", 1), (2, "a", "en", "s", 1), (None, "some words of a text", None, None, None)], docs.schema)
    for df in (docs.unionByName(odd), docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, sf_dir)
            found = out.collect()
            if name == "sentence_pieces":
                assert out.columns == ["doc_id", "n_tokens", "ids", "exact"] and all(r.exact for r in found)
            else:
                assert out.columns == df.columns
            if name == "sentence_pieces" or name == "repeated_passages":
                assert len(found) == df.count()
