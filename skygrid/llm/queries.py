"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, fixity, langid, media, middle, minhash, mixing, pieces, secrets, sharding, spelling, suffixes, tokens
from .common import shared_dir, table, text_bytes

#: Bytes of text that a shard may hold.
SHARD_BYTES = 1 << 20
#: Weights repeat over the sources; the mix has this share of all words.
MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 1, 2), 1.5, 2, 0


def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = sharding.extendible_shards(table(spark, sf_dir, "documents"), ["doc_id"], text_bytes(), SHARD_BYTES, tie_cols=["text"])
    return rows


OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes, 
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 9, 7))::BIGINT AS bits FROM documents),
p AS (SELECT d.*, l.level::INTEGER AS level, bits >> (60 - l.level)::INTEGER AS prefix FROM d, generate_series(0, 60) AS l(level)),
s AS (SELECT level, prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_rows FROM p GROUP BY ALL),
f AS (SELECT p.doc_id, p.n_bytes, p.level, p.prefix, s.shard_bytes, s.shard_rows FROM p JOIN s USING (level, prefix) WHERE s.shard_bytes <= {SHARD_BYTES} OR s.shard_rows = 1
      QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY level) = 1)
SELECT doc_id, n_bytes, CASE WHEN level = 0 THEN '' ELSE lpad(bin(prefix), level, '0') END AS shard, level AS depth, shard_bytes, shard_rows, shard_bytes > {SHARD_BYTES} AS oversized FROM f
"""


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def op2_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages against a replica with records changed, lost and added by a rule on the hash of page_id."""
    pages = table(spark, sf_dir, "pages")
    kind = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    damaged = pages.where(kind != "01").withColumn("html", F.when(kind == "00", F.concat("html", F.lit("!"))).otherwise(F.col("html")))
    extra = pages.where(kind == "02").withColumn("page_id", -F.col("page_id") - 1)
    return fixity.fixity_audit(pages, damaged.unionByName(extra), "page_id", ["url", "html"]).select(F.col("offset").alias("page_id"), "status")


OP2_SQL = """
WITH k AS (SELECT page_id, url, html, substr(md5(page_id::VARCHAR), 1, 2) AS kind FROM pages),
r AS (SELECT page_id, url, CASE WHEN kind = '00' THEN html || '!' ELSE html END AS html FROM k WHERE kind <> '01' UNION ALL SELECT -page_id - 1, url, html FROM k WHERE kind = '02')
SELECT coalesce(k.page_id, r.page_id) AS page_id, CASE WHEN r.page_id IS NULL THEN 'missing' WHEN k.page_id IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM k FULL JOIN r ON k.page_id = r.page_id WHERE k.page_id IS NULL OR r.page_id IS NULL OR k.html IS DISTINCT FROM r.html OR k.url IS DISTINCT FROM r.url
"""


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_token_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, encoding="delta")
    return tokens.token_digest(tokens.read_tokens(spark, path))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=5, bands=20, rows=4)


def op7_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP8_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, md5('{MIX_SEED}:' || doc_id) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 AS k FROM d GROUP BY source),
w AS (SELECT source, source_size, [{", ".join(f"{x}.0" for x in MIX_WEIGHTS)}][k + 1]::DOUBLE AS weight, source_size * {MIX_EPOCHS}::DOUBLE AS cap FROM s),
fill AS (
  SELECT 0 AS step, source, source_size, weight, cap, false AS stopped, (SELECT sum(source_size) * {MIX_SHARE}::DOUBLE FROM w) AS goal FROM w
  UNION ALL
  SELECT * FROM (
    SELECT step + 1 AS step, source, source_size, weight, cap,
      stopped OR cap <= (goal - coalesce(sum(CASE WHEN stopped THEN cap END) OVER (), 0)) * weight / sum(CASE WHEN NOT stopped THEN weight END) OVER () AS stopped, goal
    FROM fill) WHERE step <= (SELECT count(*) FROM w)),
t AS (SELECT source, source_size, CASE WHEN stopped THEN cap ELSE (goal - coalesce(sum(CASE WHEN stopped THEN cap END) OVER (), 0)) * weight / sum(CASE WHEN NOT stopped THEN weight END) OVER () END AS target
  FROM fill WHERE step = (SELECT max(step) FROM fill)),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS whole, floor(target)::BIGINT AS goal FROM t),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, g.goal - g.whole * g.source_size AS extra,
  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, extra - before)))::BIGINT AS taken FROM r
"""

def op9_chroma_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation as a recording; clip is conv_id * 2**20 + turn."""
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * (1 << 20) + F.col("turn")).alias("clip"), "text")
    heard = media.sonified(turns, "clip", "text")
    return media.aligned(heard, "id", "media").withColumnRenamed("id", "clip")


def op10_prefix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats_cut(table(spark, sf_dir, "documents"), width=50)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, sf_dir, "documents"), seed="1", plain_percent=10, spm_percent=20)
    text = middle.restored(F.col("form"), F.col("output"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (SELECT doc_id, text, t, len(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT doc_id, text, n, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m, array_to_string(t[b + 1:], '') AS s,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM k))
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.counted(spelling.runs(table(spark, sf_dir, "documents"), least_length=7, drop_every=31), least_count=2)
    return spelling.spelling_groups(words, least_length=7, ratio=10)


#: crc32 by its table of 256 remainders, which the polynomial gives; near words by deleted characters.
OP12_SQL = r"""
WITH RECURSIVE t AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
o AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id || ':' || w, ''))) AS x FROM r GROUP BY ALL),
h AS (SELECT w, n, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) END AS h FROM o, t),
m AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM m WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT d.word, d.n, v.word, v.n FROM d JOIN v ON d.less = v.word UNION SELECT v.word, v.n, d.word, d.n FROM d JOIN v ON d.less = v.word),
b AS (SELECT word, n, count(*)::BIGINT AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n)::BIGINT AS form_n FROM p GROUP BY word, n),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * v.n THEN form END AS form, CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n FROM v LEFT JOIN b USING (word)),
c AS (SELECT word, word AS root FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL),
z AS (SELECT c.word, c.root FROM c JOIN f ON c.root = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN z ON f.word = z.word
"""


def op13_secret_grammars(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), sample=4000)
    base = F.filter("spans", lambda s: s["base"])
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(secrets.span_list(base), 256).alias("base_sha256"), secrets.span_list(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extendible_sharding": op1_extendible_sharding,
    "op2_fixity_audit": op2_fixity_audit,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_token_lists": op4_token_lists,
    "op5_sentence_pieces": op5_sentence_pieces,
    "op6_super_minhash": op6_super_minhash,
    "op7_adaptive_scan": op7_adaptive_scan,
    "op8_source_mixing": op8_source_mixing,
    "op9_chroma_prints": op9_chroma_prints,
    "op10_prefix_intervals": op10_prefix_intervals,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_secret_grammars": op13_secret_grammars,
}

ORACLES: dict[str, str] = {
    "op1_extendible_sharding": OP1_SQL,
    "op2_fixity_audit": OP2_SQL,
    "op8_source_mixing": OP8_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
}
