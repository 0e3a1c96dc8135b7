"""The opN queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_text, jaccard_join, langid, line_dedup, pii_surrogates, rotated_codes, sentencepiece_agenda, simhash_decontam, suffix_dedup, token_pack
from .common import long_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    long_rows(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents, dropped from all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.drop_frequent_lines(docs, min_docs=10)
    return cut.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
"""


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank-order language predictions; learned from documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).alias("held_out")
    profiles = langid.train(docs.filter(~F.coalesce(held, F.lit(True))))
    return langid.predict(docs.select("doc_id", held, "text"), profiles, keep=["doc_id", "held_out"])


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with surrogates for personal data and secrets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_surrogates.with_surrogates(docs, key=b"virelay demonstration key")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingle sets have a similarity of 0.85 or more."""
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.jaccard_classes(docs, width=4, num=85, den=100).withColumnRenamed("id", "doc_id")


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]
                                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.c + b.c - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, m) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.m = e.x),
c AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n.c, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op5_simhash_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents, each with its best window."""
    return simhash_decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op6_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for each vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rotated_codes.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op7_token_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids in bit-packed files, read back as per-document digests."""
    docs = table(spark, sf_dir, "documents")
    _, manifest = token_pack.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_pack.token_digests(spark, manifest)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agenda-encoded pieces and the library's decoding of them, as digests."""
    docs = table(spark, sf_dir, "documents")
    found = sentencepiece_agenda.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)
    return found.withColumnRenamed("id", "doc_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that recur."""
    kept = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"), length=200, digest=True)
    return kept.withColumnsRenamed({"id": "doc_id", "kept": "kept_sha256"})


OP10_SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, b[i:i + 199] AS s FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d)),
c AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
h AS (SELECT doc_id, i FROM w SEMI JOIN c USING (s)),
g AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
      FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM h)),
sp AS (SELECT doc_id, min(i) AS a, max(i) + 199 AS z FROM g GROUP BY doc_id, k),
n AS (SELECT doc_id, sum(z - a + 1) AS removed, count(*) AS spans, max(z) AS z FROM sp GROUP BY doc_id),
kp AS (SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS x, a - 1 AS y FROM sp
       UNION ALL SELECT doc_id, coalesce(z, 0) + 1, octet_length(b) FROM d LEFT JOIN n USING (doc_id)),
kept AS (SELECT doc_id, string_agg(hex(CASE WHEN y >= x THEN b[x:y] ELSE ''::BLOB END), '' ORDER BY x) AS t FROM kp JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(t)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_text": op2_html_text,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_simhash_decontam": op5_simhash_decontam,
    "op6_rotated_codes": op6_rotated_codes,
    "op7_token_pack": op7_token_pack,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_langid": op9_langid,
    "op10_suffix_dedup": op10_suffix_dedup,
}

ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op4_jaccard_join": OP4_SQL, "op10_suffix_dedup": OP10_SQL}
