"""Registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundlens.llm import (decontamination, exact_dedup, fill_middle, html_text, huffman, lbl, ngram_join, packing, quality, suffix_dedup,
                          toxicity, vector_codes, warc)
from fundlens.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """A vocabulary file of the installed public tokenizers (a path on every machine)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "copy_id", "n_links")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.token_round_trip(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")) \
        .select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                  with_ids=False) \
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score_texts(read_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


_OP2_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, payload, sha1(payload) AS h, octet_length(encode(payload)) AS n,
         max(page_id) OVER (PARTITION BY payload) AS keep
  FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER)
              >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM d
"""

_OP3_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

_OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), e AS (
  SELECT x, y, k = p.n AND k = q.n AS same
  FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 5 * k >= 4 * (p.n + q.n - k)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN e ON e.x = r.y
), class AS (
  SELECT x, min(y) AS class_id FROM reach GROUP BY x
), links AS (
  SELECT x, count(*) AS n_links, min(CASE WHEN same THEN y END) AS other FROM e GROUP BY x
)
SELECT d.doc_id, class_id, least(d.doc_id, coalesce(other, d.doc_id)) AS copy_id, coalesce(n_links, 0) AS n_links
FROM documents d JOIN class ON class.x = d.doc_id LEFT JOIN links ON links.x = d.doc_id
"""


_OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h,
         CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
  FROM documents
), b AS (
  SELECT r, j, n, substr(h, CAST(2 * j + 1 AS BIGINT), 1598) AS h FROM (SELECT r, h, n, unnest(range(0, n - 399, 400)) AS j FROM d WHERE n >= 400)
), w AS (
  SELECT r, j + i AS i, md5_number(substr(h, CAST(2 * i + 1 AS BIGINT), 800)) AS k
  FROM (SELECT r, j, h, unnest(range(least(400, n - 399 - j))) AS i FROM b)
), hit AS (
  SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)
), run AS (
  SELECT r, i, sum(CASE WHEN i <= before + 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM hit)
), span AS (
  SELECT r, min(i) AS a, max(i) + 400 AS z FROM run GROUP BY r, g
), gap AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS z, a FROM span
  UNION ALL SELECT d.r, coalesce(max(span.z), 0), d.n FROM d LEFT JOIN span ON span.r = d.r GROUP BY d.r, d.n
), kept AS (
  SELECT gap.r, string_agg(substr(h, CAST(2 * z + 1 AS BIGINT), CAST(2 * (a - z) AS BIGINT)), '' ORDER BY z) AS k
  FROM gap JOIN d ON d.r = gap.r GROUP BY gap.r
), s AS (
  SELECT r, sum(z - a) AS removed, count(*) AS spans FROM span GROUP BY r
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept ON kept.r = d.r LEFT JOIN s ON s.r = d.r
"""

_OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents
), e AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
         list_transform(range(4), lambda i: CAST('0x' || substr(h, CAST(8 * i + 1 AS BIGINT), 8) AS BIGINT)) AS r
  FROM d
), f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100
                 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         least(r[1] % (n + 1), r[2] % (n + 1)) AS lo, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS hi
  FROM e
), g AS (
  SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle,
         array_to_string(u[hi + 1:], '') AS suffix
  FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM g
"""


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of exhaustive search, one after another; a cell is (part, entry, position)."""
    def found(book: str) -> str:
        return f"""
  SELECT r, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM x JOIN {book} b ON b.p = x.p) GROUP BY r, p"""

    steps = [f"""
s{i} AS MATERIALIZED ({found(f"b{i}")}
), m{i} AS (
  SELECT p, e, i, CAST(sum(c) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
  FROM (SELECT x.p, s.e, unnest(x.v) AS c, unnest(range(len(x.v))) AS i FROM x JOIN s{i} s ON s.r = x.r AND s.p = x.p)
  GROUP BY p, e, i
), b{i + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM b{i} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM m{i} GROUP BY p, e) n ON n.p = b.p AND n.e = b.e
)""" for i in range(rounds)]
    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
         list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS HUGEINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), x AS MATERIALIZED (
  SELECT r, p, q[p * (len(q) // {parts}) + 1:(p + 1) * (len(q) // {parts})] AS v FROM k, range({parts}) t(p)
), b0 AS (
  SELECT p, r - 1 AS e, v FROM x WHERE r <= {entries}
), {",".join(steps)}, z AS MATERIALIZED ({found(f"b{rounds}")}
), h AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) AS sha
  FROM (SELECT p, e, unnest(v) AS c, unnest(range(len(v))) AS i FROM b{rounds})
), o AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM z GROUP BY r
)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha AS codebooks_sha256
FROM o JOIN k ON k.r = o.r, h
"""


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_warc": op2_warc,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_ngram_join": op4_ngram_join,
        "op5_toxicity": op5_toxicity,
        "op6_quality": op6_quality,
        "op7_huffman_ids": op7_huffman_ids,
        "op8_packing": op8_packing,
        "op9_html_text": op9_html_text,
        "op10_log_bilinear": op10_log_bilinear,
        "op11_suffix_dedup": op11_suffix_dedup,
        "op12_fill_middle": op12_fill_middle,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": _OP2_SQL,
        "op3_exact_dedup": _OP3_SQL,
        "op4_ngram_join": _OP4_SQL,
        "op11_suffix_dedup": _OP11_SQL,
        "op12_fill_middle": _OP12_SQL,
        "op13_vector_codes": _op13_sql(),
    }
