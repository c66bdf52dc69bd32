"""Registered queries ``opN_<name>``: each applies one operator, with production parameters, to
its whole table and derives the contract's columns; ``ORACLE`` has DuckDB SQL where it can say it."""
from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from . import (ann, chat, decontaminate, encode, fim, html_extract, langid, simhash, substring, token_counts, toxicity,
               warc, whitening)
from .common import documents, work_path

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def op1_html_extraction(spark, sf_dir):
    return html_extract.main_text(html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op2_toxicity(spark, sf_dir):
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_bpe_encoding(spark, sf_dir):
    return encode.digests(documents(spark, sf_dir), public_tokenizers.path(RANKS))


def op4_substring_dedup(spark, sf_dir):
    return substring.digests(substring.dedup_substrings(documents(spark, sf_dir)))


def op5_nearest_neighbours(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.nearest(rows, rows.filter("vec_id % 20 = 0"), top=20)


def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), limit=512)


def op7_chat_format(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    one = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(tricky).alias("text"))
    added = one.select("conv_id", F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"), "text")
    return chat.read_chat(chat.format_chat(turns.unionByName(added), public_tokenizers.path(TOKENIZER))).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op8_benchmark_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.report(decontaminate.contamination(documents(spark, sf_dir), benchmark))


def op9_simhash(spark, sf_dir):
    return simhash.simhash_components(documents(spark, sf_dir))


def op10_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.read_back(warc.read_warc(spark, warc.write_warc(pages, work_path(spark, "warc"))))


def op11_language_id(spark, sf_dir):
    return langid.languages(documents(spark, sf_dir))


def op12_fill_in_middle(spark, sf_dir):
    return fim.digests(documents(spark, sf_dir))


def op13_whitening(spark, sf_dir):
    return whitening.components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_toxicity, op3_bpe_encoding, op4_substring_dedup, op5_nearest_neighbours, op6_token_counts,
    op7_chat_format, op8_benchmark_decontamination, op9_simhash, op10_warc, op11_language_id, op12_fill_in_middle,
    op13_whitening)}

ORACLE = {
    "op4_substring_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, p, array_to_string(w[p:p + 34], ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS p FROM d WHERE len(w) >= 35)),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, x FROM (SELECT r, unnest(generate_series(p, p + 34)) AS x FROM win SEMI JOIN again USING (s))),
every AS (SELECT r, unnest(w) AS v, unnest(generate_series(1, len(w))) AS x FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(v, ' ' ORDER BY x) AS t FROM every ANTI JOIN gone USING (r, x) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)""",
    "op7_chat_format": r"""
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
u AS (SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
        + length('<|turn|><|text|><|end|>') + 1 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id""",
    "op8_benchmark_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT r, p, dw.n, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
hit AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS x FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)""",
    "op10_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f""",
    "op12_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (
  SELECT doc_id, t, n, CAST('0x' || substring(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substring(h, 9, 8) AS BIGINT) % (n + 1) AS y,
    CAST('0x' || substring(h, 17, 8) AS BIGINT) % 100 AS rate, CAST('0x' || substring(h, 25, 8) AS BIGINT) % 100 AS spm FROM d),
f AS (
  SELECT *, least(x, y) AS a, greatest(x, y) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR rate >= 90 THEN 'plain'
      WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
c AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c""",
}
