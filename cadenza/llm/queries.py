"""Registered queries of the training-data operators, with SQL where SQL can say it."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cadenza.llm import (decontam, exact_dedup, fill_in_middle, language, merkle, ngram_join, personal_data, pieces, prefix_trie,
                         pseudo_likelihood, sharding, substring_dedup, token_counts, viterbi)
from cadenza.llm.common import read_table
from cadenza.session import write_and_read

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: A model file for the tokeniser queries; the installed public one unless the variable names another.
MODEL_VARIABLE, MODEL_FILE = "CADENZA_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def model_path() -> str:
    return os.environ.get(MODEL_VARIABLE, MODEL_FILE)


# ---- 1: two replicas of the pages' records, the second with records lost, cut and overwritten ----

_RECORD = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
  || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), 'none') || '>' || chr(13) || chr(10)
  || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
  || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10)
  || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"""


@query("op1_merkle_audit", f"""
WITH records AS (
  SELECT CAST(CAST(floor(page_id / 1000.0) AS BIGINT) AS VARCHAR) AS file, page_id, {_RECORD} AS record FROM pages),
contents AS (
  SELECT file, page_id, strlen(record) AS length,
         CASE WHEN length(record) % 64 = 3 THEN NULL ELSE sha256(record) END AS a,
         CASE length(record) % 64 WHEN 0 THEN sha256(substr(record, 1, length(record) - 1) || '!')
              WHEN 1 THEN sha256(substr(record, 1, length(record) // 2)) WHEN 2 THEN NULL ELSE sha256(record) END AS b
  FROM records),
placed AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id, coalesce(a, b)
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM contents),
digests AS (
  SELECT *, sha256(file || ':' || CAST(place AS VARCHAR) || ':' || CAST(length AS VARCHAR) || '|' || a) AS l,
         sha256(file || ':' || CAST(place AS VARCHAR) || ':' || CAST(length AS VARCHAR) || '|' || b) AS r FROM placed)
SELECT file, CAST(place AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length, page_id,
       CASE WHEN r IS NULL THEN 'missing' WHEN l IS NULL THEN 'extra' ELSE 'changed' END AS kind,
       l AS left_digest, r AS right_digest
FROM digests WHERE l IS DISTINCT FROM r""")
def merkle_audit(spark, sf_dir):
    """Where the second replica differs: its damage follows from the records' lengths, over all pages."""
    record, size = F.col("record"), F.length("record")
    turn = size % 64
    damaged = (F.when(turn == 0, F.concat(F.substring(record, F.lit(1), size - 1), F.lit("!")))
               .when(turn == 1, F.substring(record, F.lit(1), F.floor(size / 2).cast("int")))
               .when(turn == 2, F.lit(None).cast("string")).otherwise(record))
    both = merkle.warc_records(read_table(spark, sf_dir, "pages")).select(
        "file", "page_id", "length", F.when(turn != 3, merkle.content(record)).alias("a"),
        merkle.content(damaged).alias("b"))
    placed = write_and_read(merkle.with_offsets(both, [F.col("page_id"), F.coalesce("a", "b")]), "op1-placed")
    left, right = (placed.withColumn("content", F.col(side)) for side in "ab")
    return merkle.audit(left, right)


@query("op2_token_counts")
def count_tokens(spark, sf_dir):
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), pieces.load(spark, model_path()))


@query("op3_pseudo_likelihood")
def masked_scores(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


@query("op4_ngram_join", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
smallest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest ON x = d.doc_id""")
def similar_documents(spark, sf_dir):
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


@query("op5_block_names", r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM texts""")
def equal_documents(spark, sf_dir):
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


@query("op6_byte_network")
def languages(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op7_wu_manber", r"""
WITH doc_words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM documents),
item_words AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.s = b.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.l, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words h USING (doc_id) LEFT JOIN items m USING (doc_id)""")
def benchmark_hits(spark, sf_dir):
    return decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op8_fm_index", r"""
WITH words AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT s, min(doc_id) AS least FROM windows GROUP BY s) USING (s) WHERE least < doc_id),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM repeated),
placed AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM placed LEFT JOIN (SELECT *, true AS gone FROM removed) USING (doc_id, p)
  WHERE gone IS NULL GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM removed GROUP BY doc_id) USING (doc_id)""")
def repeated_words(spark, sf_dir):
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


@query("op9_skip_chain")
def personal_spans(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return personal_data.personal_data(docs, personal_data.fit(docs))


@query("op10_batched_viterbi")
def tokenised(spark, sf_dir):
    return viterbi.round_trip(read_table(spark, sf_dir, "documents"), pieces.load(spark, model_path()))


@query("op11_fill_in_middle", r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM texts),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts""")
def filled_in_middle(spark, sf_dir):
    found = fill_in_middle.transform(read_table(spark, sf_dir, "documents"))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                        F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


@query("op12_minimax_shards")
def shards(spark, sf_dir):
    placed = sharding.assign(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


# crc32 bit by bit over the bytes of the decimal id
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
    lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS BIGINT), 1)) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
  4294967295::BIGINT)"""


@query("op13_prefix_trie", rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, p, r, t FROM convs c JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
  UNION ALL SELECT conv_id, 1, p, r, t FROM convs JOIN turns USING (conv_id) WHERE p > h),
placed AS (
  SELECT conv_id, sha256(r) || sha256(t) AS x, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d,
         len([y FOR y IN regexp_split_to_array(t, '[ 	-
]+') IF y <> '']) AS w FROM rebuilt),
lists AS (
  SELECT c.conv_id, coalesce(l, []) AS l, coalesce(w, []) AS w FROM convs c LEFT JOIN (
    SELECT conv_id, list(x ORDER BY d) AS l, list(w ORDER BY d) AS w FROM placed GROUP BY conv_id) USING (conv_id)),
members AS (
  SELECT conv_id, d, len(l) AS n, sha256(array_to_string(l[1:d], '')) AS v, CASE WHEN d = 0 THEN 0 ELSE w[d] END AS w,
         CASE WHEN d > 0 THEN sha256(array_to_string(l[1:d - 1], '')) END AS parent
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM lists)),
nodes AS (
  SELECT v, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w, any_value(parent) AS parent,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends FROM members GROUP BY v),
children AS (SELECT parent AS v, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
pairs AS (SELECT DISTINCT a.v AS v, b.v AS u FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (
  SELECT p.v, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * w) AS saved_tokens
  FROM pairs p JOIN nodes n ON n.v = u LEFT JOIN children c ON c.v = u GROUP BY p.v)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums s ON s.v = n.v LEFT JOIN children c ON c.v = n.v LEFT JOIN nodes p ON p.v = n.parent""")
def conversation_trie(spark, sf_dir):
    ids, turns = prefix_trie.with_shared_starts(prefix_trie.ordered_turns(read_table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(ids, turns).drop("words")


def load_all():
    """All queries with the pipeline, whose module lies at the repository's top."""
    import corpus_pipeline

    QUERIES.setdefault("pipeline", corpus_pipeline.run)
    if corpus_pipeline.ORACLE_SQL:
        SQL.setdefault("pipeline", corpus_pipeline.ORACLE_SQL)
    return QUERIES, SQL
