"""Registered queries of the corpus operators and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from staylytics.llm import block_topk, chat, html_extract, license_scan, mixing, multi_pattern, ngram_join, packing, quality, token_align, turn_repair, url_filter, vptree

URL_RULES = [
    url_filter.Rule("com", "/", "allow"), url_filter.Rule("example.com", "/en/", "block"), url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"), url_filter.Rule("net", "/fr/", "block"),
]
TOKENIZERS = "/opt/tokenizers"  # folder of the public vocabulary files, read on the driver
TRICKY = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_vptree(spark: SparkSession, root: str) -> DataFrame:
    return vptree.nearest(_table(spark, root, "embeddings"), one_per_id=False)


def op2_block_topk(spark: SparkSession, root: str) -> DataFrame:
    return block_topk.top_k(_table(spark, root, "embeddings"), one_per_id=False)


def op3_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return url_filter.judge(_table(spark, root, "pages"), URL_RULES)


def op4_ngram_join(spark: SparkSession, root: str) -> DataFrame:
    return ngram_join.ngram_components(_table(spark, root, "documents"))


def op5_source_mix(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix_report(_table(spark, root, "documents"))


def op6_chat(spark: SparkSession, root: str) -> DataFrame:
    rows = _table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], rows.schema)
    return chat.digest(chat.format_trees(chat.thread_nodes(rows.union(extra))))


def op7_license_scan(spark: SparkSession, root: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, root, "documents"))


def op8_html_extract(spark: SparkSession, root: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, root, "pages"))


def op9_quality(spark: SparkSession, root: str) -> DataFrame:
    return quality.classify(_table(spark, root, "documents"), _table(spark, root, "labels"))


def op10_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(_table(spark, root, "documents"))


def op11_token_align(spark: SparkSession, root: str) -> DataFrame:
    files = token_align.Files.read(f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return token_align.link_report(_table(spark, root, "documents"), files)


def op12_turn_repair(spark: SparkSession, root: str) -> DataFrame:
    return turn_repair.repair_report(turn_repair.damage(_table(spark, root, "conversations")))


def op13_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return multi_pattern.leak_report(_table(spark, root, "documents"), _table(spark, root, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vptree": op1_vptree,
    "op2_block_topk": op2_block_topk,
    "op3_url_filter": op3_url_filter,
    "op4_ngram_join": op4_ngram_join,
    "op5_source_mix": op5_source_mix,
    "op6_chat": op6_chat,
    "op7_license_scan": op7_license_scan,
    "op8_html_extract": op8_html_extract,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_token_align": op11_token_align,
    "op12_turn_repair": op12_turn_repair,
    "op13_decontaminate": op13_decontaminate,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {}

ORACLES["op5_source_mix"] = r"""
WITH rows AS (
    SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
weighed AS (
    SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
           [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM totals),
budget AS (SELECT CAST(sum(source_size) AS DOUBLE) * 1.5::DOUBLE AS b FROM weighed),
filled AS (
    SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
           sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w FROM weighed),
rates AS (SELECT max((b - used) / open_w) AS rate FROM filled, budget WHERE (b - used) / open_w * w <= cap),
targets AS (SELECT source, source_size, CASE WHEN w * rate > cap THEN cap ELSE w * rate END AS target FROM weighed, rates),
queued AS (
    SELECT r.*, source_size, target, sum(size) OVER (PARTITION BY r.source ORDER BY place) AS upto, sum(size) OVER (PARTITION BY r.source, place) AS own
    FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (CAST(upto - own / 2 <= target AS INTEGER) + CAST(upto - own / 2 + source_size <= target AS INTEGER)) AS BIGINT) AS taken
FROM queued
"""

ORACLES["op2_block_topk"] = """
WITH parts AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
terms AS (SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM parts),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.v * d.v) AS BIGINT) AS score
    FROM terms q JOIN terms d USING (i) WHERE q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id GROUP BY q.vec_id, d.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES["op6_chat"] = r"""
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
coded AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           replace(replace(replace(coalesce(text, ''), chr(92), chr(92) || 'b'), '###', repeat(chr(92) || 'h', 3)), '</turn>', chr(92) || 'l/turn>') AS body
    FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM coded GROUP BY conv_id
"""

ORACLES["op4_ngram_join"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingled AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingled a JOIN shingled b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents LEFT JOIN sizes USING (doc_id) JOIN least ON a = doc_id
"""

ORACLES["op13_decontaminate"] = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
places AS (
    SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
met AS (SELECT r, p.k, i, item_id FROM places p JOIN windows USING (k, g)),
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM met)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

# crc32 byte by byte: 8 steps of the reflected polynomial 0xEDB88320
ORACLES["op12_turn_repair"] = r"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
bits AS (SELECT DISTINCT name, list_transform(range(1, len(name) + 1), lambda i: ascii(name[i])) AS codes FROM named),
hashed AS (
    SELECT name, xor(list_reduce(codes, lambda c, b: list_reduce(range(0, 9),
               lambda v, k: CASE WHEN k = 0 THEN v WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(c, b)), 4294967295), 4294967295) % 20 AS kind
    FROM (SELECT name, list_transform(codes, lambda x: CAST(x AS BIGINT)) AS codes FROM bits)),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM named JOIN hashed USING (name) WHERE kind <> 0),
placed AS (
    SELECT coalesce(conv_id, -9223372036854775807) AS c, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM damaged),
faulty AS (
    SELECT c, turn, role, text, i, left(role, 1) AS r, bare = '' AS blank, bare <> '' AND again AS duplicate,
           bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
           lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
begins(mid_from, ins, mid, said) AS (VALUES
    (0, '', 0, ''), (1, '', 1, ''), (2, '', 2, ''), (3, '', 3, ''),
    (0, 'I', 2, 'user:' || chr(10)), (1, 'I', 2, 'user:' || chr(10)), (2, 'I', 3, 'assistant:' || chr(10)), (3, 'I', 2, 'user:' || chr(10))),
edits(mid, edit, state) AS (VALUES
    (0, 'D', 0), (1, 'D', 1), (2, 'D', 2), (3, 'D', 3), (0, 'R', 2), (1, 'R', 2), (2, 'R', 3), (3, 'R', 2),
    (0, 'S', 1), (0, 'K', 2), (1, 'K', 2), (2, 'K', 3), (3, 'K', 2)),
walk(c, i, state, cost, audit, said) AS (
    SELECT DISTINCT c, CAST(0 AS BIGINT), 0, 0, '', '' FROM faulty
    UNION ALL
    SELECT c, i, state, cost, audit, said FROM (
        SELECT w.c, f.i, e.state, w.cost + 5 * length(b.ins) + CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN f.truncated AND e.edit <> 'D' THEN 5 ELSE 0 END AS cost,
               w.audit || b.ins || CASE e.edit WHEN 'S' THEN 'K' ELSE e.edit END AS audit,
               w.said || b.said || CASE e.edit WHEN 'D' THEN '' WHEN 'R' THEN CASE e.state WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || f.text || chr(10)
                                   ELSE f.role || ':' || f.text || chr(10) END AS said,
               row_number() OVER (PARTITION BY w.c, e.state ORDER BY w.cost + 5 * length(b.ins) + CASE e.edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                   + CASE WHEN f.truncated AND e.edit <> 'D' THEN 5 ELSE 0 END, w.audit || b.ins || CASE e.edit WHEN 'S' THEN 'K' ELSE e.edit END) AS place
        FROM walk w JOIN faulty f ON f.c = w.c AND f.i = w.i + 1 JOIN begins b ON b.mid_from = w.state JOIN edits e ON e.mid = b.mid
        WHERE e.edit = 'D' OR NOT f.blank AND NOT f.duplicate AND (e.edit = 'R' OR e.edit = 'S' AND f.r = 's'
              OR e.edit = 'K' AND f.r = CASE e.state WHEN 2 THEN 'u' ELSE 'a' END)) WHERE place = 1),
ends(state, ins, said) AS (VALUES (0, '', ''), (3, '', ''), (2, 'I', 'assistant:' || chr(10)), (1, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
finished AS (
    SELECT w.c, w.cost + 5 * length(e.ins) AS cost, w.audit || e.ins AS audit, w.said || e.said AS said,
           row_number() OVER (PARTITION BY w.c ORDER BY w.cost + 5 * length(e.ins), w.audit || e.ins) AS place
    FROM walk w JOIN ends e USING (state) WHERE w.i = (SELECT max(i) FROM faulty f WHERE f.c = w.c)),
counted AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
           count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM faulty GROUP BY c)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(left(said, greatest(length(said) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted k ON k.c = coalesce(o.conv_id, -9223372036854775807)
LEFT JOIN finished f ON f.c = k.c AND place = 1
"""
