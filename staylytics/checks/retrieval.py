"""Checks for chunking, retrieval, context, caches and manifests."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylytics import constants as C
from staylytics.checks.marts import daily
from staylytics.checks.registry import query
from staylytics.checks.views import view
from staylytics.operators import chunking, inverted, marts
from staylytics.operators import retrieval as ops
from staylytics.plans import index
from staylytics.session import scratch_path, settle

_STRIP = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
view("squeezed", f"""
SELECT doc_id, source, lang, t, ceil(length(t) / 800)::INT AS n FROM (SELECT doc_id, source, lang, {_STRIP.format(c="regexp_replace(text, '[ \\t]+', ' ', 'g')")} AS t FROM documents)""")
view("fixed_chunks", """
SELECT doc_id, source, lang, chunk_index, substr(t, chunk_index * 800 + 1, 800) AS text FROM (
  SELECT doc_id, source, lang, t, unnest(range(n))::INT AS chunk_index FROM squeezed WHERE length(t) > 0)""")
view("overlapped_chunks", f"""
SELECT doc_id, source, lang, chunk_index, CASE WHEN chunk_index = 0 THEN text ELSE {_STRIP.format(c="right(lag(text) OVER (PARTITION BY doc_id ORDER BY chunk_index), 120) || ' ' || text")} END AS text
FROM fixed_chunks""")


def fixed_docs(lake, overlap=True):
    docs = lake.table("documents").select(
        "doc_id", F.create_map(F.lit("source"), F.col("source"), F.lit("branch_id"), F.col("lang")).alias("metadata"),
        chunking.squeeze(F.col("text")).alias("t"),
    ).withColumn("chunks", chunking.fixed_width(F.col("t")))
    return docs.withColumn("chunks", chunking.with_overlap(F.col("chunks"))) if overlap else docs


@query("R6_fixed_width_chunks", """
SELECT doc_id, chunk_index, length(text) AS n_chars, sha256(text) AS digest, source, chunk_index::VARCHAR AS position FROM fixed_chunks""")
def _(lake):
    rows = chunking.chunk_rows(fixed_docs(lake, overlap=False), "doc_id")
    return rows.select("doc_id", "chunk_index", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("digest"),
                       F.element_at("metadata", "source").alias("source"), F.element_at("metadata", "chunk_index").alias("position"))


@query("W13_chunk_overlap", "SELECT doc_id, chunk_index, length(text) AS n_chars, sha256(text) AS digest FROM overlapped_chunks")
def _(lake):
    rows = chunking.chunk_rows(fixed_docs(lake), "doc_id")
    return rows.select("doc_id", "chunk_index", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("digest"))


def recursive(lake):
    docs = index.documents(lake.table("documents"))
    return chunking.chunk_rows(chunking.chunk_text(docs, "text"), "path")


_PLAIN = "[ \\t\\n\\r.]"  # what a cut may drop: white space and the full stop of ". "


@query("R5_recursive_chunks", f"SELECT 'doc-' || doc_id AS path, sha256(regexp_replace(t, '{_PLAIN}', '', 'g')) AS digest, true AS fits FROM squeezed WHERE length(t) > 0")
def _(lake):
    cut = chunking.chunk_text(index.documents(lake.table("documents")), "text", overlap=0).where(F.size("chunks") > 0)
    kept = F.sha2(F.regexp_replace(F.array_join("chunks", ""), _PLAIN, ""), 256)
    return cut.select("path", kept.alias("digest"), F.forall("chunks", lambda c: F.length(c) <= C.CHUNK_SIZE).alias("fits"))


# Chunks of the table function: their places must hold them, cover the text but for separators, and be those of R5.
@query("D5_table_function_native", f"""
SELECT source, count(*) AS documents, sum(length(regexp_replace(t, '{_PLAIN}', '', 'g')))::BIGINT AS kept_chars, true AS placed, 0 AS differing
FROM squeezed WHERE length(t) > 0 GROUP BY 1""")
def _(lake):
    docs = lake.table("documents").select("doc_id", "source", chunking.squeeze(F.col("text")).alias("t"))
    found = settle(chunking.lateral_chunks(docs, "t").withColumn(
        "placed", F.expr("substring(t, begin + 1, end - begin) = chunk") & (F.col("end") - F.col("begin") <= C.CHUNK_SIZE)).drop("t"))
    other = chunking.by_separators(docs, "t").select("doc_id", F.posexplode("chunks").alias("chunk_index", "other"))
    both = found.join(other, ["doc_id", "chunk_index"], "full_outer")
    differing = both.agg(F.count_if(~F.col("chunk").eqNullSafe(F.col("other"))).cast("int")).scalar()
    return found.groupBy("source").agg(
        F.count_distinct("doc_id").alias("documents"), F.sum(F.length(F.regexp_replace("chunk", _PLAIN, ""))).alias("kept_chars"),
        F.bool_and("placed").alias("placed"),
    ).withColumn("differing", differing)


_H = r"<h[1-3][ >]"


@query("R1_heading_sections", rf"""
WITH p AS (SELECT page_id, list_filter(string_split(regexp_replace(html, '({_H})', chr(1) || '\1', 'g'), chr(1)), lambda x: regexp_matches(x, '^{_H}')) AS s, html FROM pages),
q AS (SELECT page_id, unnest(CASE WHEN len(s) > 0 THEN s ELSE [html] END) AS t, generate_subscripts(CASE WHEN len(s) > 0 THEN s ELSE [html] END, 1) - 1 AS section FROM p)
SELECT page_id, section::INT AS section, CASE WHEN regexp_matches(t, '^{_H}') THEN {_STRIP.format(c="regexp_extract(t, '^<h[1-3][^>]*>(.*?)</h[1-3]>', 1)")} END AS heading,
  sha256({_STRIP.format(c='t')}) AS digest FROM q WHERE {_STRIP.format(c='t')} <> ''""")
def _(lake):
    out = chunking.html_sections(lake.table("pages").select("page_id", "html"), "html")
    return out.select("page_id", "section", "heading", F.sha2("section_text", 256).alias("digest"))


@query("R2_row_to_text", """
SELECT 'c_custkey=' || c_custkey || ', c_name=' || c_name || ', c_nationkey=' || c_nationkey || ', c_acctbal=' || c_acctbal || ', c_mktsegment=' || c_mktsegment AS text FROM customer""")
def _(lake):
    customer = lake.table("customer")
    return customer.select(index.row_text(customer.columns).alias("text"))


_SENTENCES = """
SELECT 'mart_occupancy_daily' AS source, branch_id::VARCHAR AS branch_id, 'Branch ' || branch_id || ' occupancy on ' || date || ' was ' || occupancy_pct || '% (' || occupied_rooms || '/' || total_rooms || ' rooms occupied).' AS text FROM mart_occupancy
UNION ALL SELECT 'mart_revenue_daily', branch_id::VARCHAR, 'Branch ' || branch_id || ' total revenue on ' || date || ' was ' || total_revenue || ' (RevPAR ' || revpar || ', ADR ' || avg_daily_rate || ').' FROM mart_revenue
UNION ALL SELECT 'mart_restaurant_daily', branch_id::VARCHAR, 'Branch ' || branch_id || ' restaurant revenue on ' || date || ' was ' || total_revenue || ' across ' || total_orders || ' orders (avg order value ' || avg_order_value || ').' FROM mart_restaurant
UNION ALL SELECT 'mart_staff_daily', branch_id::VARCHAR, 'Branch ' || branch_id || ' ' || department_name || ' on ' || date || ' had ' || present_employees || '/' || scheduled_employees || ' staff present (' || attendance_rate_pct || '% attendance).' FROM mart_staff"""


def mart_docs(lake):
    frames = {
        "mart_occupancy_daily": marts.mart_occupancy_daily(daily(lake)), "mart_revenue_daily": marts.mart_revenue_daily(lake),
        "mart_restaurant_daily": marts.mart_restaurant_daily(lake), "mart_staff_daily": marts.mart_staff_daily(lake),
    }
    return reduce(DataFrame.unionByName, [index.mart_documents(m, n) for n, m in frames.items()])


def _mart_sentences(lake):
    return mart_docs(lake).select(F.element_at("metadata", "source").alias("source"), F.element_at("metadata", "branch_id").alias("branch_id"), "text")


query("R3_mart_sentences", _SENTENCES)(_mart_sentences)
query("D6_template_callables_native", _SENTENCES)(_mart_sentences)


# ---- store and queries: all documents, some with vectors; every benchmark item is a query ----

view("store", """
SELECT doc_id, text, source AS doc_type, lang AS branch_id, CASE WHEN doc_id % 3 <> 0 THEN DATE '2024-01-01' + (doc_id % 365)::INT END AS date, embedding
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""")
view("asked", "SELECT item_id AS query_id, text AS query_text, embedding FROM benchmark LEFT JOIN embeddings ON vec_id = item_id")
view("dense_pairs", """
SELECT query_id, doc_id, round(list_inner_product(q.embedding::DOUBLE[], s.embedding::DOUBLE[]), 9) AS score
FROM asked q CROSS JOIN store s WHERE q.embedding IS NOT NULL AND s.embedding IS NOT NULL""")
view("dense_all", "SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM dense_pairs")


def store(lake):
    date = F.when(F.col("doc_id") % 3 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")))
    return lake.table("documents").select("doc_id", "text", F.col("source").alias("doc_type"), F.col("lang").alias("branch_id"), date.alias("date"))


def vectors(lake):
    return lake.table("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding").join(lake.table("documents").select("doc_id"), "doc_id", "left_semi")


def asked(lake):
    return lake.table("benchmark").join(lake.table("embeddings"), F.col("item_id") == F.col("vec_id"), "left").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"), "embedding"
    )


_stored = {}  # path and tables of the keyword index of each input, built once per application


def keyword_index(lake):
    """The stored index of all documents; a later query of the application finds it and only reads it."""
    key = lake.spark.sparkContext.applicationId, lake.root
    if key not in _stored or not inverted.exists(lake.spark, _stored[key][0]):
        path = scratch_path(lake.spark, "keywords")
        inverted.build(lake.table("documents").select("doc_id", "text"), path)
        _stored[key] = path, inverted.load(lake.spark, path)
    return _stored[key][1]


def updated_index(lake):
    """The same documents in two segments: four fifths written at once, some with outdated texts and some that go, the rest and
    the right texts as an update."""
    path, docs = scratch_path(lake.spark, "keywords"), lake.table("documents").select("doc_id", "text")
    late = F.col("doc_id") % 5 == 0
    old = docs.withColumn("text", F.when(F.col("doc_id") % 50 == 1, F.concat(F.lit("outdated "), "text")).otherwise(F.col("text")))
    removed = docs.where("doc_id % 50 = 2").select((-F.col("doc_id") - 1).alias("doc_id"), "text")
    inverted.build(old.where(~late).unionByName(removed), path)
    inverted.update(path, 1, docs.where(late | (F.col("doc_id") % 50 == 1)), removed.select("doc_id"))
    return inverted.load(lake.spark, path)


@query("K3_vector_top_k", """
SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
  SELECT query_id, e.vec_id, round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS score FROM asked q CROSS JOIN embeddings e)) WHERE rank <= 15""")
def _(lake):
    return ops.dense_top_k(lake.table("embeddings"), asked(lake), 15).withColumn("score", F.round("score", 6))


view("toks", rf"SELECT doc_id, list_filter(string_split_regex({_STRIP.format(c='lower(text)')}, '\s+'), lambda x: x <> '') AS t FROM store")
view("postings", "SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM toks) GROUP BY 1, 2, 3")
view("idf0", "SELECT term, ln((SELECT count(*) FROM toks) - count(*) + 0.5::DOUBLE) - ln(count(*) + 0.5::DOUBLE) AS r FROM postings GROUP BY 1")
view("idf1", "SELECT term, CASE WHEN r < 0 THEN 0.25::DOUBLE * (SELECT avg(r) FROM idf0) ELSE r END AS idf FROM idf0")
view("qterms", rf"""SELECT query_id, term, count(*) AS qn FROM (SELECT query_id, unnest(list_filter(string_split_regex({_STRIP.format(c='lower(query_text)')}, '\s+'), lambda x: x <> '')) AS term FROM asked) GROUP BY 1, 2""")
view("bm25", """
SELECT query_id, doc_id, sum(qn * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / (SELECT avg(len(t)) FROM toks)))) AS bm25
FROM postings JOIN qterms USING (term) JOIN idf1 USING (term) GROUP BY 1, 2""")
view("sparse_all", """
SELECT query_id, doc_id, bm25, bm25 / CASE WHEN max(bm25) OVER (PARTITION BY query_id) > 0 THEN max(bm25) OVER (PARTITION BY query_id) ELSE 1 END AS sparse,
  row_number() OVER (PARTITION BY query_id ORDER BY round(bm25, 9) DESC, doc_id) AS rank FROM bm25""")


@query("R9_bm25_scores", "SELECT query_id, doc_id, rank, round(bm25, 6) AS bm25, round(sparse, 6) AS sparse FROM sparse_all")
def _(lake):
    found = inverted.ranked(inverted.scores(updated_index(lake), asked(lake)))
    return found.select("query_id", "doc_id", "rank", *[F.round(c, 6).alias(c) for c in ("bm25", "sparse")])


view("candidates", """
SELECT query_id, doc_id, coalesce(p.score, 0) AS dense, coalesce(b.sparse, 0) AS sparse, CASE WHEN d.rank <= 15 THEN d.rank END AS dense_rank,
  CASE WHEN b.rank <= 15 THEN b.rank END AS sparse_rank
FROM (SELECT query_id, doc_id FROM dense_all WHERE rank <= 15 UNION SELECT query_id, doc_id FROM sparse_all WHERE rank <= 15)
LEFT JOIN dense_pairs p USING (query_id, doc_id) LEFT JOIN dense_all d USING (query_id, doc_id) LEFT JOIN sparse_all b USING (query_id, doc_id)""")


@query("J14_sparse_lookup", "SELECT query_id, doc_id, round(dense, 6) AS dense, round(sparse, 6) AS sparse FROM candidates")
def _(lake):
    found = ops.candidates(vectors(lake), keyword_index(lake), asked(lake), 15)
    return found.select("query_id", "doc_id", F.round("dense", 6).alias("dense"), F.round("sparse", 6).alias("sparse"))


_HYBRID = """
SELECT query_id, doc_id, text, doc_type, branch_id, date, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS position FROM (
  SELECT c.query_id, c.doc_id, s.text, s.doc_type, s.branch_id, s.date, round(0.6::DOUBLE * c.dense + (1 - 0.6::DOUBLE) * c.sparse, 9) AS score,
    row_number() OVER (PARTITION BY c.query_id, s.text ORDER BY c.dense_rank NULLS LAST, c.sparse_rank NULLS LAST) AS r
  FROM candidates c JOIN store s USING (doc_id) WHERE {cond}) WHERE r = 1"""
view("hybrid_all", f"SELECT * FROM ({_HYBRID.format(cond='true')}) WHERE position <= 5")
_FILTER = "s.branch_id = 'en' AND (s.date IS NULL OR s.date >= DATE '2024-03-01') AND (s.date IS NULL OR s.date <= DATE '2024-11-30')"


def hybrid(lake, flt=None, pre=False):
    return ops.hybrid(store(lake), vectors(lake), keyword_index(lake), asked(lake), flt=flt, pre_filter=pre)


@query("R10_hybrid_retrieval", "SELECT query_id, doc_id, position, round(score, 6) AS score FROM hybrid_all")
def _(lake):
    return hybrid(lake).select("query_id", "doc_id", "position", F.round("score", 6).alias("score"))


@query("P19_metadata_filter", f"""
SELECT query_id, doc_id, position, round(score, 6) AS score FROM ({_HYBRID.format(cond=_FILTER)}) WHERE position <= 5""")
def _(lake):
    flt = ops.MetadataFilter(branch_id="en", date_from="2024-03-01", date_to="2024-11-30")
    return hybrid(lake, flt).select("query_id", "doc_id", "position", F.round("score", 6).alias("score"))


@query("U5_keep_first_by_text", """
SELECT query_id, doc_id FROM (SELECT c.query_id, c.doc_id, row_number() OVER (PARTITION BY c.query_id, s.text ORDER BY c.dense_rank NULLS LAST, c.sparse_rank NULLS LAST) AS r
FROM candidates c JOIN store s USING (doc_id)) WHERE r = 1""")
def _(lake):
    found = ops.candidates(vectors(lake), keyword_index(lake), asked(lake), 15).join(store(lake).select("doc_id", "text"), "doc_id")
    return ops.keep_first(found).select("query_id", "doc_id")


@query("R11_citations", """
SELECT query_id, position, doc_type AS source, 'txt' AS doc_type, round_even(score, 4) AS score, branch_id AS extra_branch FROM hybrid_all""")
def _(lake):
    chunks = hybrid(lake).withColumn("metadata", F.create_map(
        F.lit("source"), F.col("doc_type"), F.lit("doc_type"), F.lit("txt"), F.lit("branch_id"), F.col("branch_id"), F.lit("text"), F.col("text"),
    ))
    return ops.citations(chunks).select("query_id", "position", "source", "doc_type", "score", F.element_at("extra", "branch_id").alias("extra_branch"))


view("contexts", """
SELECT query_id, string_agg(substr(text, 1, room), chr(10) || chr(10) ORDER BY position) AS context FROM (
  SELECT query_id, position, text, (3000 - coalesce(sum(length(text)) OVER (PARTITION BY query_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS room
  FROM hybrid_all) WHERE room > 0 GROUP BY 1""")


@query("W12_context_budget", "SELECT query_id, length(context) AS n_chars, sha256(context) AS digest FROM contexts")
def _(lake):
    return ops.compress_context(hybrid(lake)).select("query_id", F.length("context").alias("n_chars"), F.sha2("context", 256).alias("digest"))


@query("R12_fallback_answer", """
SELECT query_id, 'No LLM provider is available/configured, so here is the most relevant retrieved context for your question (''' || query_text || '''):' || chr(10) || chr(10) || substr(context, 1, 1000) AS answer
FROM asked JOIN contexts USING (query_id)""")
def _(lake):
    context = ops.compress_context(hybrid(lake))
    return asked(lake).join(context, "query_id", "left").select(
        "query_id", ops.fallback_answer(F.col("query_text"), F.col("context")).alias("answer")
    )


# ---- conversations: five minutes per turn, read one minute after the last ----

view("turns", """
SELECT conv_id AS session_id, turn, role, text, turn * 300 AS said_at, max(turn) OVER (PARTITION BY conv_id) * 300 + 60 AS now FROM conversations""")
view("recent", """
SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY said_at DESC, turn DESC) AS recency FROM turns WHERE said_at >= now - 1800
QUALIFY recency <= 4""")


def turns(lake):
    rows = lake.table("conversations").select(
        F.col("conv_id").alias("session_id"), "turn", "role", "text", (F.col("turn") * 300).alias("said_at")
    )
    ends = rows.groupBy("session_id").agg((F.max("said_at") + 60).alias("now"))
    from staylytics.operators.joins import lookup_join

    return lookup_join(rows, ends, "session_id", "inner")


@query("W11_last_turns_in_ttl", "SELECT session_id, turn, recency FROM recent")
def _(lake):
    return ops.recent_turns(turns(lake), max_turns=4).select("session_id", "turn", "recency")


@query("R12_prompt_assembly", """
SELECT session_id, 'Context: (no relevant context retrieved)' || chr(10) || chr(10) || 'Conversation so far:' || chr(10) ||
  string_agg(role || ': ' || text, chr(10) ORDER BY said_at, turn) || chr(10) || chr(10) || 'Question: ' || arg_min(text, recency) AS prompt FROM recent GROUP BY 1""")
def _(lake):
    kept = ops.recent_turns(turns(lake), max_turns=4)
    asked_last = kept.groupBy("session_id").agg(F.min_by("text", "recency").alias("question"))
    return ops.history_text(kept).join(asked_last, "session_id").select(
        "session_id", ops.prompt(F.col("question"), F.lit(None).cast("string"), F.col("history")).alias("prompt")
    )


# ---- caches and manifests ----

view("cached_keys", "SELECT DISTINCT sha256('minilm:' || text) AS key FROM documents JOIN labels USING (doc_id)")


@query("J13_cache_split", """
SELECT doc_id, sha256('minilm:' || text) AS key, sha256('minilm:' || text) IN (SELECT key FROM cached_keys) AS cached FROM documents""")
def _(lake):
    docs = lake.table("documents").select("doc_id", "text")
    cache = docs.join(lake.table("labels"), "doc_id").select(ops.cache_key(F.col("text")).alias("key")).distinct()
    return ops.split_by_cache(docs, cache).select("doc_id", "key", "cached")


@query("J13_cache_misses", """
SELECT sha256('minilm:' || text) AS key, min(doc_id) AS doc_id FROM documents WHERE sha256('minilm:' || text) NOT IN (SELECT key FROM cached_keys) GROUP BY 1""")
def _(lake):
    docs = lake.table("documents").select("doc_id", "text")
    cache = docs.join(lake.table("labels"), "doc_id").select(ops.cache_key(F.col("text")).alias("key")).distinct()
    return ops.missing_keys(ops.split_by_cache(docs, cache))


view("cache_entries", """
SELECT source AS namespace, doc_id AS key, n_chars, CASE WHEN doc_id % 4 <> 0 THEN DATE '2024-01-01' + (doc_id % 365)::INT END AS expires_at FROM documents""")


@query("R13_ttl_cache_read", """
SELECT namespace, count(*) AS live, count(*) FILTER (WHERE expires_at IS NULL) AS without_expiry FROM cache_entries
WHERE (expires_at IS NULL OR expires_at >= DATE '2024-07-01') AND namespace <> (SELECT min(namespace) FROM cache_entries) GROUP BY 1""")
def _(lake):
    expires = F.when(F.col("doc_id") % 4 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")))
    entries = lake.table("documents").select(F.col("source").alias("namespace"), F.col("doc_id").alias("key"), expires.alias("expires_at"))
    first = entries.agg(F.min("namespace")).scalar()
    live = ops.read_cache(entries, F.lit("2024-07-01").cast("date"))
    return ops.clear_namespace(live, first).groupBy("namespace").agg(
        F.count("*").alias("live"), F.count_if(F.col("expires_at").isNull()).alias("without_expiry")
    )


view("doc_manifests", """
SELECT 'doc-' || doc_id AS path, CASE WHEN doc_id % 10 <> 3 THEN sha256(CASE WHEN doc_id % 7 = 0 THEN text || ' old' ELSE text END) END AS old_hash, sha256(text) AS new_hash FROM documents
UNION ALL SELECT 'gone-' || doc_id, sha256(text), NULL FROM documents WHERE doc_id % 13 = 0""")
_STATUS = "CASE WHEN old_hash IS NULL THEN 'new' WHEN new_hash IS NULL THEN 'removed' WHEN old_hash <> new_hash THEN 'changed' ELSE 'same' END"


def earlier_documents(lake):
    """An earlier state of the document folder: some documents missing, some with older text, some since removed."""
    docs = index.documents(lake.table("documents").where(F.col("doc_id") % 10 != 3).withColumn(
        "text", F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" old"))).otherwise(F.col("text"))
    ))
    gone = index.documents(lake.table("documents").where(F.col("doc_id") % 13 == 0))
    return docs.unionByName(gone.withColumn("path", F.regexp_replace("path", "^doc-", "gone-")))


@query("J12_manifest_diff", f"SELECT path, {_STATUS} AS status FROM doc_manifests")
def _(lake):
    return ops.manifest_diff(index.manifest(earlier_documents(lake)), index.manifest(index.documents(lake.table("documents"))))


# One text file per document; the writer ends each with a newline. A null text has no file.
@query("S12_document_hashes", "SELECT 'doc-' || doc_id AS path, sha256(text || chr(10)) AS hash FROM documents")
def _(lake):
    folder = scratch_path(lake.spark, "texts")
    # rows that share a doc_id are files of their own
    name = F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.monotonically_increasing_id().cast("string"))
    docs = lake.table("documents").select(name.alias("file"), F.concat(F.lit("doc-"), "doc_id").alias("path"), "text")
    index.write_text_files(docs, folder)
    found = index.scan_text_files(lake.spark, folder)
    doc = F.nullif(F.regexp_extract("path", r"file=(-?\d*)-\d+[./]", 1), F.lit(""))
    return found.select(F.concat(F.lit("doc-"), doc).alias("path"), "hash").unionByName(
        docs.where("text IS NULL").select("path", F.lit(None).cast("string").alias("hash")))


@query("R7_index_build", f"""
SELECT 'txt' AS doc_type, count(*) AS documents, true AS fits FROM squeezed WHERE length(t) > 0
UNION ALL SELECT 'warehouse', count(*), true FROM ({_SENTENCES})""")
def _(lake):
    path = scratch_path(lake.spark, "index")
    index.build(path, index.documents(lake.table("documents")), [mart_docs(lake)])
    fits = F.length("text") <= C.CHUNK_SIZE + C.CHUNK_OVERLAP + 1
    return lake.spark.read.parquet(f"{path}/chunks").groupBy(F.element_at("metadata", "doc_type").alias("doc_type")).agg(
        F.count_distinct("path").alias("documents"), F.bool_and(fits).alias("fits")
    )


# What the refreshed index holds: as many chunks as a fresh build, the same texts.
@query("R8_incremental_index", f"SELECT {_STATUS} AS status, count(*) AS documents, true AS as_fresh FROM doc_manifests GROUP BY 1")
def _(lake):
    old, new, fresh = (scratch_path(lake.spark, "index") for _ in range(3))
    docs = index.documents(lake.table("documents"))
    index.build(old, earlier_documents(lake), [])
    status = index.refresh(old, new, docs, [])
    index.build(fresh, docs, [])

    def content(path):
        chunks = lake.spark.read.parquet(f"{path}/chunks").select(F.xxhash64("path", "chunk_index", "text").cast("decimal(38,0)").alias("h"))
        return chunks.agg(F.struct(F.count("*"), F.sum("h")).alias("c")).scalar()

    return status.groupBy("status").agg(F.count("*").alias("documents")).withColumn("as_fresh", content(new) == content(fresh))
