"""Queries over the store's and the corpus' tables, one for each group of operators, with the SQL that gives the same.

Every query reads its whole tables; where these hold no manuals as they come from a reader, the chunks stand for them, with their headings and
tables written as manuals have them. The vector that is searched for is that of the least chunk id with a usable one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexharbor.functions import metadata, queries
from lexharbor.functions.text import CLEAN_RULES, clean, heading, preview, slug, strip, tokens, word_count
from lexharbor.functions.vectors import literal, norm
from lexharbor.operators import chunking, retrieval, search, store
from lexharbor.operators.dedup import last_wins
from lexharbor.operators.embed import HashingEmbedder, embed, embed_pending
from lexharbor.operators.pages import code_lines, kept_pages, mended_pages
from lexharbor.session import shared_dir, table
from lexharbor.sources import files

TERMS = ("search", "field")
WEB = '"print queue" or timer toolbar -administrators'
INLINE = 'search or "record list" or toolbar field'
K = {"commands": 3, "functions": 2, "programming": 4}


def _store(spark: SparkSession, d: str) -> store.Store:
    return store.read_store(spark, d)


def _names(s: store.Store) -> dict[str, str]:
    """Kind of each corpus: its name."""
    return {r.kind: r["name"] for r in s.corpus.select(queries.corpus_kind(F.col("name")).alias("kind"), "name").collect()}


def _vector(s: store.Store) -> list[float]:
    v = F.col("v")
    usable = (F.size(v) == 64) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & (norm(v) > 0)
    row = s.vectors(v=v, usable=usable).where("usable").agg(F.min(F.struct("chunk_id", "v")).alias("least")).first()
    return list(row["least"]["v"]) if row["least"] else [0.0] * 64


def dense_topk(spark, d):
    s = _store(spark, d)
    return retrieval.dense_search(s, _vector(s), _names(s)["programming"]).select("chunk_id", "document_id", "title", "chunk_index", F.md5("content").alias("content_md5"), "score")


def dense_min_score(spark, d):
    s = _store(spark, d)
    return retrieval.dense_search(s, _vector(s), _names(s)["commands"], top_k=None, min_score=0.25).select("chunk_id", "score")


def fts_match_and(spark, d):
    s = _store(spark, d)
    return s.chunks({"t": tokens(F.col("content"))}, found=retrieval.matches(F.col("t"), queries.parse_all("search field toolbar"))).where("found").select("chunk_id")


def fts_single_term_tf(spark, d):
    s = _store(spark, d)
    return retrieval.fts_search(s, "toolbar", _names(s)["programming"]).select("chunk_id", "document_id", "rank")


def fts_cover_density(spark, d):
    s = _store(spark, d)
    return retrieval.text_scores(s, queries.TextQuery(TERMS)).select("chunk_id", "corpus_name", "score")


def web_query(spark, d):
    s = _store(spark, d)
    t = F.col("t")
    return s.chunks({"t": tokens(F.col("content"))}, n_tokens=F.size(t), found=retrieval.matches(t, queries.parse_web(WEB))).where("found").select("chunk_id", "n_tokens")


def web_query_rank(spark, d):
    """The chunks that answer a query with alternatives and a phrase, by cover density."""
    s = _store(spark, d)
    return retrieval.text_scores(s, queries.parse_web(WEB)).select("chunk_id", "corpus_name", "score")


def hybrid_rrf(spark, d):
    s = _store(spark, d)
    return retrieval.hybrid_search(s, _vector(s), " ".join(TERMS), _names(s)["programming"]).select("chunk_id", "document_id", "title", "rrf_score", "dense_rank", "fts_rank")


def hybrid_inline_small_pool(spark, d):
    s = _store(spark, d)
    return retrieval.hybrid_search(s, _vector(s), INLINE, _names(s)["programming"], top_k=12, candidate_k=None, parser="web").select("chunk_id", "rrf_score", "dense_rank", "fts_rank")


def hybrid_dense_only(spark, d):
    """A text that is no query: vectors alone are searched."""
    s = _store(spark, d)
    return retrieval.hybrid_search(s, _vector(s), "search & (field", _names(s)["functions"]).select("chunk_id", "rrf_score", "dense_rank", "fts_rank")


def multi_corpus_topk(spark, d):
    s = _store(spark, d)
    names = _names(s)
    return retrieval.multi_corpus_search(s, _vector(s), " ".join(TERMS), {names[k]: n for k, n in K.items()}).select("chunk_id", "corpus_name", "title", "rrf_score", "dense_rank", "fts_rank")


def single_corpus_sum_k(spark, d):
    s = _store(spark, d)
    names = _names(s)
    k = search.wanted(list(names.values()), search.SearchRequest("x", "functions"))
    return retrieval.multi_corpus_search(s, _vector(s), " ".join(TERMS), k).select("chunk_id", "corpus_name", "rrf_score")


def multi_corpus_batch_queries(spark, d):
    s = _store(spark, d)
    return retrieval.batch_text_search(s, table(spark, d, "search_request"), queries.DEFAULT_K).select("query_id", "corpus_name", "chunk_id", "score", "rank")


def batch_dense(spark, d):
    """The chunks nearest to each request's first vector hit."""
    s = _store(spark, d)
    hits = table(spark, d, "search_hit").where("dense_rank IS NOT NULL").groupBy("query_id").agg(F.min(F.struct("dense_rank", "chunk_id")).alias("h"))
    vectors = hits.select("query_id", F.col("h.chunk_id").alias("chunk_id")).join(s.embedding.select("chunk_id", "v"), "chunk_id").where(F.size("v") == 64)
    found = retrieval.batch_dense_search(s, vectors.select("query_id", F.col("v").alias("vector")), 5)
    return found.select("query_id", "rank", F.round("cosine", 6).alias("cosine"))


def inverted_index(spark, d):
    index = retrieval.inverted_index(_store(spark, d).chunks(content=F.col("content")))
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum(F.size("positions")).alias("cf"))


def word_window_split(spark, d):
    parts = chunking.split_words(table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text"))
    return parts.select("doc_id", "part", "n_parts", word_count(F.col("text")).cast("long").alias("n_words"), F.when(F.col("part").isNotNull(), F.md5("text")).alias("text_md5"))


def min_word_filter(spark, d):
    return table(spark, d, "documents").select("doc_id", word_count(F.col("text")).cast("long").alias("n_words")).where(F.col("n_words") >= chunking.LEAST_WORDS)


def _of_corpora(s: store.Store, **columns):
    of = s.chunks(document_id=F.col("document_id"), **columns).join(s.document.select("document_id", "corpus_id"), "document_id")
    return of.join(s.corpus.select("corpus_id", F.col("name").alias("corpus")), "corpus_id")


def chunk_stats_by_corpus(spark, d):
    return chunking.chunk_stats(_of_corpora(_store(spark, d), content=F.col("content")), "corpus", "content")


def chunk_stats_total(spark, d):
    """The statistics of each corpus and of all."""
    return chunking.chunk_stats(_of_corpora(_store(spark, d), content=F.col("content")), "corpus", "content", total=True)


def id_occurrence_suffix(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("manual_key").alias("id"))
    return chunking.dedup_ids(docs, "id", ("doc_id",))


def _chunk_lines(spark, d):
    return chunking.lines(_store(spark, d).chunk, "chunk_id", "content")


def chapter_carry_forward(spark, d):
    """Each line with the numbered heading it stands under, counted by heading."""
    w = Window.partitionBy("chunk_id").orderBy("line_no")
    number = F.nullif(F.regexp_extract("line", r"^(\d+)\.(\d+) (.+)$", 1), F.lit("")).cast("int")
    named = _chunk_lines(spark, d).withColumn("number", number).withColumn("name", F.when(number.isNotNull(), F.regexp_extract("line", r"^(\d+)\.(\d+) (.+)$", 3)))
    on = named.withColumn("chapter", F.last("number", True).over(w)).withColumn("title", strip(F.last("name", True).over(w)))
    return on.where("chapter IS NOT NULL").groupBy("chunk_id", "chapter", "title").agg(F.count(F.lit(1)).alias("n_lines"))


def boundary_lookahead(spark, d):
    bounded = chunking.with_boundaries(_chunk_lines(spark, d), ("|Group|", "|Name|"), doc="chunk_id")
    return bounded.where("boundary").select("chunk_id", "line_no", "heading")


def heading_strip(spark, d):
    return _chunk_lines(spark, d).select("chunk_id", "line_no", heading(F.col("line")).alias("heading")).where("heading IS NOT NULL")


def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(clean(F.col("text"))).alias("clean_md5"))


# Each table's first lines as entries of the two kinds have them.
FUNCTION_HEAD = "|Function group|Execute on client|Platform(s)|\n|---|---|---|"
COMMAND_HEAD = "|Command group|Flag affected|Reversible|Execute on client|\n|---|---|---|---|"
_TABLE = r"\|Group\|Client\|Platform\|\n\|[-:|]+\|"
# (pattern, replacement): headings of any dialect as second-level Markdown; before it, for a guide, numbered ones as its chapters.
_HEADS = ((r"(?md)^#{1,6} ", "## "), (r"(?md)^={1,4} ?([A-Za-z][^=\n]*?) ?={1,4} ?$", "## $1"), (r"(?md)^\d+\.\d+ ", "## "))
_CHAPTERS = ((r"(?md)^(\d+)\.(\d+) (.+)$", "## **Chapter $1—$3**"),)


def _replaced(text, rules):
    for pattern, by in rules:
        text = F.regexp_replace(text, pattern, by)
    return text


def _manuals(spark, d, rules):
    """doc, md of every chunk."""
    return _store(spark, d).chunks(md=_replaced(F.col("content"), rules)).withColumnRenamed("chunk_id", "doc")


def markdown_metadata(spark, d):
    """The metadata and summaries of every chunk, read as a command's and as a function's entry of its name or id."""
    meta = lambda n: F.get_json_object("meta", f"$.{n}")
    name = F.coalesce(meta("command_name"), meta("function_signature"), F.col("chunk_id"))
    c = metadata.command_meta(F.regexp_replace("content", _TABLE, COMMAND_HEAD), name)
    f = metadata.function_meta(F.regexp_replace("content", _TABLE, FUNCTION_HEAD), name)
    rows = _store(spark, d).chunks(c=c, f=f).select("chunk_id", F.col("c"), F.col("f"))
    return rows.select("chunk_id", metadata.command_prefix(F.col("c")).alias("command_line"), "c.has_options", metadata.function_prefix(F.col("f")).alias("function_line"), "f.function_name", "f.has_example")


def slugify(spark, d):
    return table(spark, d, "rag_document").select("document_id", slug(F.col("title")).alias("slug"))


def german_detect(spark, d):
    return table(spark, d, "search_request").select("query_id", queries.looks_german(F.col("query")).alias("german"))


def german_rewrite(spark, d):
    return table(spark, d, "search_request").select("query_id", queries.rewrite_german(F.col("query")).alias("rewritten"))


def query_normalize(spark, d):
    return table(spark, d, "search_request").select("query_id", queries.normalized_query(F.col("query")).alias("n")).select("query_id", "n.*")


def preset_k(spark, d):
    k = {n: queries.clamped_k(F.col(f"k_{n}"), v).alias(f"k_{n}") for n, v in queries.DEFAULT_K.items()}
    rows = table(spark, d, "search_request").select("query_id", *k.values())
    return rows.withColumn("k_total", F.col("k_commands") + F.col("k_functions") + F.col("k_programming"))


def pending_antijoin(spark, d):
    s = _store(spark, d)
    return store.pending(s.chunk.select(F.col("chunk_id").alias("id")), s.embedding.select(F.col("chunk_id").alias("id")))


def _snapshots(spark, d):
    """(the last but one, the last) delivery, one row per key."""
    rows = table(spark, d, "rag_document_snapshot").where("snapshot_no IS NOT NULL")
    last = rows.agg(F.max("snapshot_no")).first()[0] or 0
    one = lambda n: last_wins(rows.where(F.col("snapshot_no") == n), ["corpus_id", "external_id"], ["loaded_at", "updated_at"], ["title", "meta"]).drop("snapshot_no", "loaded_at")
    return one(last - 1), one(last)


def upsert_documents(spark, d):
    old, new = _snapshots(spark, d)
    after = store.upsert_documents(old, new)
    field = lambda n: F.get_json_object("meta", f"$.{n}").alias(n)
    return after.select("corpus_id", "external_id", "document_id", "title", field("source"), field("section"), F.size(F.json_object_keys("meta")).cast("long").alias("n_keys"))


def insert_ignore(spark, d):
    old, new = _snapshots(spark, d)
    return store.insert_ignore(old, new, ["corpus_id", "external_id"]).select("corpus_id", "external_id", "document_id", "title")


def _managed(s: store.Store):
    return s.corpus.where(queries.corpus_kind(F.col("name")).isin("commands", "functions", "programming"))


def stale_cleanup(spark, d):
    old, new = _snapshots(spark, d)
    return store.stale(old, new, _managed(_store(spark, d))).select("corpus_id", "external_id")


def cascade_orphans(spark, d):
    s = _store(spark, d)
    old, _ = _snapshots(spark, d)
    after = store.full_sync(s, old, _managed(s))
    of = after.chunk.join(after.document.select("document_id", "corpus_id"), "document_id").join(after.embedding.select("chunk_id", F.lit(1).alias("e")), "chunk_id", "left")
    return of.groupBy("corpus_id").agg(F.countDistinct("document_id").alias("n_documents"), F.count(F.lit(1)).alias("n_chunks"), F.count("e").alias("n_embeddings"))


def last_wins_dedup(spark, d):
    rows = table(spark, d, "rag_document_snapshot")
    return last_wins(rows, ["snapshot_no", "corpus_id", "external_id"], ["loaded_at", "updated_at"], ["title", "meta"]).select("snapshot_no", "corpus_id", "external_id", "title")


def store_violations(spark, d):
    return store.violations(_store(spark, d))


def title_fallback(spark, d):
    return table(spark, d, "rag_document").select("document_id", metadata.title(F.col("meta"), F.col("external_id")).alias("label"))


def _hits(spark, d):
    one = table(spark, d, "search_hit").groupBy("query_id", "chunk_id").agg(F.max("rrf_score").alias("rrf_score"), F.max("corpus_name").alias("corpus_name"))
    return one.join(_store(spark, d).chunk.select("chunk_id", "content", "meta"), "chunk_id")


def hit_counts(spark, d):
    return search.hit_counts(table(spark, d, "search_hit"), ["query_id"])


def asked_requests(spark, d):
    """The requests that ask something."""
    q = table(spark, d, "search_request")
    return q.where(queries.asked(F.col("query"))).select("query_id", F.trim("query").alias("query"))


def metadata_flags(spark, d):
    """The flags of every chunk's metadata, written in any way."""
    meta = lambda n: F.get_json_object("meta", f"$.{n}")
    shown = F.when(F.crc32("chunk_id") % 2 == 0, F.upper(meta("execute_on_client"))).otherwise(F.concat(F.lit(" "), meta("execute_on_client")))
    return _store(spark, d).chunks(client=queries.flag(shown), reversible=queries.flag(meta("reversible"), True)).select("chunk_id", "client", "reversible")


def source_labels(spark, d):
    return search.source_labels(_hits(spark, d), ["query_id"]).select("query_id", F.array_join("sources", "|").alias("sources"))


def context_text(spark, d):
    return search.context_text(_hits(spark, d), ["query_id"]).select("query_id", F.md5("context_text").alias("context_md5"), F.length("context_text").cast("long").alias("n_chars"))


def metadata_filter(spark, d):
    meta = lambda n: F.get_json_object("meta", f"$.{n}")
    found = (meta("platform") == "All") | (meta("execute_on_client") == "true")
    return _store(spark, d).chunks(found=found, source=meta("source")).where("found").select("chunk_id", "source")


def import_counters(spark, d):
    chunk = _store(spark, d).chunks(source=F.get_json_object("meta", "$.source"))
    source = F.col("source")
    return chunk.agg(F.count(F.lit(1)).alias("n_read"), F.count_if(F.coalesce(source, F.lit("")).isin(*store.SOURCES)).alias("imported"), F.count_if(~F.coalesce(source, F.lit("")).isin(*store.SOURCES)).alias("skipped"))


def hash_column(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("hash_sha256"))


def preview_text(spark, d):
    return table(spark, d, "documents").select("doc_id", preview(F.col("text")).alias("preview"))


def _page_words(spark, d):
    """doc, page, text, x0, top, fontname of every word of every chunk: a chunk is a page of its document and a line of text a line of print. Each
    third line is in a font for code."""
    lines_ = chunking.lines(_store(spark, d).chunks(document_id=F.col("document_id"), page=F.col("chunk_index"), content=F.col("content")).select(F.struct("document_id", "page", "chunk_id").alias("of"), "content"), "of", "content")
    words_ = lines_.select("of", "line_no", F.posexplode(F.filter(F.split("line", " "), lambda w: w != "")).alias("x", "text"))
    font = F.when(F.col("line_no") % 3 == 0, "CourierNew").otherwise("Times")
    return words_.select(F.concat_ws("/", "of.document_id", "of.chunk_id").alias("doc"), "of.page", "text", F.col("x").cast("double").alias("x0"), (F.col("line_no") * 12 + (F.col("x") % 3) * 0.2).alias("top"), font.alias("fontname"))


def page_code_lines(spark, d):
    found = code_lines(kept_pages(_page_words(spark, d), [0, 3]))
    return found.select("doc", "page", "y", F.md5("line").alias("line_md5"))


def code_repair(spark, d):
    """Every chunk as a page whose code has lost its blanks, and every second line its end, mended by the chunk's own lines."""
    own = F.filter(F.split(F.regexp_replace("content", r"[\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]", "\n"), "\n"), lambda x: ~F.startswith(F.regexp_replace(x, r"(?U)\s+", ""), F.lit("`")))
    bare = lambda x, i: F.regexp_replace(x, r"(?U)\s+", "")
    lost = F.transform(own, lambda x, i: F.when(i % 2 == 0, bare(x, i)).otherwise(F.substring(bare(x, i), F.lit(1), F.greatest(F.length(bare(x, i)) - 2, F.lit(0)))))
    page = _store(spark, d).chunks(lines=own, md=F.concat(F.lit("```\n"), F.array_join(lost, "\n"), F.lit("\n```"))).where("md IS NOT NULL").withColumn("page", F.lit(1))
    lines_ = page.select("chunk_id", "page", F.posexplode("lines").alias("y", "line"))
    return mended_pages(page.select("chunk_id", "page", "md"), lines_, "chunk_id").select("chunk_id", F.md5("md").alias("md5"))


def embed_hash(spark, d):
    vectors = embed(_store(spark, d).chunks(text=F.col("content")), HashingEmbedder())
    return vectors.select("chunk_id", "embedding")


def embed_run(spark, d):
    """The records a run adds for the chunks that have no vector yet."""
    s = _store(spark, d)
    chunks = s.chunks(text=F.col("content")).withColumnRenamed("chunk_id", "id")
    made = embed_pending(chunks, s.vectors(there=F.lit(1)).select(F.col("chunk_id").alias("id")), HashingEmbedder())
    return made.select("id", F.md5("text").alias("text_md5"), F.size("embedding").alias("dim"))


def chunk_manual(spark, d):
    """Every chunk cut as a manual of functions."""
    docs = _manuals(spark, d, (*_HEADS, (_TABLE, FUNCTION_HEAD)))
    return chunking.chunk_reference(docs, "functions").select("doc", "id", F.md5("text").alias("text_md5"), "metadata.function_group", "metadata.platform", "metadata.part")


def chunk_guide(spark, d):
    """Every chunk cut as a guide, its numbered headings as chapters."""
    docs = _manuals(spark, d, (*_CHAPTERS, *_HEADS))
    return chunking.chunk_guide(docs).select("doc", "id", F.md5("text").alias("text_md5"), "metadata.chapter_number", "metadata.section", "metadata.word_count", "metadata.part")


def _records(s: store.Store):
    """The chunks as delivered records."""
    meta = lambda n: F.get_json_object("meta", f"$.{n}")
    id_ = F.coalesce(meta("command_name"), meta("function_signature"), meta("section"), F.col("chunk_id"))
    rows = s.chunks(id=id_, text=F.col("content"), metadata=F.col("meta"), pos=F.struct("created_at", "chunk_id")).join(s.vectors(embedding=F.col("v")), "chunk_id", "left")
    return rows.select("id", "text", "metadata", "embedding", "pos")


NOW = "2031-01-01 00:00:00"


def import_store(spark, d):
    """What an import of all chunks as records leaves: each imported document with its chunk and the size of its vector."""
    s = _store(spark, d)
    now = F.lit(NOW).cast("timestamp_ntz")
    after, _ = store.import_records(s, _records(s), "m", now)
    docs = after.document.where(F.col("updated_at") == now).select("document_id", "corpus_id", "external_id", "title", F.size(F.json_object_keys("meta")).cast("long").alias("n_keys"))
    chunk = after.chunk.where("chunk_index = 0").select("document_id", "chunk_id", F.md5("content").alias("content_md5"))
    vectors = after.embedding.where("model = 'm'").select("chunk_id", "embedding_dim")
    return docs.join(chunk, "document_id").join(vectors, "chunk_id", "left").select("corpus_id", "external_id", "title", "n_keys", "content_md5", "embedding_dim")


def import_run(spark, d):
    """The counters of an import that removes what is no longer delivered."""
    s = _store(spark, d)
    return store.import_records(s, _records(s), "m", F.lit(NOW).cast("timestamp_ntz"), delete_stale=True)[1]


def request_resolution(spark, d):
    """What each request searches when it names a preset."""
    q = table(spark, d, "search_request")
    mode = F.element_at(F.array(*map(F.lit, ("syntax", " Concept", "DEEP", "odd"))), (F.col("query_id") % 4 + 1).cast("int"))
    corpus = F.when(F.col("query_id") % 5 != 0, F.concat(F.lit(" "), F.upper(queries.corpus_kind(F.col("corpus")))))
    return q.select("query_id", queries.resolved(mode, corpus, {n: F.col(f"k_{n}") for n in queries.DEFAULT_K}).alias("r")).select("query_id", "r.*")


def vector_literals(spark, d):
    """The text form of every usable vector."""
    v = F.col("v")
    usable = (F.size(v) == 64) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return _store(spark, d).vectors(text=F.when(usable, literal(v))).where("text IS NOT NULL").select("chunk_id", F.md5("text").alias("text_md5"))


def store_catalog(spark, d):
    return store.catalog(spark, d).select("table_name", "column_name")


def jsonl_resume(spark, d):
    """Records written in two runs, the second resuming after the first, then read again with lines that are none among them: what comes back."""
    records = _store(spark, d).chunks(text=F.col("content"), metadata=F.col("meta")).select(F.col("chunk_id").alias("id"), "text", "metadata")
    folder = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    files.append_records(records.where(F.crc32("id") % 2 == 0), folder, force=True)
    files.append_records(store.pending(records, files.done_ids(spark, folder)), folder)
    spark.createDataFrame([("no json",), ("  ",), ('{"text": "no id"}',)], "value string").coalesce(1).write.mode("append").text(folder)
    good, bad = files.read_records(spark, folder)
    counts = good.agg(F.count(F.lit(1)).alias("n_records"), F.countDistinct("id").alias("n_ids"), F.sum(F.length("text")).alias("n_chars"))
    n_lines = F.lit(files.line_count(spark, folder)).cast("long").alias("n_lines")
    return counts.join(F.broadcast(bad.agg(F.count(F.lit(1)).alias("n_bad")))).select("*", n_lines)  # one row each


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return multi_corpus_topk(spark, d)


_ALL = (
    dense_topk, dense_min_score, fts_match_and, fts_single_term_tf, fts_cover_density, web_query, web_query_rank, hybrid_rrf, hybrid_inline_small_pool, hybrid_dense_only, multi_corpus_topk,
    single_corpus_sum_k, multi_corpus_batch_queries, batch_dense, inverted_index, word_window_split, min_word_filter, chunk_stats_by_corpus, chunk_stats_total, id_occurrence_suffix,
    chapter_carry_forward, boundary_lookahead, heading_strip, clean_text, markdown_metadata, slugify, german_detect, german_rewrite, query_normalize, preset_k, pending_antijoin,
    upsert_documents, insert_ignore, stale_cleanup, cascade_orphans, last_wins_dedup, store_violations, title_fallback, hit_counts, asked_requests, metadata_flags, source_labels, context_text, metadata_filter, import_counters,
    hash_column, preview_text, page_code_lines, code_repair, embed_hash, embed_run, chunk_manual, chunk_guide, import_store, import_run, request_resolution, vector_literals, store_catalog, jsonl_resume,
)
QUERIES = {f.__name__: f for f in _ALL}

# ---- SQL

#: White space of any Unicode kind, as a class of the oracle's expressions.
_W = r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_W}]+|[{_W}]+$', '', 'g')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{_W}]+')"


_STORE = """
chunk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY created_at DESC NULLS LAST, content DESC NULLS LAST) AS rn FROM rag_chunk) WHERE rn = 1),
emb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY created_at DESC NULLS LAST, v DESC NULLS LAST) AS rn FROM rag_embedding WHERE len(v) > 0) WHERE rn = 1),
doc AS (SELECT d.document_id, d.title, d.corpus_id, c.name AS corpus_name, regexp_extract(lower(c.name), '([^-]*)$', 1) AS kind FROM rag_document d JOIN rag_corpus c USING (corpus_id))
"""
_GOOD = "len(v) = 64 AND list_count(v) = 64 AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0"
_DENSE = f"""
qv AS (SELECT v::DOUBLE[] AS q FROM emb WHERE {_GOOD} ORDER BY chunk_id LIMIT 1),
near AS (SELECT chunk_id, document_id, corpus_name, kind, title, chunk_index, content, dist FROM (
  SELECT e.chunk_id, c.document_id, c.chunk_index, c.content, d.corpus_name, d.kind, d.title, round(1 - list_cosine_similarity(e.v::DOUBLE[], q), 9) AS dist
  FROM (SELECT * FROM emb WHERE {_GOOD}) e CROSS JOIN qv JOIN chunk c ON c.chunk_id = e.chunk_id JOIN doc d ON d.document_id = c.document_id))
"""
_TOKENS = r"toks AS (SELECT chunk_id, document_id, regexp_extract_all(lower(content), '[\p{L}\p{N}]+') AS t FROM chunk)"


def _text(query: queries.TextQuery) -> str:
    """CTEs up to scored(chunk_id, document_id, corpus_name, kind, score) of the cover density of a query of words and phrases of two words."""
    wanted = retrieval.groups(query)
    listed = ", ".join(f"'{t}'" for t in sorted({t for g in wanted for p in g for t in p}))
    lasts = []
    for i, group in enumerate(wanted):
        words = [p[0] for p in group if len(p) == 1]
        cases = [f"WHEN term = '{w}' THEN {{0}}" for w in words] + [f"WHEN term = '{p[1]}' AND prev = '{p[0]}' THEN {{0}} - 1" for p in group if len(p) == 2]
        lasts += [f"max(CASE {' '.join(cases)} END) OVER w AS {c}{i}".replace("{0}", at) for c, at in (("p", "pos"), ("n", "n"))]
    least = lambda c: "least(" + ", ".join(f"{c}{i}" for i in range(len(wanted))) + ")" if len(wanted) > 1 else f"{c}0"
    there = " AND ".join(f"p{i} IS NOT NULL" for i in range(len(wanted)))
    without = " AND ".join(f"NOT list_contains(t, '{w}')" for w in query.without) or "true"
    return f"""{_TOKENS},
hits AS (SELECT chunk_id, pos, term, prev, row_number() OVER (PARTITION BY chunk_id ORDER BY pos) AS n FROM (SELECT chunk_id, t[pos + 1] AS term, t[pos] AS prev, pos FROM (SELECT chunk_id, t, unnest(range(len(t))) AS pos FROM toks WHERE {without})) WHERE term IN ({listed})),
lasts AS (SELECT chunk_id, pos, n, {", ".join(lasts)} FROM hits WINDOW w AS (PARTITION BY chunk_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
spans AS (SELECT chunk_id, {least("p")} AS l, {least("n")} AS ln, min(pos) AS r, min(n) AS rm FROM lasts WHERE {there} GROUP BY ALL),
scored AS (SELECT s.chunk_id, c.document_id, d.corpus_name, d.kind, round(sum(1e0 / (1 + (r - l) - (rm - ln))), 9) AS score
  FROM spans s JOIN chunk c USING (chunk_id) JOIN doc d ON d.document_id = c.document_id GROUP BY ALL)"""


_AND = queries.TextQuery(TERMS)


def _hybrid(kinds: str, dense_most: str = "40", text_most: str = "40", query: queries.TextQuery = _AND) -> str:
    """CTEs up to rrf(chunk_id, document_id, corpus_name, kind, dense_rank, fts_rank, rrf_score, place)."""
    return f"""WITH {_STORE}, {_DENSE}, {_text(query)},
dr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corpus_name ORDER BY dist, chunk_id) AS dense_rank FROM near WHERE {kinds}) WHERE dense_rank <= {dense_most}),
tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corpus_name ORDER BY score DESC, chunk_id) AS fts_rank FROM scored WHERE {kinds}) WHERE fts_rank <= {text_most}),
rrf AS (SELECT *, row_number() OVER (PARTITION BY corpus_name ORDER BY rrf_score DESC, chunk_id) AS place FROM (
  SELECT coalesce(a.chunk_id, b.chunk_id) AS chunk_id, coalesce(a.document_id, b.document_id) AS document_id, coalesce(a.corpus_name, b.corpus_name) AS corpus_name, coalesce(a.kind, b.kind) AS kind,
         dense_rank, fts_rank, round(coalesce(1e0 / (60 + dense_rank), 0e0) + coalesce(1e0 / (60 + fts_rank), 0e0), 12) AS rrf_score
  FROM dr a FULL OUTER JOIN tr b ON a.chunk_id = b.chunk_id))
"""


_SNAP = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY snapshot_no, corpus_id, external_id
  ORDER BY loaded_at DESC NULLS LAST, updated_at DESC NULLS LAST, title DESC NULLS LAST, meta DESC NULLS LAST) AS rn FROM rag_document_snapshot WHERE snapshot_no IS NOT NULL),
old AS (SELECT * FROM numbered WHERE rn = 1 AND snapshot_no = (SELECT max(snapshot_no) - 1 FROM rag_document_snapshot)),
new AS (SELECT * FROM numbered WHERE rn = 1 AND snapshot_no = (SELECT max(snapshot_no) FROM rag_document_snapshot))
"""
_MANAGED = "SELECT corpus_id FROM rag_corpus WHERE regexp_extract(lower(name), '([^-]*)$', 1) IN ('commands', 'functions', 'programming')"
_SAME = "n.corpus_id IS NOT DISTINCT FROM o.corpus_id AND n.external_id IS NOT DISTINCT FROM o.external_id"


def _rewrite(x: str) -> str:
    for german, english in queries.GERMAN_WORDS:
        x = rf"regexp_replace({x}, '\b{german}\b', '{english}', 'gi')"
    return f"trim(regexp_replace({x}, '[{_W}]+', ' ', 'g'))"


_GERMAN = f"(regexp_matches(lower(query), '[äöüß]') OR regexp_matches(lower(query), '(?:^| )(?:{'|'.join(queries.GERMAN_HINTS)}) '))"


def _clean(x: str) -> str:
    flags = {0: "(?m)"}
    for i, (pattern, by) in enumerate(CLEAN):
        text = pattern.replace("(?md)", "").replace("(?s)", "")
        x = f"regexp_replace({x}, '{flags.get(i, '')}{text}', '{by}', '{'gs' if '(?s)' in pattern else 'g'}')"
    return _strip(x)


CLEAN = tuple((p, "' || chr(10) || chr(10) || '" if by else "") for p, by in CLEAN_RULES)


def _heading(x: str) -> str:
    return f"nullif({_strip(f"translate(regexp_extract({_strip(x)}, '^##[{_W}]+(.+?)[{_W}]*$', 1), '`*_', '')")}, '')"


_LINES = "lines AS (SELECT chunk_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT chunk_id, string_split(content, chr(10)) AS l FROM chunk WHERE content IS NOT NULL))"
_HITS = "h AS (SELECT s.query_id, s.chunk_id, s.rrf_score, s.corpus_name, c.content, c.meta FROM (SELECT query_id, chunk_id, max(rrf_score) AS rrf_score, max(corpus_name) AS corpus_name FROM search_hit GROUP BY ALL) s JOIN chunk c USING (chunk_id))"
_LABEL = "coalesce(meta ->> '$.command_name', meta ->> '$.function_signature', meta ->> '$.section', corpus_name)"
_CELL = lambda text, i, pattern: f"regexp_extract({text}, '{pattern}', {i})"
_C = lambda i: _CELL("body", i, metadata.COMMAND_TABLE)
_F = lambda i: _CELL("fbody", i, metadata.FUNCTION_TABLE)
_YES = lambda x: f"CASE WHEN contains(upper({x}), 'YES') THEN 'YES' ELSE 'NO' END"
_PLATFORM = lambda x: f"coalesce(nullif(regexp_extract({x}, '{metadata.PLATFORMS}', 1), ''), 'All')"



def _chr(text: str) -> str:
    """A text as a literal, its line ends written out."""
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _rules(x: str, rules) -> str:
    for pattern, by in rules:
        x = f"regexp_replace({x}, '{pattern.replace('(?md)', '(?m)')}', {_chr(by.replace('$1', chr(92) + '1').replace('$3', chr(92) + '3'))}, 'g')"
    return x


def _slug(x: str) -> str:
    return f"left(regexp_replace(lower(trim(regexp_replace(regexp_replace(strip_accents({x}), '[^\\x00-\\x7f]', '', 'g'), '[^\\w\\s-]', '', 'g'))), '[\\s-]+', '_', 'g'), 80)"


_SUBS = ", ".join(repr(x) for x in chunking.SUBSECTIONS)
_PARTS = "unnest(CASE WHEN len(w) > 700 THEN range(0, len(w), 450) ELSE [0] END) AS i"
_PART = "CASE WHEN len(w) > 700 THEN (i // 450)::INT END AS part, CASE WHEN len(w) > 700 THEN array_to_string(w[i + 1 : i + 500], ' ') ELSE text END AS text"
_SUFFIX = "CASE WHEN n > 1 THEN id || '_' || n ELSE id END AS id"


def _md_lines(rules) -> str:
    """CTEs up to l(doc, line_no, line) of the chunks as cleaned manuals."""
    return f"m AS (SELECT chunk_id AS doc, {_clean(_rules('content', rules))} AS md FROM chunk), l AS (SELECT doc, unnest(range(len(x))) AS line_no, unnest(x) AS line FROM (SELECT doc, string_split(md, chr(10)) AS x FROM m WHERE md IS NOT NULL))"


def _no_bullets(x: str) -> str:
    return _strip(f"regexp_replace({x}, '(?m)^## •.*$', '', 'g')")


_RECORDS = f"""{_STORE}, kinds AS (SELECT corpus_id, regexp_extract(lower(name), '([^-]*)$', 1) AS kind FROM rag_corpus),
rec AS (SELECT coalesce(meta ->> '$.command_name', meta ->> '$.function_signature', meta ->> '$.section', c.chunk_id) AS id, content AS text, meta, meta ->> '$.source' AS source, e.v, c.created_at, c.chunk_id FROM chunk c LEFT JOIN emb e ON e.chunk_id = c.chunk_id),
known AS (SELECT r.*, k.corpus_id FROM rec r JOIN kinds k ON k.kind = CASE r.source WHEN 'CommandRef' THEN 'commands' WHEN 'FunctionRef' THEN 'functions' WHEN 'Programming' THEN 'programming' END WHERE id IS NOT NULL AND text IS NOT NULL),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY corpus_id, id ORDER BY created_at DESC NULLS LAST, chunk_id DESC) AS rn FROM known) WHERE rn = 1)"""

SQL = {
    "dense_topk": f"WITH {_STORE}, {_DENSE} SELECT chunk_id, document_id, title, chunk_index, md5(content) AS content_md5, round(1 - dist, 9) AS score FROM near WHERE kind = 'programming' AND 1 - dist >= 0 ORDER BY dist, chunk_id LIMIT 10",
    "dense_min_score": f"WITH {_STORE}, {_DENSE} SELECT chunk_id, round(1 - dist, 9) AS score FROM near WHERE kind = 'commands' AND round(1 - dist, 9) >= 0.25",
    "fts_match_and": f"WITH {_STORE}, {_TOKENS} SELECT chunk_id FROM toks WHERE list_has_all(t, ['search', 'field', 'toolbar'])",
    "fts_single_term_tf": f"WITH {_STORE}, {_text(queries.TextQuery(('toolbar',)))} SELECT chunk_id, document_id, score AS rank FROM scored WHERE kind = 'programming' ORDER BY score DESC, chunk_id LIMIT 20",
    "fts_cover_density": f"WITH {_STORE}, {_text(_AND)} SELECT chunk_id, corpus_name, score FROM scored",
    "web_query": f"WITH {_STORE}, {_TOKENS} SELECT chunk_id, len(t)::INT AS n_tokens FROM toks WHERE list_contains(t, 'toolbar') AND NOT list_contains(t, 'administrators') AND (list_contains(t, 'timer') OR contains(' ' || array_to_string(t, ' ') || ' ', ' print queue '))",
    "hybrid_rrf": _hybrid("kind = 'programming'") + "SELECT chunk_id, r.document_id, title, rrf_score, dense_rank, fts_rank FROM rrf r JOIN doc USING (document_id) WHERE place <= 10",
    "hybrid_inline_small_pool": _hybrid("kind = 'programming'", "12", "12", queries.parse_web(INLINE)) + "SELECT chunk_id, rrf_score, dense_rank, fts_rank FROM rrf WHERE place <= 12",
    "hybrid_dense_only": f"WITH {_STORE}, {_DENSE}, dr AS (SELECT *, row_number() OVER (ORDER BY dist, chunk_id) AS dense_rank FROM near WHERE kind = 'functions') SELECT chunk_id, round(1e0 / (60 + dense_rank), 12) AS rrf_score, dense_rank, NULL::INT AS fts_rank FROM dr WHERE dense_rank <= 10",
    "multi_corpus_topk": _hybrid("kind IN ('commands', 'functions', 'programming')") + "SELECT chunk_id, r.corpus_name, title, rrf_score, dense_rank, fts_rank FROM rrf r JOIN doc USING (document_id) WHERE place <= CASE r.kind WHEN 'commands' THEN 3 WHEN 'functions' THEN 2 ELSE 4 END",
    "single_corpus_sum_k": _hybrid("kind = 'functions'") + "SELECT chunk_id, corpus_name, rrf_score FROM rrf WHERE place <= 18",
    "batch_dense": f"""WITH {_STORE}, ask AS (SELECT query_id, e.v::DOUBLE[] AS q FROM (SELECT query_id, arg_min(chunk_id, (dense_rank, chunk_id)) AS chunk_id FROM search_hit WHERE dense_rank IS NOT NULL GROUP BY query_id)
JOIN (SELECT * FROM emb WHERE {_GOOD}) e USING (chunk_id)),
far AS (SELECT query_id, chunk_id, round(list_cosine_similarity(v::DOUBLE[], q), 9) AS cosine FROM ask CROSS JOIN (SELECT * FROM emb WHERE {_GOOD}))
SELECT query_id, rank, round(cosine, 6) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, chunk_id) AS rank FROM far) WHERE rank <= 5""",
    "inverted_index": f"WITH {_STORE}, {_TOKENS} SELECT term, count(DISTINCT chunk_id) AS df, count(*) AS cf FROM (SELECT chunk_id, unnest(t) AS term FROM toks) GROUP BY term",
    "word_window_split": f"""WITH w AS (SELECT doc_id, {_words('text')} AS w FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, w, unnest(CASE WHEN len(w) > 700 THEN range(0, len(w), 450) ELSE [0] END) AS i FROM w)
SELECT doc_id, CASE WHEN len(w) > 700 THEN (i // 450)::INT END AS part, CASE WHEN len(w) > 700 THEN ceil(len(w) / 450e0)::INT ELSE 1 END AS n_parts,
CASE WHEN len(w) > 700 THEN least(500, len(w) - i) ELSE len(w) END AS n_words, CASE WHEN len(w) > 700 THEN md5(array_to_string(w[i + 1 : i + 500], ' ')) END AS text_md5 FROM p""",
    "min_word_filter": f"SELECT doc_id, len({_words('text')}) AS n_words FROM documents WHERE len({_words('text')}) >= 30",
    "chunk_stats_by_corpus": f"WITH {_STORE}, n AS (SELECT corpus_name AS corpus, coalesce(len({_words('content')}), 0) AS n FROM chunk JOIN doc USING (document_id)) SELECT corpus, count(*) AS n_chunks, floor(sum(n) / count(*))::BIGINT AS avg_words, min(n) AS min_words, max(n) AS max_words FROM n GROUP BY corpus",
    "id_occurrence_suffix": "SELECT doc_id, CASE WHEN n > 1 THEN manual_key || '_' || n ELSE manual_key END AS id FROM (SELECT *, row_number() OVER (PARTITION BY manual_key ORDER BY doc_id) AS n FROM documents)",
    "chapter_carry_forward": f"""WITH {_STORE}, {_LINES}, named AS (SELECT *, nullif(regexp_extract(line, '^(\\d+)\\.(\\d+) (.+)$', 1), '')::INT AS number, nullif(regexp_extract(line, '^(\\d+)\\.(\\d+) (.+)$', 3), '') AS name FROM lines),
c AS (SELECT chunk_id, last_value(number IGNORE NULLS) OVER w AS chapter, last_value(name IGNORE NULLS) OVER w AS title FROM named WINDOW w AS (PARTITION BY chunk_id ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT chunk_id, chapter, {_strip('title')} AS title, count(*) AS n_lines FROM c WHERE chapter IS NOT NULL GROUP BY ALL""",
    "boundary_lookahead": f"""WITH {_STORE}, {_LINES}, named AS (SELECT *, {_heading('line')} AS heading,
  min(CASE WHEN contains(line, '|Group|') OR contains(line, '|Name|') THEN line_no END) OVER w AS t, min(CASE WHEN starts_with({_strip('line')}, '##') THEN line_no END) OVER w AS o
  FROM lines WINDOW w AS (PARTITION BY chunk_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 9 FOLLOWING))
SELECT chunk_id, line_no, heading FROM named WHERE heading IS NOT NULL AND heading NOT IN ({", ".join(repr(x) for x in chunking.SUBSECTIONS)}) AND NOT starts_with(heading, '•') AND t <= coalesce(o, t)""",
    "heading_strip": f"WITH {_STORE}, {_LINES} SELECT * FROM (SELECT chunk_id, line_no, {_heading('line')} AS heading FROM lines) WHERE heading IS NOT NULL",
    "clean_text": f"SELECT doc_id, md5({_clean('text')}) AS clean_md5 FROM documents",
    "markdown_metadata": f"""WITH {_STORE}, b AS (SELECT chunk_id, coalesce(meta ->> '$.command_name', meta ->> '$.function_signature', chunk_id) AS name, {_rules("content", ((_TABLE, COMMAND_HEAD),))} AS body, {_rules("content", ((_TABLE, FUNCTION_HEAD),))} AS fbody FROM chunk)
SELECT chunk_id, 'Command: ' || name || ' | Group: ' || {_strip(_C(1))} || ' | Flag: ' || {_YES(_C(2))} || ' | Reversible: ' || {_YES(_C(3))} || ' | Client: ' || {_YES(_C(4))} || ' | Platform: ' || {_PLATFORM(_C(4))}
|| CASE WHEN regexp_matches(body, '{metadata.DEPRECATED}') THEN ' | DEPRECATED' ELSE '' END AS command_line, regexp_matches(body, '{metadata.OPTIONS}') AS has_options,
'Function: ' || name || ' | Group: ' || {_strip(f"translate({_F(1)}, '_*', '')")} || ' | Client: ' || {_YES(_F(2))} || ' | Platform: ' || {_PLATFORM(_F(3))} AS function_line,
{_strip("regexp_replace(name, '[()]+$', '')")} AS function_name, contains(fbody, '{metadata.EXAMPLES[0]}') AS has_example FROM b""",
    "slugify": f"SELECT document_id, {_slug('title')} AS slug FROM rag_document",
    "german_detect": f"SELECT query_id, {_GERMAN} AS german FROM search_request",
    "german_rewrite": f"SELECT query_id, {_rewrite('query')} AS rewritten FROM search_request",
    "query_normalize": f"""SELECT query_id, CASE WHEN german THEN new ELSE query END AS query_effective, CASE WHEN german THEN 'de' ELSE 'en' END AS query_language, german AND new IS DISTINCT FROM query AS rewrite_applied,
CASE WHEN NOT german THEN NULL WHEN new IS DISTINCT FROM query THEN 'de-to-en normalization' ELSE 'de-detected-no-change' END AS rewrite_reason FROM (SELECT query_id, query, {_GERMAN} AS german, {_rewrite('query')} AS new FROM search_request)""",
    "preset_k": "SELECT *, k_commands + k_functions + k_programming AS k_total FROM (SELECT query_id, least(30, greatest(1, coalesce(k_commands, 4))) AS k_commands, least(30, greatest(1, coalesce(k_functions, 4))) AS k_functions, least(30, greatest(1, coalesce(k_programming, 10))) AS k_programming FROM search_request)",
    "pending_antijoin": f"WITH {_STORE} SELECT chunk_id AS id FROM chunk c WHERE NOT EXISTS (SELECT 1 FROM emb e WHERE e.chunk_id = c.chunk_id)",
    "upsert_documents": f"""WITH {_SNAP}, after AS (SELECT coalesce(o.corpus_id, n.corpus_id) AS corpus_id, coalesce(o.external_id, n.external_id) AS external_id, coalesce(o.document_id, n.document_id) AS document_id,
CASE WHEN n.rn IS NOT NULL THEN n.title ELSE o.title END AS title, CASE WHEN n.rn IS NULL THEN o.meta WHEN o.rn IS NULL THEN n.meta ELSE json_merge_patch(coalesce(o.meta, '{{}}'), coalesce(n.meta, '{{}}'))::VARCHAR END AS meta
FROM old o FULL OUTER JOIN new n ON {_SAME}) SELECT corpus_id, external_id, document_id, title, meta ->> '$.source' AS source, meta ->> '$.section' AS section, len(json_keys(meta)) AS n_keys FROM after""",
    "insert_ignore": f"WITH {_SNAP} SELECT corpus_id, external_id, document_id, title FROM old UNION ALL SELECT corpus_id, external_id, document_id, title FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.corpus_id = n.corpus_id AND o.external_id = n.external_id)",
    "stale_cleanup": f"WITH {_SNAP} SELECT corpus_id, external_id FROM old o WHERE corpus_id IN ({_MANAGED}) AND NOT EXISTS (SELECT 1 FROM new n WHERE {_SAME})",
    "cascade_orphans": f"""WITH {_STORE}, {_SNAP}, kept AS (SELECT * FROM rag_document o WHERE corpus_id NOT IN ({_MANAGED}) OR EXISTS (SELECT 1 FROM old n WHERE {_SAME}))
SELECT k.corpus_id, count(DISTINCT c.document_id) AS n_documents, count(*) AS n_chunks, count(e.chunk_id) AS n_embeddings FROM chunk c JOIN kept k USING (document_id) LEFT JOIN emb e ON e.chunk_id = c.chunk_id GROUP BY k.corpus_id""",
    "last_wins_dedup": f"WITH {_SNAP} SELECT snapshot_no, corpus_id, external_id, title FROM numbered WHERE rn = 1",
    "store_violations": f"""WITH {_STORE} SELECT 'corpus name twice' AS rule, count(*) AS n FROM (SELECT 1 FROM rag_corpus GROUP BY name HAVING count(*) > 1)
UNION ALL SELECT 'document key twice', count(*) FROM (SELECT 1 FROM rag_document GROUP BY corpus_id, external_id HAVING count(*) > 1)
UNION ALL SELECT 'chunk key twice', count(*) FROM (SELECT 1 FROM chunk GROUP BY document_id, chunk_index HAVING count(*) > 1)
UNION ALL SELECT 'embedding twice', count(*) FROM (SELECT 1 FROM emb GROUP BY chunk_id HAVING count(*) > 1)
UNION ALL SELECT 'document of no corpus', count(*) FROM rag_document d WHERE NOT EXISTS (SELECT 1 FROM rag_corpus c WHERE c.corpus_id = d.corpus_id)
UNION ALL SELECT 'chunk of no document', count(*) FROM chunk c WHERE NOT EXISTS (SELECT 1 FROM rag_document d WHERE d.document_id = c.document_id)
UNION ALL SELECT 'embedding of no chunk', count(*) FROM emb e WHERE NOT EXISTS (SELECT 1 FROM chunk c WHERE c.chunk_id = e.chunk_id)
UNION ALL SELECT 'content missing', count(*) FROM chunk WHERE content IS NULL
UNION ALL SELECT 'vector of another size', count(*) FROM emb WHERE v IS NULL OR len(v) <> embedding_dim""",
    "title_fallback": "SELECT document_id, coalesce(nullif(meta ->> '$.command_name', ''), nullif(meta ->> '$.function_signature', ''), nullif(meta ->> '$.section', ''), external_id) AS label FROM rag_document",
    "hit_counts": "SELECT query_id, count(DISTINCT chunk_id) AS chunk_count, count(DISTINCT corpus_name) AS corpora FROM search_hit GROUP BY query_id",
    "asked_requests": f"SELECT query_id, trim(query) AS query FROM search_request WHERE regexp_replace(query, '[{_W}]+', '', 'g') <> ''",
    "metadata_flags": f"WITH {_STORE} SELECT chunk_id, coalesce(meta ->> '$.execute_on_client' = 'true', false) AS client, coalesce(meta ->> '$.reversible' = 'true', true) AS reversible FROM chunk",
    "source_labels": f"WITH {_STORE}, {_HITS} SELECT query_id, string_agg(label, '|' ORDER BY label) AS sources FROM (SELECT DISTINCT query_id, {_LABEL} AS label FROM h) GROUP BY query_id",
    "context_text": f"""WITH {_STORE}, {_HITS}, b AS (SELECT *, CASE kind WHEN 'commands' THEN 0 WHEN 'functions' THEN 1 WHEN 'code' THEN 3 ELSE 2 END AS s,
CASE kind WHEN 'commands' THEN '**' || coalesce(meta ->> '$.command_name', '') || '**' || chr(10) WHEN 'functions' THEN '**' || coalesce(meta ->> '$.function_signature', '') || '**' || chr(10) ELSE '' END || content || chr(10) AS body
FROM (SELECT *, regexp_extract(lower(corpus_name), '([^-]*)$', 1) AS kind FROM h)),
parts AS (SELECT query_id, s, ['### Commands', '### Functions', '### Concepts & Patterns', '### Code Examples from Project'][s + 1] || chr(10) || string_agg(body, chr(10) ORDER BY rrf_score DESC, chunk_id) AS part FROM b WHERE body IS NOT NULL GROUP BY query_id, s),
whole AS (SELECT query_id, '## Relevant Documentation' || chr(10) || chr(10) || string_agg(part, chr(10) ORDER BY s) AS text FROM parts GROUP BY query_id)
SELECT query_id, md5(text) AS context_md5, length(text) AS n_chars FROM whole""",
    "metadata_filter": f"WITH {_STORE} SELECT chunk_id, meta ->> '$.source' AS source FROM chunk WHERE meta ->> '$.platform' = 'All' OR meta ->> '$.execute_on_client' = 'true'",
    "import_counters": f"WITH {_STORE} SELECT count(*) AS n_read, count(*) FILTER (coalesce(meta ->> '$.source', '') IN ('CommandRef', 'FunctionRef', 'Programming')) AS imported, count(*) FILTER (coalesce(meta ->> '$.source', '') NOT IN ('CommandRef', 'FunctionRef', 'Programming')) AS skipped FROM chunk",
    "hash_column": "SELECT doc_id, sha256(text) AS hash_sha256 FROM documents",
    "preview_text": "SELECT doc_id, left(translate(text, chr(10), ' '), 160) AS preview FROM documents",
    "page_code_lines": f"""WITH {_STORE}, l AS (SELECT document_id || '/' || chunk_id AS doc, chunk_index AS page, unnest(range(len(x))) AS line_no, unnest(x) AS line FROM (SELECT *, string_split(content, chr(10)) AS x FROM chunk WHERE content IS NOT NULL)),
w AS (SELECT doc, page, line_no * 12 AS y, line_no, list_filter(string_split(line, ' '), lambda x: x <> '') AS w FROM l)
SELECT doc, page, y::INT AS y, md5(array_to_string(w, ' ')) AS line_md5 FROM w WHERE line_no % 3 = 0 AND len(w) > 0 AND coalesce(page NOT IN (0, 3), true)""",
    "code_repair": f"""WITH {_STORE}, x AS (SELECT chunk_id, list_filter(string_split(regexp_replace(content, '[\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), chr(10)), lambda x: NOT starts_with(regexp_replace(x, '[{_W}\\x1c-\\x1f]+', '', 'g'), '`')) AS x FROM chunk WHERE content IS NOT NULL),
own AS (SELECT chunk_id, i, line, bare, CASE WHEN i % 2 = 0 THEN bare ELSE left(bare, greatest(length(bare) - 2, 0)) END AS key FROM (SELECT *, regexp_replace(line, '[{_W}\\x1c-\\x1f]+', '', 'g') AS bare FROM (SELECT chunk_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM x))),
same AS (SELECT k.chunk_id, k.i, arg_max(l.line, l.i) AS line FROM own k JOIN own l ON l.chunk_id = k.chunk_id AND l.bare = k.key WHERE k.key <> '' GROUP BY ALL),
longer AS (SELECT k.chunk_id, k.i, arg_min(l.line, l.i) AS line FROM own k JOIN own l ON l.chunk_id = k.chunk_id AND starts_with(l.bare, k.key) WHERE k.key <> '' GROUP BY ALL),
new AS (SELECT o.chunk_id, o.i, coalesce(s.line, left(g.line, list_filter(range(1, length(g.line) + 1), lambda p: g.line[p] <> ' ')[length(o.key)]), o.key) AS fixed FROM own o LEFT JOIN same s USING (chunk_id, i) LEFT JOIN longer g USING (chunk_id, i))
SELECT x.chunk_id, md5('```' || chr(10) || coalesce(n.text, '') || chr(10) || '```') AS md5 FROM x LEFT JOIN (SELECT chunk_id, string_agg(fixed, chr(10) ORDER BY i) AS text FROM (SELECT *, max(i) OVER (PARTITION BY chunk_id) AS last FROM new JOIN own USING (chunk_id, i)) WHERE i < last OR key <> '' GROUP BY chunk_id) n USING (chunk_id)""",
    "chunk_stats_total": f"WITH {_STORE}, n AS (SELECT corpus_name AS corpus, coalesce(len({_words('content')}), 0) AS n FROM chunk JOIN doc USING (document_id)) SELECT coalesce(corpus, 'total') AS corpus, count(*) AS n_chunks, floor(sum(n) / count(*))::BIGINT AS avg_words, min(n) AS min_words, max(n) AS max_words FROM n GROUP BY ROLLUP (corpus)",
    "web_query_rank": f"WITH {_STORE}, {_text(queries.parse_web(WEB))} SELECT chunk_id, corpus_name, score FROM scored",
    "chunk_manual": f"""WITH {_STORE}, {_md_lines((*_HEADS, (_TABLE, FUNCTION_HEAD)))},
named AS (SELECT *, {_heading('line')} AS heading, min(CASE WHEN contains(line, '|Command group|') OR contains(line, '|Function group|') THEN line_no END) OVER w AS t, min(CASE WHEN starts_with({_strip('line')}, '##') THEN line_no END) OVER w AS o
  FROM l WINDOW w AS (PARTITION BY doc ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 9 FOLLOWING)),
b AS (SELECT *, coalesce(heading IS NOT NULL AND heading NOT IN ({_SUBS}) AND NOT starts_with(heading, '•') AND t <= coalesce(o, t), false) AS boundary FROM named),
sec AS (SELECT *, sum(boundary::INT) OVER (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM b),
s AS (SELECT doc, section, max(CASE WHEN boundary THEN heading END) AS heading, {_strip('string_agg(line, chr(10) ORDER BY line_no)')} AS text FROM sec GROUP BY doc, section),
own AS (SELECT *, {_words('text')} AS w FROM s WHERE contains(text, 'Function group')),
parts AS (SELECT doc, section, heading AS name, text AS fbody, {_PART} FROM (SELECT *, {_PARTS} FROM own WHERE section > 0)
  UNION ALL SELECT doc, section, coalesce(nullif(regexp_extract(text, '([\\p{{L}}\\p{{N}}_]+\\(\\))', 1), ''), 'abs()'), text, NULL, text FROM own WHERE section = 0 AND doc IN (SELECT doc FROM sec WHERE boundary)),
f AS (SELECT *, 'fn_' || {_slug('name')} || CASE WHEN part IS NULL THEN '' ELSE '_p' || part END AS id, {_strip(f"translate({_F(1)}, '_*', '')")} AS function_group, {_YES(_F(2))} AS client, {_PLATFORM(_F(3))} AS platform FROM parts),
k AS (SELECT *, row_number() OVER (PARTITION BY doc, id ORDER BY section, coalesce(part, 0)) AS n FROM f)
SELECT doc, {_SUFFIX}, md5('Function: ' || name || ' | Group: ' || function_group || ' | Client: ' || client || ' | Platform: ' || platform || chr(10) || chr(10) || text) AS text_md5, function_group, platform, part FROM k""",
    "chunk_guide": f"""WITH {_STORE}, {_md_lines((*_CHAPTERS, *_HEADS))},
h AS (SELECT *, {_heading('line')} AS heading, {_strip('line')} AS raw FROM l),
c AS (SELECT *, nullif(regexp_extract(raw, '{chunking.CHAPTER}', 1), '')::INT AS number, {_strip(f"regexp_extract(raw, '{chunking.CHAPTER}', 2)")} AS name FROM h),
o AS (SELECT * FROM (SELECT *, coalesce(min(CASE WHEN number = 2 THEN line_no END) OVER (PARTITION BY doc), 0) AS first FROM c) WHERE line_no >= first),
sec AS (SELECT *, sum((heading IS NOT NULL)::INT) OVER w AS section, last_value(number IGNORE NULLS) OVER w AS chapter, last_value(CASE WHEN number IS NOT NULL THEN name END IGNORE NULLS) OVER w AS chapter_title
  FROM o WINDOW w AS (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
p AS (SELECT doc, section, max(heading) AS heading, max(CASE WHEN heading IS NOT NULL THEN number END) AS number, coalesce(max(chapter), 0) AS chapter, coalesce(max(chapter_title), '') AS chapter_title,
  {_strip('string_agg(line, chr(10) ORDER BY line_no)')} AS whole FROM sec WHERE section > 0 GROUP BY doc, section),
kept AS (SELECT *, {_no_bullets('whole')} AS text FROM p WHERE CASE WHEN number IS NOT NULL THEN len({_words(_no_bullets(_strip("regexp_replace(whole, '^##[^\\n]*\\n', '')")))}) >= 30
  ELSE chapter NOT IN (1, 4) AND NOT starts_with(heading, '•') AND heading NOT IN ({_SUBS}) END),
s AS (SELECT *, {_words('text')} AS w FROM kept),
parts AS (SELECT doc, section, heading, chapter, chapter_title, len(w) AS n_all, {_PART} FROM (SELECT *, {_PARTS} FROM s WHERE len(w) >= 30)),
f AS (SELECT *, 'prog_ch' || CASE WHEN chapter < 10 THEN '0' ELSE '' END || chapter || '_' || {_slug('heading')} || CASE WHEN part IS NULL THEN '' ELSE '_p' || part END AS id FROM parts),
k AS (SELECT *, row_number() OVER (PARTITION BY doc, id ORDER BY section, coalesce(part, 0)) AS n FROM f)
SELECT doc, {_SUFFIX}, md5('Programming | Chapter ' || chapter || ': ' || chapter_title || ' | Section: ' || heading || chr(10) || chr(10) || text) AS text_md5, chapter AS chapter_number, heading AS section,
(CASE WHEN part IS NULL THEN n_all ELSE len({_words('text')}) END)::INT AS word_count, part FROM k""",
    "embed_run": f"WITH {_STORE} SELECT chunk_id AS id, md5(content) AS text_md5, 64::INT AS dim FROM chunk c WHERE NOT EXISTS (SELECT 1 FROM emb e WHERE e.chunk_id = c.chunk_id)",
    "import_store": f"""WITH {_RECORDS} SELECT corpus_id, id AS external_id, coalesce(nullif(meta ->> '$.command_name', ''), nullif(meta ->> '$.function_signature', ''), nullif(meta ->> '$.section', ''), id) AS title,
len(json_keys(meta)) AS n_keys, md5(text) AS content_md5, len(v)::INT AS embedding_dim FROM one""",
    "import_run": f"""WITH {_RECORDS}, n AS (SELECT count(*) AS read, count(*) FILTER (source IN ('CommandRef', 'FunctionRef', 'Programming') AND text IS NOT NULL) AS imported, count(*) FILTER (coalesce(source, '') NOT IN ('CommandRef', 'FunctionRef', 'Programming') AND text IS NOT NULL) AS skipped,
count(*) FILTER (id IS NULL OR text IS NULL) AS errors FROM rec) SELECT n.*, (SELECT count(*) FROM rag_document d WHERE corpus_id IN (SELECT corpus_id FROM one) AND NOT EXISTS (SELECT 1 FROM one o WHERE o.corpus_id = d.corpus_id AND o.id = d.external_id)) AS removed FROM n""",
    "request_resolution": """SELECT query_id, mode, CASE WHEN query_id % 5 = 0 THEN CASE mode WHEN 'concept' THEN 'programming' WHEN 'deep' THEN 'programming' ELSE 'all' END WHEN kind IN ('all', 'commands', 'functions', 'programming', 'code') THEN kind ELSE 'all' END AS corpus,
coalesce(CASE WHEN k_commands IS NOT NULL THEN least(30, greatest(1, k_commands)) END, CASE mode WHEN 'syntax' THEN 8 WHEN 'concept' THEN 2 WHEN 'deep' THEN 2 ELSE 4 END) AS k_commands, coalesce(CASE WHEN k_functions IS NOT NULL THEN least(30, greatest(1, k_functions)) END, CASE mode WHEN 'syntax' THEN 8 WHEN 'concept' THEN 4 WHEN 'deep' THEN 2 ELSE 4 END) AS k_functions,
coalesce(CASE WHEN k_programming IS NOT NULL THEN least(30, greatest(1, k_programming)) END, CASE mode WHEN 'syntax' THEN 4 WHEN 'concept' THEN 12 WHEN 'deep' THEN 20 ELSE 10 END) AS k_programming
FROM (SELECT *, CASE query_id % 4 WHEN 0 THEN 'syntax' WHEN 1 THEN 'concept' WHEN 2 THEN 'deep' END AS mode, coalesce(regexp_extract(lower(corpus), '([^-]*)$', 1), 'all') AS kind FROM search_request)""",
    "vector_literals": f"WITH {_STORE} SELECT chunk_id, md5('[' || array_to_string(list_transform(v, lambda x: printf('%.8f', x::DOUBLE)), ',') || ']') AS text_md5 FROM emb WHERE len(v) = 64 AND list_count(v) = 64 AND len(list_filter(v, lambda x: NOT isfinite(x))) = 0",
    "store_catalog": "SELECT table_name, column_name FROM information_schema.columns WHERE table_name IN ('rag_corpus', 'rag_document', 'rag_chunk', 'rag_embedding')",
    "jsonl_resume": f"WITH {_STORE} SELECT count(*) AS n_records, count(DISTINCT chunk_id) AS n_ids, sum(length(content))::BIGINT AS n_chars, count(*) + 2 AS n_lines, 2 AS n_bad FROM chunk WHERE chunk_id IS NOT NULL",
    "multi_corpus_batch_queries": f"""WITH {_STORE}, {_TOKENS},
ask AS (SELECT query_id, corpus, coalesce(k_commands, 4) AS kc, coalesce(k_functions, 4) AS kf, coalesce(k_programming, 10) AS kp, list_distinct(regexp_extract_all(lower(query), '[\\p{{L}}\\p{{N}}]+')) AS terms FROM search_request),
m AS (SELECT query_id, corpus, kc, kf, kp, terms, t, chunk_id, corpus_name, kind FROM ask JOIN toks ON list_has_all(t, terms) JOIN doc USING (document_id) WHERE len(terms) > 0),
hits AS (SELECT query_id, chunk_id, terms, pos, term, row_number() OVER (PARTITION BY query_id, chunk_id ORDER BY pos) AS n FROM (SELECT query_id, chunk_id, terms, unnest(t) AS term, unnest(range(len(t))) AS pos FROM m) WHERE list_contains(terms, term)),
lasts AS (SELECT a.query_id, a.chunk_id, a.pos, a.n, len(a.terms) AS want, b.term, max(b.pos) AS p, max(b.n) AS bn FROM hits a JOIN hits b ON a.query_id = b.query_id AND a.chunk_id = b.chunk_id AND b.pos <= a.pos GROUP BY ALL),
lefts AS (SELECT query_id, chunk_id, pos, n, min(p) AS l, min(bn) AS ln FROM lasts GROUP BY query_id, chunk_id, pos, n, want HAVING count(*) = want),
spans AS (SELECT query_id, chunk_id, l, ln, min(pos) AS r, min(n) AS rn FROM lefts GROUP BY ALL),
score AS (SELECT query_id, chunk_id, round(sum(1e0 / (1 + (r - l) - (rn - ln))), 9) AS score FROM spans GROUP BY ALL),
lim AS (SELECT m.query_id, m.corpus_name, m.chunk_id, s.score, CASE WHEN corpus = 'all' THEN CASE kind WHEN 'commands' THEN kc WHEN 'functions' THEN kf WHEN 'programming' THEN kp ELSE 0 END WHEN corpus = corpus_name THEN kc + kf + kp ELSE 0 END AS k
  FROM m JOIN score s ON s.query_id = m.query_id AND s.chunk_id = m.chunk_id)
SELECT query_id, corpus_name, chunk_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, corpus_name ORDER BY score DESC, chunk_id) AS rank FROM lim WHERE k > 0) WHERE rank <= k""",
}
