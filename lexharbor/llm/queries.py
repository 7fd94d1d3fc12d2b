"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.llm import fusion, languages, markup, mixture, neighbours, splitting, tokens
from lexharbor.operators.dedup import last_wins, newest
from lexharbor.session import spread, table


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean text of every chunk, with its blocks."""
    chunks = table(spark, sf_dir, "rag_chunk").select("chunk_id", "content", "created_at")
    return markup.clean_markup(last_wins(chunks, ["chunk_id"], ["created_at"], ["content"]))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks with markup, each once however often its row is repeated."""
    return markup.clean_markup(spread(table(spark, sf_dir, "rag_chunk").select("chunk_id", "content"))).where("has_markup").select("chunk_id").distinct()


def p2_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit of every request with its ranks, its fused score and its position."""
    return fusion.fuse(table(spark, sf_dir, "search_hit"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hit that stands first in its request's combined ranking."""
    return fusion.first(fusion.fuse(table(spark, sf_dir, "search_hit")))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all chunks longer than 4,000 characters."""
    long = F.when(F.length("content") > splitting.LIMIT, F.col("content"))  # no other text is shuffled
    last = newest(table(spark, sf_dir, "rag_chunk"), ["chunk_id"], ["created_at"], document_id=F.col("document_id"), content=long)
    return splitting.split_oversized(last)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that come out of the splitter in more than one piece."""
    return splitting.split_oversized(table(spark, sf_dir, "rag_chunk")).where("chunk_index = 1").select("chunk_id").distinct()


def p4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every chunk with a usable vector, with cosine and rank."""
    near = neighbours.similar(table(spark, sf_dir, "rag_embedding"))
    return near.select(F.col("item").alias("chunk_id"), F.col("neighbour").alias("neighbour_id"), "cosine", "rank")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of chunks one of which is among the 5 nearest of the other."""
    return neighbours.pairs(neighbours.similar(table(spark, sf_dir, "rag_embedding")))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return tokens.encode_corpus(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", "ids")


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents by mix_target."""
    return mixture.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares the mixture reaches."""
    return mixture.shares(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))


def p7_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the documents of each source are taken where sizes are in characters, as the table has them."""
    docs = table(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", mixture.source_name(F.col("source")).alias("source"), F.coalesce("n_chars", F.lit(0)).alias("n_tokens"))
    return mixture.rates(sizes, table(spark, sf_dir, "mix_target")).select("source", "documents", F.col("available_tokens").alias("available"), F.round("rate", 6).alias("rate"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a missing or wrong label or several languages, with each language written in them."""
    docs = _documents(spark, sf_dir)
    return languages.mislabelled(docs, languages.train(docs))


def p8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of every document with its language and confidence."""
    docs = _documents(spark, sf_dir)
    return languages.passages(docs, languages.train(docs))


QUERIES = {
    "p1_found": p1_found, "p1_clean": p1_clean,
    "p2_found": p2_found, "p2_ranking": p2_ranking,
    "p3_found": p3_found, "p3_pieces": p3_pieces,
    "p4_found": p4_found, "p4_neighbours": p4_neighbours,
    "p6_ids": p6_ids,
    "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_rates": p7_rates,
    "p8_found": p8_found, "p8_passages": p8_passages,
}

_FUSED = """
WITH one AS (
  SELECT query_id, chunk_id, max(CASE WHEN isnan(rrf_score) THEN NULL ELSE rrf_score END) AS a, min(dense_rank) AS b, min(fts_rank) AS c
  FROM search_hit GROUP BY query_id, chunk_id),
ranked AS (
  SELECT query_id, chunk_id,
         rank() OVER (PARTITION BY query_id ORDER BY a DESC NULLS LAST) AS rank_rrf_score,
         rank() OVER (PARTITION BY query_id ORDER BY b ASC NULLS LAST) AS rank_dense_rank,
         rank() OVER (PARTITION BY query_id ORDER BY c ASC NULLS LAST) AS rank_fts_rank
  FROM one),
fused AS (
  SELECT *, round(1e0 / (60 + rank_rrf_score) + 1e0 / (60 + rank_dense_rank) + 1e0 / (60 + rank_fts_rank), 12) AS fused FROM ranked)
"""

SQL = {
    "p7_rates": """WITH d AS (SELECT nullif(lower(trim(source)), '') AS source, coalesce(n_chars, 0) AS n FROM documents),
s AS (SELECT source, count(*) AS documents, sum(n)::BIGINT AS available FROM d GROUP BY source),
t AS (SELECT nullif(lower(trim(source)), '') AS source, sum(target_share) AS share, min(max_repeats) AS most FROM mix_target GROUP BY 1)
SELECT t.source, coalesce(documents, 0) AS documents, coalesce(available, 0) AS available,
round(CASE WHEN available > 0 AND share > 0 AND most > 0 THEN least(share * (SELECT sum(n) FROM d) / available, most) ELSE 0 END, 6) AS rate FROM t LEFT JOIN s USING (source)""",
    "p2_found": _FUSED + """SELECT query_id, chunk_id FROM (
  SELECT query_id, chunk_id, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, chunk_id) AS n FROM fused) WHERE n = 1""",
    "p2_ranking": _FUSED + "SELECT *, rank() OVER (PARTITION BY query_id ORDER BY fused DESC) AS position FROM fused",
    "p3_found": "SELECT DISTINCT chunk_id FROM rag_chunk WHERE length(content) > 4000",
}
