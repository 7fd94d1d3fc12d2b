"""Search by vectors, by text, and by both.

Distances and scores are computed where the rows lie; what is shuffled and ranked are ids with them, and contents are joined to the hits. Each
corpus has its own ranks, so one query over many corpora is one plan with a window over the corpus, whose limit is applied before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexharbor.functions.queries import TextQuery, parse_all, parse_web
from lexharbor.functions.text import tokens, words_only
from lexharbor.functions.vectors import cosine, distance
from lexharbor.operators.dedup import only_last
from lexharbor.operators.postings import Postings, rounded
from lexharbor.operators.store import Store
from lexharbor.session import bounded, cut

# The defaults of the searches.
TOP_K, TEXT_TOP_K, CANDIDATES, RRF_K = 10, 20, 40, 60
DECIMALS = 9


def _corpora(store: Store, names: Sequence[str] | None) -> DataFrame:
    named = store.corpus.select("corpus_id", F.col("name").alias("corpus_name"))
    return named if names is None else named.where(F.col("corpus_name").isin(*names))


def _documents(store: Store, names: Sequence[str] | None) -> DataFrame:
    return store.document.select("document_id", "corpus_id").join(_corpora(store, names), "corpus_id").select("document_id", "corpus_name")


def _holds(found: Column, phrase: tuple[str, ...]) -> Column:
    """Whether the tokens, which hold no blanks, hold the phrase."""
    return F.contains(F.concat(F.lit(" "), F.array_join(found, " "), F.lit(" ")), F.lit(f" {' '.join(phrase)} "))


def matches(found: Column, query: TextQuery) -> Column:
    """Whether a text with these tokens answers the query."""
    ok = F.lit(True)
    for t in query.terms:
        ok = ok & F.array_contains(found, t)
    for group in query.either:
        one = F.lit(False)
        for p in group:
            one = one | (F.array_contains(found, p[0]) if len(p) == 1 else _holds(found, p))
        ok = ok & one
    for p in query.phrases:
        ok = ok & _holds(found, p)
    for t in query.without:
        ok = ok & ~F.array_contains(found, t)
    return ok


def groups(query: TextQuery) -> list[list[tuple[str, ...]]]:
    """What a text must hold one of each of: words and phrases, as tuples of words."""
    return [*[[(t,)] for t in query.terms], *[list(g) for g in query.either], *[[p] for p in query.phrases]]


def density(found: list[str], wanted: Sequence[Sequence[tuple[str, ...]]]) -> float:
    """The cover density of a text: each shortest span that holds one of each group of `wanted` adds 1 / (1 + words in it that are none of the
    query's). Of one word that is its frequency. Time is linear in the text."""
    words = {w for g in wanted for p in g for w in p}
    ends: dict[str, list[tuple[int, tuple[str, ...]]]] = {}  # last word of a phrase: (group, phrase)
    for i, g in enumerate(wanted):
        for p in g:
            ends.setdefault(p[-1], []).append((i, p))
    start = [-1] * len(wanted)  # where the last occurrence of each group begins
    seen = [0]  # how many of the query's words stand before each position
    left, total = -1, 0.0
    for at, word in enumerate(found):
        seen.append(seen[-1] + (word in words))
        hit = False
        for i, p in ends.get(word, ()):
            first = at + 1 - len(p)
            if first >= 0 and (len(p) == 1 or tuple(found[first : at + 1]) == p):
                start[i], hit = max(start[i], first), True
        if hit and min(start) > left:
            left = min(start)
            total += 1 / (1 + (at + 1 - left) - (seen[at + 1] - seen[left]))
    return total


def text_score(found: Column, query: TextQuery) -> Column:
    """The cover density of a text with these tokens, NULL where it does not answer the query; only texts that do leave the JVM."""
    wanted = groups(query)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else round(density(t, wanted), DECIMALS) for t in texts.to_pylist()], pa.float64())

    return score(F.when(matches(found, query), found))


def text_scores(store: Store, query: TextQuery, names: Sequence[str] | None = None) -> DataFrame:
    """chunk_id, document_id, corpus_name, score of all chunks that answer the query; one pass over the texts, of which only scores are shuffled."""
    scored = store.chunks({"_tokens": tokens(F.col("content"))}, document_id=F.col("document_id"), score=text_score(F.col("_tokens"), query)).where("score IS NOT NULL")
    return scored.join(_documents(store, names), "document_id").select("chunk_id", "document_id", "corpus_name", "score")


def _distances(store: Store, vector: Sequence[float]) -> DataFrame:
    far = store.vectors(dist=F.when(F.size("v") == len(vector), distance(F.col("v"), vector)))
    return far.where(F.col("dist").isNotNull() & ~F.isnan("dist"))


def dense_scores(store: Store, vector: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """chunk_id, document_id, corpus_name, dist of all embedded chunks whose vector has the query's size and a direction."""
    of = _distances(store, vector).join(store.chunks(document_id=F.col("document_id")), "chunk_id")
    return of.join(_documents(store, names), "document_id").select("chunk_id", "document_id", "corpus_name", "dist")


def _details(store: Store, hits: DataFrame, most: int | None) -> DataFrame:
    """The hits, of which there are at most `most` (None: any number), with contents: rows of other chunks are left out where they lie."""
    few = F.broadcast if most is not None and most <= 10_000 else lambda df: df
    ids = few(hits.select("chunk_id"))
    own = replace(store, chunk=store.chunk.join(ids, "chunk_id", "left_semi"), stored=store.stored and (store.stored[0].join(ids, "chunk_id", "left_semi"), store.stored[1]))
    chunk = own.chunks(chunk_index=F.col("chunk_index"), content=F.col("content"), meta=F.col("meta"))
    doc = store.document.select("document_id", "title", "uri", F.col("meta").alias("doc_meta"))
    return chunk.join(few(few(hits).join(doc, "document_id")), "chunk_id")


def dense_search(store: Store, vector: Sequence[float], corpus: str, top_k: int | None = TOP_K, min_score: float = 0.0) -> DataFrame:
    """chunk_id, document_id, title, uri, chunk_index, content, score, meta, doc_meta of the `top_k` chunks of a corpus nearest to a vector, of
    a cosine of at least `min_score`; None: of all of them. An unknown corpus gives no rows; ties go to the smaller id. One pass and a top-k
    of each task."""
    near = dense_scores(store, vector, [corpus]).withColumn("score", F.round(1 - F.col("dist"), DECIMALS)).where(F.col("score") >= min_score)
    best = near if top_k is None else near.orderBy("dist", "chunk_id").limit(top_k)
    return _details(store, best, top_k).select("chunk_id", "document_id", "title", "uri", "chunk_index", "content", "score", "meta", "doc_meta")


def fts_search(store: Store, text: str, corpus: str, top_k: int = TEXT_TOP_K) -> DataFrame:
    """chunk_id, document_id, content, rank, meta of the `top_k` chunks that hold all words, densest first; raises ValueError for what is no
    text query."""
    query = parse_all(text, strict=True)
    if query is None:
        scored = text_scores(store, TextQuery(("",)), [corpus]).limit(0)
    else:
        scored = text_scores(store, query, [corpus])
    best = scored.orderBy(F.desc("score"), "chunk_id").limit(top_k)
    return _details(store, best, top_k).select("chunk_id", "document_id", "content", F.col("score").alias("rank"), "meta")


def hybrid(store: Store, vector: Sequence[float], text: str | None, k_by_corpus: Mapping[str, int], candidate_k: int | None = CANDIDATES, rrf_k: int = RRF_K, parser: str = "all") -> DataFrame:
    """The fused hits of several corpora, each with its own number: corpus_name, chunk_id, document_id, rrf_score, dense_rank, fts_rank.

    candidate_k hits of each list go into the fusion, or, if it is None, as many as are asked of the corpus. A missing rank is NULL and adds
    nothing. parser "all" joins all words by and and searches vectors only where the text is no query; "web" reads quotes, or and -.

    One pass over chunks and one over embeddings; both lists are ranked in one window, each chunk once for each list it is in.
    """
    query = (parse_all if parser == "all" else parse_web)(text)
    names = list(k_by_corpus)
    most = max([candidate_k if candidate_k is not None else k for k in k_by_corpus.values()], default=0)
    words = {} if query is None else {"_tokens": tokens(F.col("content"))}
    score = F.lit(None).cast("double") if query is None else text_score(F.col("_tokens"), query)
    chunk = store.chunks(words, document_id=F.col("document_id"), score=score).join(_distances(store, vector), "chunk_id", "left")
    lists = F.filter(F.array(F.struct(F.lit("d").alias("list"), F.col("dist").alias("by")), F.struct(F.lit("t").alias("list"), (-F.col("score")).alias("by"))), lambda x: x["by"].isNotNull())
    of = chunk.where("dist IS NOT NULL OR score IS NOT NULL").join(_documents(store, names), "document_id")
    entries = of.select("corpus_name", "chunk_id", "document_id", F.inline(lists))
    w = Window.partitionBy("corpus_name", "list").orderBy("by", "chunk_id")
    listed = entries.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    wanted = F.coalesce(*[F.when(F.col("corpus_name") == n, k) for n, k in k_by_corpus.items()], F.lit(0))
    if candidate_k is None:
        listed = listed.where(F.col("rank") <= wanted)
    rank = lambda name: F.max(F.when(F.col("list") == name, F.col("rank")))
    both = listed.repartition("corpus_name").groupBy("corpus_name", "chunk_id", "document_id").agg(rank("d").alias("dense_rank"), rank("t").alias("fts_rank"))
    part = lambda c: F.coalesce(F.lit(1.0) / (F.lit(float(rrf_k)) + F.col(c)), F.lit(0.0))
    best = Window.partitionBy("corpus_name").orderBy(F.desc("rrf_score"), "chunk_id")
    fused = both.withColumn("rrf_score", F.round(part("dense_rank") + part("fts_rank"), 12)).withColumn("_n", F.row_number().over(best))
    return fused.where(F.col("_n") <= wanted).select("corpus_name", "chunk_id", "document_id", "rrf_score", "dense_rank", "fts_rank")


def hybrid_search(store: Store, vector: Sequence[float], text: str | None, corpus: str, top_k: int = TOP_K, candidate_k: int | None = CANDIDATES, rrf_k: int = RRF_K, parser: str = "all") -> DataFrame:
    """chunk_id, document_id, title, uri, chunk_index, content, rrf_score, dense_rank, fts_rank, meta, doc_meta of one corpus."""
    hits = hybrid(store, vector, text, {corpus: top_k}, candidate_k, rrf_k, parser)
    return _details(store, hits, top_k).select("chunk_id", "document_id", "title", "uri", "chunk_index", "content", "rrf_score", "dense_rank", "fts_rank", "meta", "doc_meta")


def multi_corpus_search(store: Store, vector: Sequence[float], text: str | None, k_by_corpus: Mapping[str, int], **options) -> DataFrame:
    """chunk_id, corpus_name, title, content, rrf_score, dense_rank, fts_rank, meta of several corpora; order by rrf_score for the ranking over all."""
    hits = hybrid(store, vector, text, k_by_corpus, **options)
    return _details(store, hits, sum(k_by_corpus.values())).select("chunk_id", "corpus_name", "title", "content", "rrf_score", "dense_rank", "fts_rank", "meta")


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _parts(queries: DataFrame, query_id: str, most: int) -> Iterator[list]:
    """The queries on the driver, about `most` at a time; one empty part if there are none. Of several parts the next is fetched when it is asked for."""
    rows = queries.limit(most + 1).collect()
    if len(rows) <= most:
        yield rows
        return
    kept = cut(queries)  # computed once, whatever the number of parts
    n = -(-kept.count() // most)
    for i in range(n):
        yield kept.where(F.pmod(F.xxhash64(query_id), F.lit(n)) == i).collect()


def _searched(queries: DataFrame, query_id: str, most: int, prepare: Callable[[list], object], run: Callable[[object], DataFrame]) -> DataFrame:
    """The union of `run` over the parts of the queries. Of several parts each is written and its broadcast freed before the next is fetched."""
    context = queries.sparkSession.sparkContext
    out: DataFrame | None = None
    before = None
    for rows in _parts(queries, query_id, most):
        if before is not None:
            sent, part = before
            part = cut(part)
            sent.destroy()
            out = part if out is None else out.unionByName(part)
        sent = context.broadcast(prepare(rows))
        before = (sent, run(sent))
    part = before[1]
    return part if out is None else out.unionByName(cut(part))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batches put together until a column has `most` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def batch_text_search(store: Store, queries: DataFrame, k_by_kind: Mapping[str, int], query_id: str = "query_id", text: str = "query", corpus: str = "corpus", most: int = 100_000, block: int = 32_000_000) -> DataFrame:
    """query_id, corpus_name, chunk_id, score, rank: for each of many text queries the densest chunks of each corpus it asks.

    queries: query_id, text, corpus ("all", or a name), and k_<kind> columns that hold how many are wanted of a corpus of this kind (NULL: as
    `k_by_kind` says); a corpus of another kind gives the sum of all. Words are joined by and; a query without words finds nothing.

    The texts stay where they are: each task has the queries and makes postings of its texts, about `block` bytes at a time, over which queries of
    the same words are answered once. What is shuffled are the ids, to find repeated rows (see `only_last`), and of each block the hits that
    may be among those wanted. More than `most` queries are searched in parts, a pass for each, with one part at a time on the driver.
    """
    kind = F.regexp_extract(F.lower("name"), r"([^-]*)$", 1)
    corpora = store.corpus.select("corpus_id", F.col("name").alias("corpus_name"), kind.alias("kind"))
    of = bounded(store.document.select("document_id", "corpus_id").join(F.broadcast(corpora), "corpus_id").select("document_id", "corpus_name", "kind"), store.document, 300_000)
    repeated = store.stored is not None
    rows = only_last(store.stored[0].select("chunk_id", "created_at", "content", "document_id"), "chunk_id", ["created_at", "content"]) if repeated else store.chunk
    lines = rows.select("chunk_id", "document_id", words_only(F.col("content")).alias("line")).join(of, "document_id").select("chunk_id", "corpus_name", "kind", "line")
    kinds = list(k_by_kind)
    k_of = [F.coalesce(F.col(f"k_{k}"), F.lit(k_by_kind[k])).alias(f"_k_{k}") for k in kinds]
    asked = queries.select(query_id, F.array_sort(F.array_distinct(tokens(F.col(text)))).alias("terms"), F.col(corpus).alias("_corpus"), *k_of).where((F.size("terms") > 0) & F.col(query_id).isNotNull())
    id_type = queries.schema[query_id].dataType.simpleString()

    def prepare(part: list) -> tuple:
        """The vocabulary; ids of the queries, by the words they ask for; what each of them asks of which corpora."""
        number: dict[str, int] = {}
        alike: dict[tuple[int, ...], list] = {}
        for r in part:
            alike.setdefault(tuple(number.setdefault(t, len(number)) for t in r["terms"]), []).append((r[query_id], r["_corpus"], [r[f"_k_{k}"] for k in kinds]))
        return list(number), list(alike), [[i for i, _, _ in a] for a in alike.values()], [[(c, k) for _, c, k in a] for a in alike.values()]

    def run(sent) -> DataFrame:
        def limit(asks: tuple, name: str, of_kind: str) -> int:
            c, k = asks
            return (k[kinds.index(of_kind)] if of_kind in kinds else 0) if c == "all" else sum(k) if c == name else 0

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, sets, ids, asks = sent.value
            vocabulary = pa.array(words, pa.string())
            flat, begin = np.array([w for s in sets for w in s], np.int64), np.cumsum([0, *[len(s) for s in sets]])[:-1]
            limits: dict[tuple, np.ndarray] = {}  # of each corpus: how many each query of a set wants
            for rows in _blocks(batches, 3, block):
                places = Postings(rows.column(3), vocabulary)
                pairs = list(zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True))
                code = {p: i for i, p in enumerate(dict.fromkeys(pairs))}
                of_text = np.array([code[p] for p in pairs], np.int64)
                names = np.array([i or "" for i in rows.column(0).to_pylist()], object)
                order = np.empty(len(names), np.int64)
                order[np.argsort(names, kind="stable")] = np.arange(len(names))
                q, at, score, wanted = [], [], [], []
                for s in np.flatnonzero(np.minimum.reduceat(places.count[flat], begin) > 0).tolist() if sets else []:
                    for p in code:
                        if (s, p) not in limits:
                            limits[s, p] = np.array([limit(a, *p) for a in asks[s]], np.int64)
                    own = np.array([limits[s, p] for p in code])  # corpora x queries
                    largest = own.max(axis=1)
                    found, entries = places.holding(sets[s], of_text, largest > 0)
                    if not len(found):
                        continue
                    dense = rounded(places.densities(sets[s], entries), DECIMALS)
                    by = np.lexsort((order[found], -dense, of_text[found]))
                    found, dense = found[by], dense[by]
                    where = of_text[found]
                    place = np.arange(len(found)) - np.searchsorted(where, where)
                    for n, i in enumerate(ids[s]):
                        some = np.flatnonzero(place < own[where, n])
                        q += [i] * len(some)
                        at.append(found[some]), score.append(dense[some]), wanted.append(own[where[some], n])
                if q:
                    take = pa.array(np.concatenate(at))
                    chunk = {n: rows.column(i).take(take) for n, i in (("corpus_name", 1), ("chunk_id", 0))}
                    yield pa.RecordBatch.from_pydict({query_id: pa.array(q, _ARROW[id_type]), **chunk, "score": pa.array(np.concatenate(score)), "_limit": pa.array(np.concatenate(wanted))})

        return lines.mapInArrow(meet, f"`{query_id}` {id_type}, corpus_name string, chunk_id string, score double, _limit bigint")

    scored = _searched(asked, query_id, most, prepare, run)
    w = Window.partitionBy(query_id, "corpus_name").orderBy(F.desc("score"), "chunk_id")
    ranked = scored.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= F.col("_limit")).select(query_id, "corpus_name", "chunk_id", "score", "rank")


def _matrix(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, unit vectors) of a column of lists: those of n finite numbers that are not all 0."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    flat, starts = column.values, np.asarray(column.offsets)[:-1]
    rows = np.flatnonzero(sizes == n)
    values = np.asarray(flat.cast(pa.float64()).fill_null(float("nan")))  # of a vector with a NULL nothing is finite
    x = values[starts[rows][:, None] + np.arange(n)] if len(rows) else np.zeros((0, n))
    length = np.sqrt((x * x).sum(axis=1))
    ok = np.isfinite(length) & (length > 0)
    return rows[ok], x[ok] / length[ok, None]


def _nearest(embedding: DataFrame, sent, query_id: str, kind: str, top_k: int, block: int) -> DataFrame:
    """query_id, chunk_id, cosine: of each task's rows the top_k of each query, held as arrays of queries x top_k."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: (np.full((len(q), top_k), -np.inf), np.full((len(q), top_k), "", object)) for n, (_, q) in sent.value.items()}
        for batch in batches:
            for n, (_, q) in sent.value.items():
                rows, x = _matrix(batch.column(1), n)
                if not len(rows):
                    continue
                names = np.array(batch.column(0).to_pylist(), object)[rows]
                order = np.argsort(names, kind="stable")  # of ties the smaller id comes first
                names, x = names[order], x[order]
                score, who = best[n]
                for lo in range(0, len(q), block):
                    cos = np.round(q[lo : lo + block] @ x.T, DECIMALS)
                    both = np.concatenate([score[lo : lo + block], cos], axis=1)
                    label = np.concatenate([who[lo : lo + block], np.broadcast_to(names, cos.shape)], axis=1)
                    if both.shape[1] > 4 * top_k:  # all that reach the top_k-th, of which ties are more
                        last = -np.partition(-both, top_k - 1, axis=1)[:, top_k - 1]
                        wide = int((both >= last[:, None]).sum(axis=1).max())
                        some = np.argsort(-both, axis=1, kind="stable")[:, :wide] if wide > 4 * top_k else np.argpartition(-both, wide - 1, axis=1)[:, :wide]
                        both, label = np.take_along_axis(both, some, axis=1), np.take_along_axis(label, some, axis=1)
                    for j in range(len(both)):
                        top = np.lexsort((label[j].astype(str), -both[j]))[:top_k]
                        score[lo + j], who[lo + j] = both[j, top], label[j, top]
        ids, found, cosines = [], [], []
        for n, (score, who) in best.items():
            at, place = np.nonzero(np.isfinite(score))
            ids += [sent.value[n][0][i] for i in at]
            found += who[at, place].tolist()
            cosines += score[at, place].tolist()
        yield pa.RecordBatch.from_pydict({query_id: pa.array(ids, _ARROW[kind]), "chunk_id": pa.array(found, pa.string()), "cosine": pa.array(cosines, pa.float64())})

    return embedding.mapInArrow(near, f"`{query_id}` {kind}, chunk_id string, cosine double")


def batch_dense_search(store: Store, vectors: DataFrame, top_k: int = TOP_K, query_id: str = "query_id", vector: str = "vector", block: int = 1024, most: int = 100_000) -> DataFrame:
    """query_id, chunk_id, cosine, rank: the nearest chunks of each of many query vectors, over all corpora, exactly.

    The queries, `most` at a time, go to every task, which compares its chunks with them in blocks of matrix products and keeps top_k of each
    query; the tasks' lists are then merged. Vectors of unlike sizes and without a direction are not compared.
    """
    kind = vectors.schema[query_id].dataType.simpleString()
    asked = vectors.where(F.size(vector) > 0).select(query_id, F.col(vector).cast("array<float>").alias("v"))

    def prepare(rows: list) -> dict:
        by_size: dict[int, list] = {}
        for r in rows:
            v = np.array(r["v"], np.float64)
            if np.isfinite(v).all() and v.any():
                by_size.setdefault(len(v), []).append((r[query_id], v / np.linalg.norm(v)))
        return {n: ([i for i, _ in qs], np.array([v for _, v in qs])) for n, qs in by_size.items()}

    embedding = store.vectors(v=F.col("v"))
    found = _searched(asked, query_id, most, prepare, lambda sent: _nearest(embedding, sent, query_id, kind, top_k, block))
    w = Window.partitionBy(query_id).orderBy(F.desc("cosine"), "chunk_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top_k)


def inverted_index(chunks: DataFrame, key: str = "chunk_id", text: str = "content") -> DataFrame:
    """term, chunk_id, positions: where each word stands; written by term, it prunes a search to the files of its words."""
    return chunks.select(key, F.posexplode(tokens(F.col(text))).alias("pos", "term")).groupBy("term", key).agg(F.array_sort(F.collect_list("pos")).alias("positions"))


__all__ = ["cosine", "dense_search", "fts_search", "hybrid", "hybrid_search", "multi_corpus_search", "batch_text_search", "batch_dense_search", "inverted_index", "density", "text_score", "text_scores"]
