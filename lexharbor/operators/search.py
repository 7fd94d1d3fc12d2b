"""Search requests as a whole: reading, ranking, the context text, and the tools around it."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexharbor.functions.metadata import source_label
from lexharbor.functions.queries import DEFAULT_K, Resolved, corpus_kind, normalized_query, resolve
from lexharbor.operators.embed import Embedder
from lexharbor.operators.retrieval import multi_corpus_search
from lexharbor.operators.store import Store

# The sections of a context text in their order, and the metadata field that names an entry there.
SECTIONS = (("commands", "### Commands", "command_name"), ("functions", "### Functions", "function_signature"), ("programming", "### Concepts & Patterns", None), ("code", "### Code Examples from Project", None))
TITLE = "## Relevant Documentation\n"
# What a caller is told to do next, by the kind of search.
GUIDANCE = {
    "syntax": "Syntax-first retrieval active.",
    "concept": "Concept-first retrieval active.",
    "deep": "Concept-first retrieval active.",
    None: "General docs retrieval active.",
}


@dataclass(frozen=True)
class SearchRequest:
    """A query, the corpus ("all", or the kind or name of one) and how many results of each kind are wanted."""

    query: str
    corpus: str = "all"
    k_commands: int = DEFAULT_K["commands"]
    k_functions: int = DEFAULT_K["functions"]
    k_programming: int = DEFAULT_K["programming"]

    def k(self) -> dict[str, int]:
        return {"commands": self.k_commands, "functions": self.k_functions, "programming": self.k_programming}


def wanted(corpora: list[str], request: SearchRequest) -> dict[str, int]:
    """How many results of each corpus: with "all" those of its kind (none of kinds without a number), of a single corpus the sum of all."""
    kind = lambda name: name.lower().rsplit("-", 1)[-1]
    if request.corpus == "all":
        return {name: request.k()[kind(name)] for name in corpora if request.k().get(kind(name), 0) > 0}
    return {name: sum(request.k().values()) for name in corpora if request.corpus in (name, kind(name))}


def context_text(hits: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """`by`, context_text: the hits as one text, in sections by kind of corpus, each in the order of its ranking.

    hits: corpus_name, chunk_id, content, meta (JSON text), rrf_score. Corpora of unknown kinds go to the third section; entries of the first
    two begin with their name, empty if there is none. A hit list is bounded by what was asked for, so it is put together in one row.
    """
    keys = list(by)
    kind = corpus_kind(F.col("corpus_name"))
    at = F.coalesce(*[F.when(kind == name, i) for i, (name, _, _) in enumerate(SECTIONS)], F.lit(2))
    name = F.coalesce(*[F.when(F.col("_at") == i, F.coalesce(F.get_json_object("meta", f"$.{f}"), F.lit(""))) for i, (_, _, f) in enumerate(SECTIONS) if f], F.lit(None).cast("string"))
    body = F.when(name.isNotNull(), F.concat(F.lit("**"), name, F.lit("**\n"), F.col("content"), F.lit("\n"))).otherwise(F.concat(F.col("content"), F.lit("\n")))
    rows = hits.withColumn("_at", at).withColumn("_body", body)
    all_ = F.array_sort(F.collect_list(F.struct("_at", (-F.col("rrf_score")).alias("s"), "chunk_id", "_body")))
    put = rows.groupBy(*keys).agg(all_.alias("_all"))
    parts: list[Column] = [F.array(F.lit(TITLE))]
    for i, (_, head, _) in enumerate(SECTIONS):
        own = _bodies(i)
        parts.append(F.when(F.size(own) > 0, F.concat(F.array(F.lit(head)), own)).otherwise(F.array().cast("array<string>")))
    return put.select(*keys, F.array_join(F.concat(*parts), "\n").alias("context_text"))


def _bodies(section: int) -> Column:
    return F.transform(F.filter("_all", lambda x: x["_at"] == section), lambda x: x["_body"])


def source_labels(hits: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """`by`, sources ARRAY<STRING>: the labels of the hits, each once, in order."""
    label = source_label(F.col("meta"), F.col("corpus_name"))
    return hits.groupBy(*by).agg(F.array_sort(F.collect_set(label)).alias("sources"))


def hit_counts(hits: DataFrame, by: Iterable[str] = (), item: str = "chunk_id") -> DataFrame:
    """`by`, chunk_count BIGINT, corpora BIGINT: how many chunks an answer has, repeated hits counted once, and of how many corpora."""
    keys = list(by)
    one = hits.groupBy(*keys, item, "corpus_name").agg(F.count(F.lit(1)).alias("_n"))  # repeated hits are reduced where they lie
    return one.groupBy(*keys).agg(F.countDistinct(item).alias("chunk_count"), F.countDistinct("corpus_name").alias("corpora"))


def search(store: Store, request: SearchRequest, embedder: Embedder, **options) -> dict:
    """The answer to a request: query, chunks, context_text, embed_ms, search_ms. A blank query raises ValueError.

    One plan over all corpora asked for; what comes to the driver are the hits, no more than the request's numbers add up to."""
    if not request.query.strip():
        raise ValueError("query must not be blank")
    began = time.perf_counter()
    embedder.load()
    vector = embedder.encode([request.query])[0].tolist()
    embedded = time.perf_counter()
    names = [r["name"] for r in store.corpus.select("name").collect()]
    found = multi_corpus_search(store, vector, request.query, wanted(names, request), **options)
    rows = [r.asDict() for r in found.orderBy(F.desc("rrf_score"), "chunk_id").collect()]
    spark = store.corpus.sparkSession
    context = TITLE
    if rows:
        context = context_text(spark.createDataFrame(rows, found.schema)).first()["context_text"]
    return {"query": request.query, "chunks": rows, "context_text": context, "embed_ms": (embedded - began) * 1e3, "search_ms": (time.perf_counter() - embedded) * 1e3}


def tool_search(store: Store, tool: str, args: dict, embedder: Embedder, rewrite: bool = True) -> dict:
    """The answer of a tool (syntax, concepts, docs): presets filled in, German queries rewritten, hits with sources and guidance."""
    asked: Resolved = resolve(tool, args)
    spark = store.corpus.sparkSession
    told = {"query_effective": asked.query, "query_language": "en", "rewrite_applied": False, "rewrite_reason": None}
    if rewrite:
        one = spark.createDataFrame([(asked.query, args.get("query_language"), args.get("query_en"))], "q string, l string, e string")
        told = one.select(normalized_query(F.col("q"), F.col("l"), F.col("e")).alias("n")).first()["n"].asDict()
    request = SearchRequest(told["query_effective"], asked.kind, **{f"k_{k}": n for k, n in asked.k.items()})
    answer = search(store, request, embedder)
    def label(c: dict) -> str:
        meta = json.loads(c["meta"] or "{}")
        return next((meta[f] for f in ("command_name", "function_signature", "section") if meta.get(f) is not None), c["corpus_name"])

    return {
        "tool": tool, "query_original": asked.query, **told, "retrieval_mode": asked.mode, "effective_retrieval": {"corpus": asked.kind, **asked.k}, "guidance": GUIDANCE.get(asked.mode, GUIDANCE[None]),
        "sources": sorted({label(c) for c in answer["chunks"]}), "chunk_count": len(answer["chunks"]), **answer,
    }


def health(embedder: Embedder) -> dict:
    return {"status": "ok", "model": embedder.name}


# Error numbers of the JSON-RPC standard.
NO_METHOD, NO_TOOL, FAILED = -32601, -32602, -32603
TOOLS = ("syntax", "concepts", "docs")


def answer(message: dict, call: Callable[[str, dict], dict]) -> dict | None:
    """The reply to one JSON-RPC message; None for a notification. Failures of a tool are results marked as errors."""
    id_, method, params = message.get("id"), message.get("method"), message.get("params") or {}
    reply = {"jsonrpc": "2.0", "id": id_}
    if method == "notifications/initialized" or method == "initialized":
        return None
    if method == "initialize":
        return reply | {"result": {"capabilities": {"tools": {}}, "serverInfo": {"name": "lexharbor"}}}
    if method == "ping":
        return reply | {"result": {}}
    if method == "tools/list":
        return reply | {"result": {"tools": [{"name": t} for t in TOOLS]}}
    if method == "tools/call":
        if params.get("name") not in TOOLS:
            return reply | {"error": {"code": NO_TOOL, "message": f"Unknown tool: {params.get('name')}"}}
        try:
            text, bad = json.dumps(call(params["name"], params.get("arguments") or {}), default=str), False
        except Exception as e:  # any failure of the tool is told to the caller
            text, bad = f"search error: {e}", True
        return reply | {"result": {"content": [{"type": "text", "text": text}], "isError": bad}}
    return reply | {"error": {"code": NO_METHOD, "message": f"Unknown method: {method}"}}


def serve(lines: Iterable[str], call: Callable[[str, dict], dict]) -> Iterator[str]:
    """One reply line for each message line that asks for one; lines that are no JSON object are passed over."""
    for line in lines:
        try:
            message = json.loads(line)
        except ValueError:
            continue
        if isinstance(message, dict) and (reply := answer(message, call)) is not None:
            yield json.dumps(reply)
