import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexharbor.functions.queries import TextQuery, looks_german, normalize_k, normalized_query, parse_all, parse_web, resolve, rewrite_german
from lexharbor.operators import postings, retrieval
from lexharbor.operators.embed import HashingEmbedder
from lexharbor.operators.search import SearchRequest, answer, search, serve, tool_search, wanted
from lexharbor.operators.store import Store
from pyspark.sql import functions as F

NAMES = ("a-commands", "a-functions", "a-programming", "a-code")


def make(spark, texts, dim=8):
    """A store of texts, dealt to the corpora in turn, with hashed vectors; every fifth has none."""
    model = HashingEmbedder(dim)
    corpus = spark.createDataFrame([(f"k{i}", n, None) for i, n in enumerate(NAMES)], "corpus_id string, name string, description string")
    document = spark.createDataFrame([(f"d{i:03d}", f"k{i % 4}", f"e{i}", f"T{i}", None, "{}") for i in range(len(texts))], "document_id string, corpus_id string, external_id string, title string, uri string, meta string")
    chunk = spark.createDataFrame([(f"c{i:03d}", f"d{i:03d}", 0, t, '{"command_name": "N%d"}' % i) for i, t in enumerate(texts)], "chunk_id string, document_id string, chunk_index int, content string, meta string")
    vectors = model.encode([t or "" for t in texts])
    embedding = spark.createDataFrame([(f"c{i:03d}", "m", dim, v.tolist()) for i, v in enumerate(vectors) if i % 5], "chunk_id string, model string, embedding_dim int, v array<float>")
    return Store(corpus, document, chunk, embedding), model


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(2)
    return [" ".join(rnd.choice("red green blue box lamp pump valve".split()) for _ in range(rnd.randint(0, 14))) for _ in range(80)] + ["", None]


@pytest.fixture(scope="module")
def made(spark, texts):
    return make(spark, texts)


def brute_density(tokens, terms):
    best = {}
    for r in range(len(tokens)):
        for l in range(r, -1, -1):
            if set(terms) <= set(tokens[l : r + 1]):
                best.setdefault(l, r)
                break
    return sum(1 / (1 + sum(t not in terms for t in tokens[l : r + 1])) for l, r in best.items())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcx"), max_size=14), st.sampled_from([["a"], ["a", "b"], ["a", "b", "c"]]))
def test_density_against_brute_force(tokens, terms):
    assert abs(retrieval.density(tokens, [[(t,)] for t in terms]) - brute_density(tokens, terms)) < 1e-9


def brute_cover(tokens, wanted):
    """Over all spans: those that hold one of each group and no shorter one that does."""
    holds = lambda l, r: all(any(tuple(tokens[i : i + len(p)]) == p for p in g for i in range(l, r + 2 - len(p))) for g in wanted)
    spans = [(l, r) for l in range(len(tokens)) for r in range(l, len(tokens)) if holds(l, r)]
    least = [(l, r) for l, r in spans if not any((a, b) != (l, r) and l <= a and b <= r for a, b in spans)]
    words = {w for g in wanted for p in g for w in p}
    return sum(1 / (1 + sum(t not in words for t in tokens[l : r + 1])) for l, r in least)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abcx"), max_size=14), st.lists(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=2).map(tuple), min_size=1, max_size=2), min_size=1, max_size=3))
def test_density_of_alternatives_and_phrases_against_brute_force(tokens, wanted):
    assert abs(retrieval.density(tokens, wanted) - brute_cover(tokens, wanted)) < 1e-9


def test_next_door_hits_come_first_with_alternatives():
    wanted = retrieval.groups(parse_web("a or b c"))
    scores = [retrieval.density(t.split(), wanted) for t in ("x a c x", "a " + "x " * 50 + "c", "a a a " + "x " * 60 + "c")]
    assert scores[0] == 1 and scores[0] > scores[1] > scores[2]


def test_text_scores(spark, made, texts):
    store, _ = made
    for terms in (("red",), ("red", "box"), ("red", "box", "lamp")):
        got = {r.chunk_id: r.score for r in retrieval.text_scores(store, TextQuery(terms)).collect()}
        want = {f"c{i:03d}": round(brute_density(t.split(), terms), 9) for i, t in enumerate(texts) if t and set(terms) <= set(t.split())}
        assert got == pytest.approx(want)


def test_matches(spark):
    df = spark.createDataFrame([(["red", "big", "box"],), (["box", "red"],), ([],), (["lamp"],)], "t array<string>")
    count = lambda text: df.where(retrieval.matches(F.col("t"), parse_web(text))).count()
    assert [count(q) for q in ("red box", '"red big" box', '"red box"', "lamp or box", "red -big", "lamp or red box", '"red big" or lamp')] == [2, 1, 0, 3, 1, 2, 2]


def cosines(model, texts, query):
    q = model.encode([query])[0].astype(np.float64)
    return {i: round(1 - float(v @ q / (np.linalg.norm(v) * np.linalg.norm(q))), 9) for i, v in enumerate(model.encode([t or "" for t in texts]).astype(np.float64)) if i % 5 and np.linalg.norm(v)}


def test_hybrid_against_brute_force(spark, made, texts):
    store, model = made
    query = "red box"
    far = cosines(model, texts, query)
    k = {"a-commands": 3, "a-functions": 2, "a-programming": 5, "nowhere": 4}
    for candidates in (40, 3, None):
        got = {}
        for r in retrieval.hybrid(store, model.encode([query])[0].tolist(), query, k, candidates).collect():
            got.setdefault(r.corpus_name, {})[r.chunk_id] = (r.dense_rank, r.fts_rank, r.rrf_score)
        want = {}
        for c, name in enumerate(NAMES[:3]):
            most = k[name] if candidates is None else candidates
            dense = sorted((d, f"c{i:03d}") for i, d in far.items() if i % 4 == c)[:most]
            text = sorted((-round(brute_density(t.split(), ["red", "box"]), 9), f"c{i:03d}") for i, t in enumerate(texts) if i % 4 == c and t and {"red", "box"} <= set(t.split()))[:most]
            dr, tr = ({i: n for n, (_, i) in enumerate(x, 1)} for x in (dense, text))
            score = {i: round((1 / (60 + dr[i]) if i in dr else 0) + (1 / (60 + tr[i]) if i in tr else 0), 12) for i in {*dr, *tr}}
            want[name] = {i: (dr.get(i), tr.get(i), score[i]) for i in sorted(score, key=lambda i: (-score[i], i))[: k[name]]}
        assert got == want


def test_single_searches(spark, made, texts):
    store, model = made
    q = model.encode(["red box"])[0].tolist()
    assert retrieval.dense_search(store, q, "nowhere").count() == 0 and retrieval.dense_search(store, [1.0] * 9, "a-code").count() == 0
    near = retrieval.dense_search(store, q, "a-code", 4).orderBy(F.desc("score"), "chunk_id").collect()
    far = sorted((d, f"c{i:03d}") for i, d in cosines(model, texts, "red box").items() if i % 4 == 3 and d <= 1)[:4]
    assert [(round(1 - r.score, 9), r.chunk_id) for r in near] == [(pytest.approx(d), i) for d, i in far]
    with pytest.raises(ValueError):
        retrieval.fts_search(store, "red & box", "a-code")
    assert retrieval.fts_search(store, "red box", "a-code", 2).count() == 2 and retrieval.fts_search(store, "  ", "a-code").count() == 0
    assert {r.fts_rank for r in retrieval.hybrid_search(store, q, "red & box", "a-code").collect()} == {None}


def test_batches(spark, made, texts):
    store, model = made
    asks = [(1, "red box", "all", 2, None, 1), (2, "lamp", "a-code", 1, 1, 1), (3, "", "all", 1, 1, 1), (4, "unknownword red", "all", 1, 1, 1), (5, "red", "nowhere", 1, 1, 1), (6, None, "all", 1, 1, 1)]
    queries = spark.createDataFrame(asks, "query_id long, query string, corpus string, k_commands int, k_functions int, k_programming int")
    got = {}
    for r in retrieval.batch_text_search(store, queries, {"commands": 4, "functions": 4, "programming": 10}).collect():
        got.setdefault((r.query_id, r.corpus_name), []).append((r["rank"], r.chunk_id))
    want = {}
    for q, terms, limits in ((1, ["red", "box"], {"a-commands": 2, "a-functions": 4, "a-programming": 1}), (2, ["lamp"], {"a-code": 3})):
        for name, k in limits.items():
            score = sorted((-round(brute_density(t.split(), terms), 9), f"c{i:03d}") for i, t in enumerate(texts) if NAMES[i % 4] == name and t and set(terms) <= set(t.split()))
            want[q, name] = [(n, i) for n, (_, i) in enumerate(score[:k], 1)]
    assert {a: sorted(b) for a, b in got.items()} == {a: b for a, b in want.items() if b}
    vectors = spark.createDataFrame([(n, model.encode([t])[0].tolist()) for n, t in enumerate(["red box", "lamp", "pump"])] + [(8, [1.0]), (9, None), (10, [0.0] * 8)], "query_id long, vector array<float>")
    near = {}
    for r in retrieval.batch_dense_search(store, vectors, 7).collect():
        near.setdefault(r.query_id, []).append((r["rank"], r.chunk_id))
    for n, t in enumerate(["red box", "lamp", "pump"]):
        assert [i for _, i in sorted(near[n])] == [i for _, i in sorted((d, f"c{i:03d}") for i, d in cosines(model, texts, t).items())[:7]]


def test_many_queries_are_searched_in_parts(spark, made, texts, monkeypatch):
    store, model = made
    words = "red green blue box lamp pump valve".split()
    asks = spark.createDataFrame([(i, f"{words[i % 7]} {words[i // 7 % 7]}", "all", 3, 3, 3) for i in range(49)], "query_id long, query string, corpus string, k_commands int, k_functions int, k_programming int")
    sizes = []
    whole = {tuple(r) for r in retrieval.batch_text_search(store, asks, {"commands": 4, "functions": 4, "programming": 4}).collect()}
    parts = retrieval._parts
    monkeypatch.setattr(retrieval, "_parts", lambda *a: (sizes.append(len(p)) or p for p in parts(*a)))
    assert {tuple(r) for r in retrieval.batch_text_search(store, asks, {"commands": 4, "functions": 4, "programming": 4}, most=10).collect()} == whole and whole
    assert len(sizes) == 5 and max(sizes) < 25 and sum(sizes) == 49
    vectors = spark.createDataFrame([(i, model.encode([w])[0].tolist()) for i, w in enumerate(words)], "query_id long, vector array<float>")
    rows = lambda most: {(r.query_id, r["rank"], r.chunk_id, r.cosine) for r in retrieval.batch_dense_search(store, vectors, 4, most=most).collect()}
    assert rows(2) == rows(100)


def test_dense_batches_with_ties(spark, made):
    store, model = made
    same = spark.createDataFrame([(f"c{i:03d}", "m", 2, [float(i % 3), 1.0]) for i in range(90)] + [("n1", "m", 2, [None, 1.0]), ("n2", "m", 2, None), ("n3", "m", 2, [0.0, 0.0]), ("n4", "m", 2, [float("nan"), 1.0])], "chunk_id string, model string, embedding_dim int, v array<float>")
    vectors = spark.createDataFrame([(1, [0.0, 1.0]), (2, [2.0, 1.0])], "query_id long, vector array<float>")
    got = retrieval.batch_dense_search(Store(store.corpus, store.document, store.chunk, same.repartition(3)), vectors, 4).collect()
    assert sorted((r.query_id, r["rank"], r.chunk_id) for r in got) == [(q, n + 1, f"c{3 * n + (q - 1) * 2:03d}") for q in (1, 2) for n in range(4)]


def test_searches_read_no_contents_but_of_the_hits(spark, tmp_path, made):
    store, model = made
    folder = str(tmp_path)
    for name in ("corpus", "document", "chunk", "embedding"):
        getattr(store, name).withColumn("created_at", F.lit("2025-01-01").cast("timestamp")).write.parquet(f"{folder}/rag_{name}.parquet")
    from lexharbor.operators.store import read_store

    repeated = read_store(spark, folder)
    q = model.encode(["red box"])[0].tolist()
    plan = retrieval.dense_search(repeated, q, "a-code")._jdf.queryExecution().executedPlan().toString()
    assert sum("content#" in line and "ReadSchema" in line for line in plan.split("\n")) <= 1
    scores = retrieval.dense_scores(repeated, q)._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in scores and "meta#" not in scores and "content:string" not in scores
    assert {tuple(r) for r in retrieval.dense_search(repeated, q, "a-code").collect()} == {tuple(r) for r in retrieval.dense_search(store, q, "a-code").collect()}


def test_later_rows_replace_earlier_ones_in_batches(spark, made):
    store, _ = made
    at = lambda d: F.lit(d).cast("timestamp")
    old = store.chunk.withColumn("content", F.lit("red box")).withColumn("created_at", at("2025-01-01"))
    both = old.unionByName(store.chunk.withColumn("created_at", at("2025-02-01")))
    asks = spark.createDataFrame([(1, "red box", "all", 9, 9, 9)], "query_id long, query string, corpus string, k_commands int, k_functions int, k_programming int")
    dirty = Store(store.corpus, store.document, store.chunk, store.embedding, (both, store.embedding))
    k = {"commands": 4, "functions": 4, "programming": 4}
    assert {tuple(r) for r in retrieval.batch_text_search(dirty, asks, k).collect()} == {tuple(r) for r in retrieval.batch_text_search(store, asks, k).collect()}


def test_of_rows_equally_new_the_greatest_text_is_searched_in_batches(spark, made):
    store, _ = made
    at = F.lit("2025-02-01").cast("timestamp")
    one = store.chunk.withColumn("created_at", at)
    both = one.unionByName(one.withColumn("content", F.lit("a red box"))).unionByName(one.withColumn("content", F.lit("zebra")))
    asks = spark.createDataFrame([(1, "red box", "all", 9, 9, 9), (2, "zebra", "all", 2, 2, 2)], "query_id long, query string, corpus string, k_commands int, k_functions int, k_programming int")
    dirty = Store(store.corpus, store.document, store.chunk, store.embedding, (both, store.embedding))
    rows = retrieval.batch_text_search(dirty, asks, {"commands": 4, "functions": 4, "programming": 4}).collect()
    assert {r.query_id for r in rows} == {2} and len(rows) == 6


def test_batches_shuffle_no_more_hits_than_may_be_wanted(spark, monkeypatch):
    store, _ = make(spark, ["red box " + "pump " * (i % 7) for i in range(400)])
    store = Store(store.corpus, store.document, store.chunk.coalesce(1), store.embedding)
    asks = spark.createDataFrame([(i, "box red" if i % 2 else "Red, box", "all" if i < 6 else "a-code", 2, 1, None) for i in range(8)], "query_id long, query string, corpus string, k_commands int, k_functions int, k_programming int")
    k = {"commands": 4, "functions": 4, "programming": 3}
    searched, found = retrieval._searched, []
    monkeypatch.setattr(retrieval, "_searched", lambda *a: found.append(searched(*a)) or found[-1])
    whole = {tuple(r) for r in retrieval.batch_text_search(store, asks, k).collect()}
    assert len(whole) == found[0].count() == 8 * 6  # of 400 texts that hold the words
    assert {tuple(r) for r in retrieval.batch_text_search(store, asks, k, block=1).collect()} == whole
    names = [r.chunk_id for r in retrieval.batch_text_search(store, asks, k).where("query_id = 0 AND corpus_name = 'a-programming'").orderBy("rank").collect()]
    assert names == ["c002", "c006", "c010"]  # equally dense: the least ids


@given(st.lists(st.text("abcd ", max_size=30), max_size=8), st.sets(st.sampled_from("abcde"), min_size=1), st.sampled_from([1, 1 << 20]))
def test_postings_give_the_densities_of_texts(texts, words, held):
    lines = [" ".join(" ".join(t.replace(" ", "")).split()) for t in texts] + [None]
    places = postings.Postings(pa.array(lines, pa.string()), pa.array(list("abcde")))
    asked = ["abcde".index(w) for w in words]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(postings, "HELD", held)
        found, entries = places.holding(asked, np.arange(len(lines)) % 2, np.array([True, False]))
        assert found.tolist() == [i for i, t in enumerate(lines) if i % 2 == 0 and t and words <= set(t.split())]
        if len(found):
            assert places.densities(asked, entries).tolist() == [retrieval.density(lines[i].split(), [[(w,)] for w in words]) for i in found]


def test_scores_are_rounded_as_in_sql():
    x = np.array([1 / 1024, 0.5 + 1 / 1024, 1 / 3, 2.0, 0.0])
    assert postings.rounded(x, 9).tolist() == [0.000976563, 0.500976563, 0.333333333, 2.0, 0.0]


def test_index_holds_every_word(spark, made, texts):
    rows = {(r.term, r.chunk_id): list(r.positions) for r in retrieval.inverted_index(made[0].chunk).collect()}
    want = {}
    for i, t in enumerate(texts):
        for p, w in enumerate((t or "").split()):
            want.setdefault((w, f"c{i:03d}"), []).append(p)
    assert rows == want


def test_query_texts():
    assert parse_all(" red  Box red ") == TextQuery(("red", "box")) and parse_all("") is None and parse_all("o'x") is None and parse_all("a\tb") == TextQuery(("a", "b"))
    assert parse_web('a "b c" -d or e') == TextQuery(("a", "e"), (), (("b", "c"),), ("d",)) and parse_web("or") is None
    assert parse_web("a or b c") == TextQuery(("c",), ((("a",), ("b",)),)) and parse_web(' "" - ') is None and parse_web(None) is None
    assert parse_web('"a b" or c OR d -"e f"') == TextQuery((), ((("a", "b"), ("c",), ("d",)),), (), ("e", "f"))
    assert [normalize_k(x, 7) for x in (None, "abc", 0, 31, 2.5, "3", float("nan"), float("inf"), "")] == [1, 7, 1, 30, 3, 3, 7, 7, 1]
    assert resolve("concepts", {"query": "x", "deep": True}).k == {"commands": 2, "functions": 2, "programming": 20}
    assert resolve("concepts", {"query": "x"}).kind == "programming" and resolve("docs", {"query": "x", "mode": "concept", "k_programming": 14}).k["programming"] == 14
    assert resolve("docs", {"query": " x ", "corpus": "nope"}).kind == "all" and resolve("docs", {"query": "x", "mode": "odd"}).mode is None
    for bad in ({"query": " "}, {}):
        with pytest.raises(ValueError):
            resolve("syntax", bad)


def test_german(spark):
    rows = ["Wie ist die exakte Syntax von x inklusive Parametern?", "how to use syntax here", "fehlerübersicht", "Fehler", "use it", "und", "x und y", "Liste der FEHLER  hier", None]
    df = spark.createDataFrame([(r,) for r in rows], "q string")
    q = F.col("q")
    assert [r[0] for r in df.select(looks_german(q)).collect()] == [True, True, True, False, False, False, True, True, None]
    assert [r[0] for r in df.select(rewrite_german(q)).collect()][:3] == ["how ist die exakte syntax von x including parameters?", "how to use syntax here", "errorübersicht"]
    got = [r[0] for r in df.select(normalized_query(q)).collect()]
    assert [g.rewrite_reason for g in got] == ["de-to-en normalization", "de-detected-no-change", "de-to-en normalization", None, None, None, "de-to-en normalization", "de-to-en normalization", None]
    forced = df.limit(1).select(normalized_query(q, F.lit("de"), F.lit(" english "))).first()[0]
    assert tuple(forced) == ("english", "en", True, "query_en override")


def test_requests_and_tools(spark, made):
    store, model = made
    request = SearchRequest("red box", "all", 2, 1, 3)
    assert wanted(list(NAMES), request) == {"a-commands": 2, "a-functions": 1, "a-programming": 3} and wanted(list(NAMES), SearchRequest("x", "code")) == {"a-code": 18} and wanted(list(NAMES), SearchRequest("x", "odd")) == {}
    got = search(store, request, model)
    assert len(got["chunks"]) == 6 and [c["rrf_score"] for c in got["chunks"]] == sorted((c["rrf_score"] for c in got["chunks"]), reverse=True)
    heads = [line for line in got["context_text"].split("\n") if line.startswith("#")]
    assert heads == ["## Relevant Documentation", "### Commands", "### Functions", "### Concepts & Patterns"] and "**N" in got["context_text"]
    assert search(store, SearchRequest("red", "odd"), model)["chunks"] == []
    with pytest.raises(ValueError):
        search(store, SearchRequest(" "), model)
    told = tool_search(store, "syntax", {"query": "rote und red box", "k_commands": 1}, model)
    assert told["rewrite_applied"] and told["query_effective"] == "rote and red box" and told["effective_retrieval"]["commands"] == 1 and told["chunk_count"] == len(told["chunks"]) and told["sources"] == sorted(told["sources"])


def test_messages():
    call = lambda tool, args: {"tool": tool, "n": 1 / args["n"]}
    lines = ["", "no json", "[1]", '{"id": 1, "method": "ping"}', '{"method": "notifications/initialized"}', '{"id": 2, "method": "tools/call", "params": {"name": "docs", "arguments": {"n": 2}}}', '{"id": 3, "method": "tools/call", "params": {"name": "docs", "arguments": {"n": 0}}}', '{"id": 4, "method": "odd"}', '{"id": 5, "method": "tools/call", "params": {"name": "odd"}}']
    import json

    out = [json.loads(x) for x in serve(lines, call)]
    assert [m["id"] for m in out] == [1, 2, 3, 4, 5] and json.loads(out[1]["result"]["content"][0]["text"])["n"] == 0.5
    assert out[2]["result"]["isError"] and out[3]["error"]["code"] == -32601 and out[4]["error"]["code"] == -32602
    assert [t["name"] for t in answer({"id": 1, "method": "tools/list"}, call)["result"]["tools"]] == ["syntax", "concepts", "docs"]
    assert list(itertools.islice(serve([], call), 1)) == []


def test_flags_and_blank_queries(spark):
    from lexharbor.functions.queries import asked, flag

    df = spark.createDataFrame([(x,) for x in ("1", " Yes", "ON ", "TRUE", "0", "", "\u00a0", None)], "t string")
    assert [r[0] for r in df.select(flag(F.col("t"))).collect()] == [True] * 4 + [False] * 4 and df.select(flag(F.col("t"), True)).collect()[-1][0] is True
    assert [r[0] for r in df.select(asked(F.col("t"))).collect()] == [True] * 5 + [False] * 3
