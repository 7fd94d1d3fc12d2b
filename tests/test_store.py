import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lexharbor.operators import store as st
from lexharbor.operators.dedup import last_wins
from lexharbor.operators.embed import HashingEmbedder, embed, embed_pending
from lexharbor.sources import files
from lexharbor.streaming.resume import embed_stream

T = dt.datetime(2025, 1, 1)
LATER = dt.datetime(2025, 2, 1)


def empty(spark):
    corpus = spark.createDataFrame([(f"k{i}", n, None, T) for i, n in enumerate(("a-commands", "a-functions", "a-programming", "a-code"))], "corpus_id string, name string, description string, created_at timestamp")
    document = spark.createDataFrame([], "document_id string, corpus_id string, external_id string, title string, uri string, hash_sha256 string, meta string, created_at timestamp, updated_at timestamp")
    chunk = spark.createDataFrame([], "chunk_id string, document_id string, chunk_index int, content string, char_start int, char_end int, meta string, created_at timestamp")
    embedding = spark.createDataFrame([], "chunk_id string, model string, embedding_dim int, v array<float>, created_at timestamp")
    return st.Store(corpus, document, chunk, embedding)


def records(spark, rows):
    return spark.createDataFrame([(i, t, json.dumps(m) if m is not None else None, e, p) for i, t, m, e, p in rows], "id string, text string, metadata string, embedding array<float>, pos int")


def test_import_twice_and_sync(spark):
    rows = [
        ("x", "old", {"source": "CommandRef", "command_name": "X"}, [1.0, 0.0], 1),
        ("x", "new", {"source": "CommandRef", "command_name": "", "section": "S", "n": 1}, [0.0, 1.0], 2),
        ("x", "other corpus", {"source": "FunctionRef"}, [1.0, 1.0], 3),
        ("y", "lost", {"source": "Odd"}, [1.0, 1.0], 4),
        ("z", "none", None, [1.0, 1.0], 5),
        ("p", "", {"source": "Programming", "section": "P"}, None, 6),
    ]
    once, counters = st.import_records(empty(spark), records(spark, rows), "m", F.lit(T))
    assert counters.first().asDict() == {"read": 6, "imported": 4, "skipped": 2, "errors": 0, "removed": 0}
    docs = {(r.corpus_id, r.external_id): r for r in once.document.collect()}
    assert {k: r.title for k, r in docs.items()} == {("k0", "x"): "S", ("k1", "x"): "x", ("k2", "p"): "P"}
    assert sorted(r.content for r in once.chunk.collect()) == ["", "new", "other corpus"] and once.embedding.count() == 2
    twice, _ = st.import_records(once, records(spark, rows), "m", F.lit(LATER))
    assert {tuple(r) for r in twice.chunk.collect()} == {tuple(r) for r in once.chunk.collect()}
    again = {(r.corpus_id, r.external_id): r for r in twice.document.collect()}
    assert all(again[k].created_at == T and again[k].updated_at == LATER and again[k].document_id == docs[k].document_id for k in docs)
    assert all(r.n == 0 for r in st.violations(twice).collect())
    synced, _ = st.import_records(twice, records(spark, [("x", "newer", {"source": "CommandRef", "extra": True}, [0.5, 0.5], 1), ("p", "P", {"source": "Programming"}, None, 2)]), "m2", F.lit(LATER), delete_stale=True)
    left = {(r.corpus_id, r.external_id): r.meta for r in synced.document.collect()}
    assert set(left) == {("k0", "x"), ("k1", "x"), ("k2", "p")}  # the corpus without records in this import is not managed by it
    assert json.loads(left["k0", "x"]) == {"source": "CommandRef", "command_name": "", "section": "S", "n": 1, "extra": True}
    assert [(r.model, list(r.v)) for r in synced.embedding.where("model = 'm2'").collect()] == [("m2", [0.5, 0.5])]


def test_stale_documents_and_cascade(spark):
    rows = [(i, i, {"source": s}, [1.0], 1) for i, s in (("a", "CommandRef"), ("b", "CommandRef"), ("c", "FunctionRef"))]
    full, _ = st.import_records(empty(spark), records(spark, rows), "m", F.lit(T))
    managed = full.corpus.where("name <> 'a-functions'")
    expected = spark.createDataFrame([("k0", "a"), ("k0", "a")], "corpus_id string, external_id string")
    after = st.full_sync(full, expected, managed)
    assert sorted(r.external_id for r in after.document.collect()) == ["a", "c"] and after.chunk.count() == after.embedding.count() == 2
    assert st.full_sync(full, expected.limit(0), managed).document.count() == 3 and st.full_sync(full, expected, managed, delete=False) is full
    with pytest.raises(ValueError):
        st.known_sources(records(spark, rows), full.corpus.where("name <> 'a-commands'"), F.lit("CommandRef"))


def test_upsert_keeps_and_replaces(spark):
    there = spark.createDataFrame([("a", 1, '{"x": 1}', "t"), (None, 2, "{}", "t"), ("c", 3, "{}", "t")], "k string, v int, meta string, other string")
    new = spark.createDataFrame([("a", 9, '{"y": 2}', "clash"), (None, 8, '{"z": 1}', "n"), ("d", 7, "{}", "n")], "k string, v int, meta string, other string")
    got = {r.k: tuple(r)[1:] for r in st.upsert(there, new, ["k"], ["v"], ["meta"]).collect()}
    assert got == {"a": (9, '{"x":1,"y":2}', "t"), None: (8, '{"z":1}', "t"), "c": (3, "{}", "t"), "d": (7, "{}", "n")}
    assert st.upsert(there, new.limit(0), ["k"], ["v"]).count() == 3
    assert {r.k for r in st.insert_ignore(there, new, ["k"]).collect()} == {"a", None, "c", "d"}


def test_last_wins(spark):
    rows = [("a", 1, T, "x"), ("a", 2, LATER, "y"), ("a", 3, LATER, "z"), ("a", 3, LATER, "z"), ("b", 4, None, None), (None, 5, T, "n"), (None, 5, T, "n")]
    df = spark.createDataFrame(rows, "k string, v int, at timestamp, t string")
    assert sorted((r.k or "", r.v) for r in last_wins(df, ["k"], ["at"], ["t"]).collect()) == [("", 5), ("", 5), ("a", 3), ("b", 4)]
    assert last_wins(df.limit(0), ["k"], ["at"]).columns == df.columns


def test_embedding(spark):
    df = spark.createDataFrame([("a", "one two"), ("b", None), ("c", ""), ("d", "one two")], "id string, text string")
    got = {r.id: list(r.embedding) for r in embed(df, HashingEmbedder(16)).collect()}
    assert got["a"] == got["d"] and abs(sum(x * x for x in got["a"]) - 1) < 1e-6 and got["b"] == got["c"] == [0.0] * 16
    assert {r.id for r in embed_pending(df, df.where("id < 'c'"), HashingEmbedder(16)).collect()} == {"c", "d"}

    class Wrong(HashingEmbedder):
        def encode(self, texts):
            return super().encode(texts)[:, :3]

    with pytest.raises(Exception, match="16 elements expected"):
        embed(df, Wrong(16)).collect()


def test_files(spark, tmp_path):
    lines = ['{"id": "a", "text": "é", "metadata": {"source": "CommandRef", "n": 1}, "embedding": [1, 2.5]}', "", "  ", "not json", '{"text": "no id"}', '{"id": "b"}', '{"id": "a", "text": "later"}']
    (tmp_path / "r.jsonl").write_text("\n".join(lines), encoding="utf-8")
    ok, bad = files.read_records(spark, str(tmp_path / "r.jsonl"))
    rows = ok.orderBy("pos").collect()
    assert [(r.id, r.text) for r in rows] == [("a", "é"), ("b", None), ("a", "later")] and json.loads(rows[0].metadata) == {"source": "CommandRef", "n": 1} and list(rows[0].embedding) == [1.0, 2.5]
    assert [r.value for r in bad.orderBy("pos").collect()] == ["not json", '{"text": "no id"}']
    assert {r.id for r in files.done_ids(spark, str(tmp_path / "r.jsonl")).collect()} == {"a", "b"} and files.done_ids(spark, str(tmp_path / "none")).count() == 0
    assert files.line_count(spark, str(tmp_path / "r.jsonl")) == 5
    (tmp_path / "Man_x.md").write_text("# a\n\nb", encoding="utf-8")
    assert [tuple(r) for r in files.read_markdown(spark, str(tmp_path / "Man_x.md")).collect()] == [("Man_x", "# a\n\nb")]
    for n in (1, 2):
        (tmp_path / f"c{n}.json").write_text(json.dumps([{"id": f"i{n}", "text": "t", "metadata": {"n": n}}, {"id": "j"}]))
    assert files.read_chunks(spark, [str(tmp_path / f"c{n}.json") for n in (1, 2)]).count() == 4 and files.read_chunks(spark, []).count() == 0
    df = spark.createDataFrame([("x", "t")], "id string, text string")
    files.append_records(df, str(tmp_path / "out")), files.append_records(df, str(tmp_path / "out"))
    assert files.done_ids(spark, str(tmp_path / "out")).count() == 1 and files.line_count(spark, str(tmp_path / "out")) == 2
    files.append_records(df, str(tmp_path / "out"), force=True)
    assert files.line_count(spark, str(tmp_path / "out")) == 1
    files.write_chunks(df.limit(0), str(tmp_path / "empty"))
    (tmp_path / "env").write_text("# c\nA=1\nB='two words'\nC=\"x'\n\nbroken\nD = y=z\n")
    assert files.read_settings(str(tmp_path / "env"), {"A": "kept"}) == {"A": "kept", "B": "two words", "C": "\"x'", "D": "y=z"}
    assert [files.as_bool(x, True) for x in ("1", " Yes", "on", "TRUE", "0", "", None)] == [True] * 4 + [False, False, True]


def test_store_on_disk(spark, tmp_path):
    full, _ = st.import_records(empty(spark), records(spark, [("a", "t", {"source": "CommandRef"}, [1.0], 1)]), "m", F.lit(T))
    st.write_store(full, str(tmp_path / "new"))
    back = st.read_store(spark, str(tmp_path / "new"))
    assert {tuple(r) for r in back.chunk.collect()} == {tuple(r) for r in full.chunk.collect()} and back.embedding.count() == 1
    as_is = st.read_store(spark, str(tmp_path / "new"), repeated=False)
    assert {tuple(r) for r in as_is.chunk.collect()} == {tuple(r) for r in full.chunk.collect()} and as_is.embedding.count() == 1


def test_stream_embeds_each_id_once(spark, tmp_path):
    source, out, point = (str(tmp_path / x) for x in ("in", "out", "point"))
    files.append_records(spark.createDataFrame([("a", "x", "{}"), ("a", "x", "{}"), ("b", "y", "{}")], "id string, text string, metadata string"), source)
    embed_stream(spark, source, out, point, HashingEmbedder(4)).awaitTermination(60)
    files.append_records(spark.createDataFrame([("b", "y", "{}"), ("c", "z", "{}")], "id string, text string, metadata string"), source)
    embed_stream(spark, source, out, point, HashingEmbedder(4)).awaitTermination(60)
    ok, _ = files.read_records(spark, out)
    assert sorted(r.id for r in ok.collect()) == ["a", "b", "c"]


def test_insert_ignore_takes_the_first_of_new_rows(spark):
    there = spark.createDataFrame([("a", 1, "old")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 0, "x"), ("b", 2, "x"), ("b", 1, "z"), ("b", 1, "y"), ("c", None, "n"), ("c", 3, "m"), (None, 5, "p"), (None, 5, "p")], "k string, v int, w string").repartition(4)
    got = sorted(map(tuple, st.insert_ignore(there, new, ["k"]).collect()), key=str)
    assert got == sorted([("a", 1, "old"), ("b", 1, "y"), ("c", None, "n"), (None, 5, "p"), (None, 5, "p")], key=str)


def test_last_wins_is_the_same_in_any_order_and_reads_only_what_is_asked(spark, tmp_path):
    rows = [("a", 1, "x", "q"), ("a", 2, "y", None), ("a", 2, "x", "r"), ("b", None, "z", "s"), (None, 1, "u", "t"), (None, 1, "u", "t")]
    df = spark.createDataFrame(rows, "k string, t int, c string, d string")
    want = sorted([("a", 2, "y", "r"), ("b", None, "z", "s"), (None, 1, "u", "t"), (None, 1, "u", "t")], key=str)
    for parts in (1, 3, 6):
        assert sorted(map(tuple, last_wins(df.repartition(parts), ["k"], ["t"]).collect()), key=str) == want
    assert {tuple(r) for r in last_wins(df, ["k"], ["t"], ["c"]).where("k = 'a'").collect()} == {("a", 2, "y", None)}  # of the row of the greatest c
    df.write.parquet(str(tmp_path / "t"))
    plan = last_wins(spark.read.parquet(str(tmp_path / "t")), ["k"], ["t"]).select("k", "c")._jdf.queryExecution().executedPlan().toString()
    assert "d:string" not in plan and "c:string" in plan
    assert last_wins(df.limit(0), ["k"], ["t"]).count() == 0


def test_catalog_and_rates(spark, tmp_path):
    empty(spark).corpus.write.parquet(str(tmp_path / "rag_corpus.parquet"))
    assert [(r.table_name, r.column_name) for r in st.catalog(spark, str(tmp_path)).collect()] == [("rag_corpus", c) for c in ("corpus_id", "name", "description", "created_at")]
    assert st.has_table(spark, str(tmp_path), "corpus") and not st.has_table(spark, str(tmp_path), "chunk")
    assert st.rates(50, 200, 10.0) == {"rate": 5.0, "eta": 30.0} and st.rates(0, 9, 0.0) == {"rate": 0.0, "eta": None}


def test_import_counts_errors_and_removed(spark):
    rows = [("a", "t", {"source": "CommandRef"}, [0.123456789], 1), (None, "t", {"source": "CommandRef"}, None, 2), ("b", None, {"source": "CommandRef"}, None, 3), ("c", "t", {"source": "Odd"}, None, 4)]
    first, counters = st.import_records(empty(spark), records(spark, rows), "m", F.lit(T))
    assert counters.first().asDict() == {"read": 4, "imported": 1, "skipped": 1, "errors": 2, "removed": 0}
    assert abs(first.embedding.first()["v"][0] - 0.12345679) < 1e-8
    _, again = st.import_records(first, records(spark, [("z", "t", {"source": "CommandRef"}, None, 1)]), "m", F.lit(LATER), delete_stale=True)
    assert again.first()["removed"] == 1
