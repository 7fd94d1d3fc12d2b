"""The store of corpora, documents, chunks and embeddings: idempotent imports, and cleaning of what is no longer delivered.

Plain Parquet knows no MERGE; an upsert is one full join of what is there with what comes, and a rewrite (`write_store`)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.functions.metadata import merged, title
from lexharbor.functions.vectors import rounded
from lexharbor.operators.dedup import last_wins, newest, null_key
from lexharbor.session import bounded, spread

# Kind of corpus that each source of the manuals goes to.
SOURCES = {"CommandRef": "commands", "FunctionRef": "functions", "Programming": "programming"}


@dataclass(frozen=True)
class Store:
    """The four tables; columns as in `schema`. chunk and embedding have one row per chunk_id; stored, if given, are these two tables as they lie
    there, with repeated rows, for `chunks` and `vectors` to compute columns before anything is shuffled."""

    corpus: DataFrame
    document: DataFrame
    chunk: DataFrame
    embedding: DataFrame
    stored: tuple[DataFrame, DataFrame] | None = None

    def chunks(self, first: dict[str, Column] | None = None, **columns: Column) -> DataFrame:
        """chunk_id and the columns, computed from those of each chunk, and from those of `first`, which are computed once before them."""
        return _columns(self.chunk, self.stored and self.stored[0], first or {}, columns)

    def vectors(self, **columns: Column) -> DataFrame:
        """chunk_id and the columns, computed from those of each embedding."""
        return _columns(self.embedding, self.stored and self.stored[1], {}, columns)


def _columns(one: DataFrame, stored: DataFrame | None, first: dict[str, Column], columns: dict[str, Column]) -> DataFrame:
    rows = (one if stored is None else stored).withColumns(first)
    if stored is None:
        return rows.select("chunk_id", *[c.alias(n) for n, c in columns.items()])
    return newest(rows, ["chunk_id"], ["created_at"], **columns)


def read_store(spark: SparkSession, folder: str, prefix: str = "rag_", repeated: bool = True) -> Store:
    """The tables of a folder, one row per key: of repeated rows that of the last creation (see `last_wins`); embeddings without a vector count not.

    repeated=False reads tables without repeated rows, such as `write_store` leaves, as they are: nothing is shuffled."""
    t = lambda name: spark.read.parquet(f"{folder}/{prefix}{name}.parquet")
    chunk, embedding = spread(t("chunk")), spread(t("embedding")).where(F.size("v") > 0)
    if not repeated:
        return Store(t("corpus"), t("document"), chunk, embedding)
    return Store(t("corpus"), t("document"), last_wins(chunk, ["chunk_id"], ["created_at"]), last_wins(embedding, ["chunk_id"], ["created_at"]), (chunk, embedding))


def write_store(store: Store, folder: str, prefix: str = "rag_") -> None:
    """All tables written to a new folder; the caller swaps it for the old one, so that an import is seen whole or not at all."""
    for name in ("corpus", "document", "chunk", "embedding"):
        getattr(store, name).write.mode("error").parquet(f"{folder}/{prefix}{name}.parquet")


def stable_id(*parts: Column) -> Column:
    """An id that depends on the key alone."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def insert_ignore(there: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is there, and of the new rows those whose key is not; of new rows with one key the first in order of all columns, NULLs first.

    A new row with a NULL in its key is in no conflict with any other and comes in."""
    values = [c for c in there.columns if c not in keys]
    first = new.groupBy(*keys, null_key(keys).alias("_alone")).agg(F.min(F.struct(*values)).alias("_first")).select(*keys, "_first.*")
    fresh = first.join(there.select(*keys), list(keys), "left_anti")
    return there.unionByName(fresh.select(*there.columns))


def upsert(there: DataFrame, new: DataFrame, keys: Sequence[str], replaced: Sequence[str], merged_json: Sequence[str] = (), touched: str | None = None, now: Column | None = None) -> DataFrame:
    """`there` with the rows of `new`: rows whose key is there get the new `replaced` columns, `merged_json` as both objects (the new value
    holds), and `touched` set to now; all else stays. Rows with a new key come in as they are.

    Keys of `new` must be unique (see `last_wins`). One full join by the keys; NULLs in keys are equal to each other.
    """
    a = there.select(*[F.col(c).alias(f"_a_{c}") for c in there.columns], F.lit(True).alias("_a"))
    b = new.select(*[F.col(c).alias(f"_b_{c}") for c in new.columns], F.lit(True).alias("_b"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"_a_{k}").eqNullSafe(F.col(f"_b_{k}"))
    both = a.join(b, same, "full_outer")
    matched = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    out = []
    for c in there.columns:
        old = F.col(f"_a_{c}")
        if c not in new.columns:
            value = old
        elif c in merged_json:
            value = F.when(matched, merged(old, F.col(f"_b_{c}"))).when(F.col("_a").isNotNull(), old).otherwise(F.col(f"_b_{c}"))
        elif c in replaced:
            value = F.when(F.col("_b").isNotNull(), F.col(f"_b_{c}")).otherwise(old)
        else:
            value = F.when(F.col("_a").isNotNull(), old).otherwise(F.col(f"_b_{c}"))
        if c == touched:
            value = F.when(matched, F.current_timestamp() if now is None else now).otherwise(value)
        out.append(value.alias(c))
    return both.select(*out)


def upsert_documents(there: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """By (corpus_id, external_id): title replaced, meta merged, updated_at set; id and creation stay."""
    return upsert(there, new, ["corpus_id", "external_id"], ["title"], ["meta"], "updated_at", now)


def upsert_chunks(there: DataFrame, new: DataFrame) -> DataFrame:
    """By (document_id, chunk_index): content replaced, meta merged."""
    return upsert(there, new, ["document_id", "chunk_index"], ["content"], ["meta"])


def upsert_embeddings(there: DataFrame, new: DataFrame) -> DataFrame:
    """By chunk_id: vector, model and creation replaced, not the dimension."""
    return upsert(there, new, ["chunk_id"], ["v", "model", "created_at"])


def pending(chunks: DataFrame, done: DataFrame, id_: str = "id") -> DataFrame:
    """The chunks whose id is not among the done ones; a changed text under a known id is not pending."""
    return chunks.join(done.select(id_).distinct(), id_, "left_anti")


def known_sources(records: DataFrame, corpora: DataFrame, source: Column) -> tuple[DataFrame, DataFrame]:
    """(records with corpus_id, records of unknown sources). Raises ValueError if a corpus of a known source is missing."""
    kinds = corpora.select(F.regexp_extract(F.lower("name"), r"([^-]*)$", 1).alias("kind"), "corpus_id", "name")
    found = {r.kind for r in kinds.where(F.col("kind").isin(*SOURCES.values())).select("kind").distinct().collect()}
    if missing := set(SOURCES.values()) - found:
        raise ValueError(f"corpora missing: {sorted(missing)}")
    kind = F.coalesce(*[F.when(source == s, k) for s, k in SOURCES.items()])
    with_kind = records.withColumn("kind", kind)
    known = with_kind.where("kind IS NOT NULL").join(bounded(kinds.select("kind", "corpus_id")), "kind").drop("kind")
    return known, with_kind.where("kind IS NULL").drop("kind")


def stale(documents: DataFrame, expected: DataFrame, managed: DataFrame) -> DataFrame:
    """The documents of the managed corpora whose (corpus_id, external_id) is not expected. Nothing is stale if nothing is expected."""
    of = documents.join(managed.select("corpus_id").distinct(), "corpus_id", "left_semi")
    if not expected.limit(1).count():
        return of.limit(0)
    return of.join(expected.select("corpus_id", "external_id").distinct(), ["corpus_id", "external_id"], "left_anti")


def cascade(store: Store) -> Store:
    """The store without chunks of no document and embeddings of no chunk."""
    chunk = store.chunk.join(store.document.select("document_id"), "document_id", "left_semi")
    return replace(store, chunk=chunk, embedding=store.embedding.join(chunk.select("chunk_id"), "chunk_id", "left_semi"), stored=None)


def full_sync(store: Store, expected: DataFrame, managed: DataFrame, delete: bool = True) -> Store:
    """The store without stale documents and what belongs to them; as it is with `delete` off."""
    if not delete:
        return store
    gone = stale(store.document, expected, managed).select("document_id")
    return cascade(replace(store, document=store.document.join(gone, "document_id", "left_anti")))


def import_records(store: Store, records: DataFrame, model: str, now: Column | None = None, delete_stale: bool = False) -> tuple[Store, DataFrame]:
    """The store after an import, and its counters, one row: read, imported, skipped (of no known source), errors (no id or no text, left out),
    removed (stale documents). Vectors are kept to 8 decimals, as their text form has them.

    records: id, text, metadata (a JSON text with a source), embedding, pos. Of records with one id in a corpus the last by pos holds. Chunk
    index is 0, ids depend on the key alone, so that importing twice changes nothing but updated_at.
    """
    at = F.current_timestamp() if now is None else now
    source = F.get_json_object("metadata", "$.source")
    bad = F.col("id").isNull() | F.col("text").isNull()
    known, _ = known_sources(records.where(~bad), store.corpus, source)
    one = last_wins(known.select("corpus_id", "id", "text", merged(F.lit(None).cast("string"), F.col("metadata")).alias("metadata"), "embedding", "pos"), ["corpus_id", "id"], ["pos"], ["text"])
    doc_id = stable_id(F.col("corpus_id"), F.col("id"))
    docs = one.select(
        doc_id.alias("document_id"), "corpus_id", F.col("id").alias("external_id"), title(F.col("metadata"), F.col("id")).alias("title"), F.lit(None).cast("string").alias("uri"),
        F.sha2("text", 256).alias("hash_sha256"), F.col("metadata").alias("meta"), at.alias("created_at"), at.alias("updated_at"),
    )
    document = upsert_documents(store.document, docs, now)
    held = one.join(document.select("document_id", "corpus_id", F.col("external_id").alias("id")), ["corpus_id", "id"])
    chunks = held.select(
        stable_id(F.col("document_id"), F.lit(0)).alias("chunk_id"), "document_id", F.lit(0).alias("chunk_index"), F.col("text").alias("content"),
        F.lit(None).cast("int").alias("char_start"), F.lit(None).cast("int").alias("char_end"), F.col("metadata").alias("meta"), at.alias("created_at"),
    )
    chunk = upsert_chunks(store.chunk, chunks)
    vectors = held.join(chunk.where("chunk_index = 0").select("document_id", "chunk_id"), "document_id").where("embedding IS NOT NULL")
    vectors = vectors.select("chunk_id", F.lit(model).alias("model"), F.size("embedding").alias("embedding_dim"), rounded(F.col("embedding")).alias("v"), at.alias("created_at"))
    after = Store(store.corpus, document, chunk, upsert_embeddings(store.embedding, vectors))
    ours = F.coalesce(source, F.lit("")).isin(*SOURCES)
    counters = records.agg(F.count(F.lit(1)).alias("read"), F.count_if(ours & ~bad).alias("imported"), F.count_if(~ours & ~bad).alias("skipped"), F.count_if(bad).alias("errors"))
    removed = F.lit(0).cast("long")
    if delete_stale:
        expected, managed = one.select("corpus_id", F.col("id").alias("external_id")), one.select("corpus_id")
        gone = stale(document, expected, managed).agg(F.count(F.lit(1)).alias("removed"))
        after, counters, removed = full_sync(after, expected, managed), counters.join(F.broadcast(gone)), F.col("removed")  # one row each
    counters = counters.select("read", "imported", "skipped", "errors", removed.alias("removed"))
    return after, counters


def rates(done: int, of: int, seconds: float) -> dict[str, float | None]:
    """How far a run is: records a second, and the seconds the rest will take at that rate (None before the first)."""
    rate = done / seconds if seconds > 0 else 0.0
    return {"rate": rate, "eta": (of - done) / rate if rate else None}


def catalog(spark: SparkSession, folder: str, prefix: str = "rag_") -> DataFrame:
    """table_name, column_name, data_type of the store's tables that are in a folder; a table that is not there gives no rows. Reads footers only."""
    rows = []
    for name in ("corpus", "document", "chunk", "embedding"):
        try:
            fields = spark.read.parquet(f"{folder}/{prefix}{name}.parquet").schema
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        rows += [(f"{prefix}{name}", f.name, f.dataType.simpleString()) for f in fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def has_table(spark: SparkSession, folder: str, name: str, prefix: str = "rag_") -> bool:
    """Whether the folder holds a table of the store."""
    return catalog(spark, folder, prefix).where(F.col("table_name") == f"{prefix}{name}").limit(1).count() > 0


def violations(store: Store) -> DataFrame:
    """rule STRING, n BIGINT: how many keys or rows break each rule of the store; rules that hold have 0. Only keys are shuffled."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias("n")
    own = F.lit(1).alias("_own")
    chunk = store.chunks(document_id=F.col("document_id"), chunk_index=F.col("chunk_index"), missing=F.col("content").isNull())
    by_key = chunk.join(store.document.select("document_id", own), "document_id", "left").groupBy("document_id", "chunk_index")
    by_key = by_key.agg(F.count(F.lit(1)).alias("rows"), F.count_if("missing").alias("missing"), F.count_if(F.col("_own").isNull()).alias("lost"))
    odd = F.coalesce(F.size("v") != F.col("embedding_dim"), F.lit(True))
    vector = store.vectors(odd=odd).join(chunk.select("chunk_id", own), "chunk_id", "left")
    twice = lambda df, *keys: df.groupBy(*keys).count().select(n(F.col("count") > 1))
    rules = {
        "corpus name twice": twice(store.corpus, "name"), "document key twice": twice(store.document, "corpus_id", "external_id"),
        "embedding twice": twice(store.vectors(odd=odd), "chunk_id"),
        "document of no corpus": store.document.join(store.corpus.select("corpus_id"), "corpus_id", "left_anti").agg(F.count(F.lit(1)).alias("n")),
    }
    of_chunks = by_key.agg(n(F.col("rows") > 1).alias("chunk key twice"), n(F.col("missing")).alias("content missing"), n(F.col("lost")).alias("chunk of no document"))
    of_vectors = vector.agg(n(F.col("_own").isNull()).alias("embedding of no chunk"), n(F.col("odd")).alias("vector of another size"))
    out = None
    for one in [*[df.select(F.lit(name).alias("rule"), "n") for name, df in rules.items()], *[df.unpivot([], df.columns, "rule", "n") for df in (of_chunks, of_vectors)]]:
        out = one if out is None else out.unionByName(one)
    return out
