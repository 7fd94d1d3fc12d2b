"""The types of the store's tables, of hits, and of imported records: `schema.CHUNK` and so on are StructTypes, read from these texts when they are
asked for, as that takes a session."""

from pyspark.sql.types import StructType

DDL = {
    "CORPUS": "corpus_id STRING NOT NULL, name STRING NOT NULL, description STRING, created_at TIMESTAMP_NTZ NOT NULL",
    "DOCUMENT": "document_id STRING NOT NULL, corpus_id STRING NOT NULL, external_id STRING NOT NULL, title STRING, uri STRING, hash_sha256 STRING, meta STRING NOT NULL, "
    "created_at TIMESTAMP_NTZ NOT NULL, updated_at TIMESTAMP_NTZ NOT NULL",
    "CHUNK": "chunk_id STRING NOT NULL, document_id STRING NOT NULL, chunk_index INT NOT NULL, content STRING NOT NULL, char_start INT, char_end INT, meta STRING NOT NULL, "
    "created_at TIMESTAMP_NTZ NOT NULL",
    "EMBEDDING": "chunk_id STRING NOT NULL, model STRING NOT NULL, embedding_dim INT NOT NULL, v ARRAY<FLOAT> NOT NULL, created_at TIMESTAMP_NTZ NOT NULL",
    "HIT": "chunk_id STRING, corpus_name STRING, title STRING, content STRING, rrf_score DOUBLE, dense_rank INT, fts_rank INT, meta STRING",
    "RECORD": "id STRING, text STRING, metadata STRING, embedding ARRAY<FLOAT>",
    "WORD": "page INT, text STRING, x0 DOUBLE, top DOUBLE, fontname STRING",
    "PAGE": "page INT, md STRING",
}


def __getattr__(name: str) -> StructType:
    if name not in DDL:
        raise AttributeError(name)
    return StructType.fromDDL(DDL[name])
