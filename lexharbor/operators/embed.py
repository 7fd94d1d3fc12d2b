"""Vectors of texts by an exchangeable model, in batches on the executors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from lexharbor.functions.vectors import checked
from lexharbor.operators.store import pending


class Embedder(Protocol):
    """A model: pickled to the executors, loaded once per task by `load`, then called with batches."""

    name: str
    dim: int

    def load(self) -> None: ...

    def encode(self, texts: Sequence[str]) -> np.ndarray: ...


class HashingEmbedder:
    """A stand-in without a model: signed hashes of the words, at length 1. The same text has the same vector everywhere."""

    name = "hashing"

    def __init__(self, dim: int = 64):
        self.dim = dim

    def load(self) -> None:
        pass

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float64)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                out[i, h % self.dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def embed(df: DataFrame, embedder: Embedder, text: str = "text", vector: str = "embedding", batch: int = 64) -> DataFrame:
    """`df` with the vector ARRAY<FLOAT> of `text`; NULL has that of an empty text. A model that gives vectors of another size is an error."""

    @F.pandas_udf(ArrayType(FloatType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embedder.load()
        for part in parts:
            texts = part.fillna("").tolist()
            rows: list[np.ndarray] = []
            for lo in range(0, len(texts), batch):
                rows += list(embedder.encode(texts[lo : lo + batch]))
            yield pd.Series(rows, dtype=object)

    return df.withColumn(vector, run(F.col(text))).withColumn(vector, checked(F.col(vector), embedder.dim))


def embed_pending(chunks: DataFrame, done: DataFrame | None, embedder: Embedder, id_: str = "id") -> DataFrame:
    """The records of the chunks that have none yet; of all with `done` None (force). To be appended to the done ones."""
    return embed(chunks if done is None else pending(chunks, done, id_), embedder)
