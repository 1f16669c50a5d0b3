"""Embedding of texts by an exchangeable backend."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class EmbeddingBackend(Protocol):
    """Anything that turns texts into vectors of one length."""

    def embed_texts(self, texts: list[str]) -> list[list[float]]: ...


class HashingBackend:
    """Deterministic vectors from hashed words, of length 1; for runs without a model."""

    def __init__(self, dim: int = 128) -> None:
        self.dim = dim

    def embed_texts(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts, strict=True):
            for word in (text or "").lower().split():
                h = xxhash.xxh64_intdigest(word)
                row[h % self.dim] += 1.0 if h >> 63 else -1.0
            row /= max(1e-12, float(np.linalg.norm(row)))
        return out.tolist()


def embed_texts(df: DataFrame, key: str, text: str, backend: EmbeddingBackend, model_name: str, embedded_at: str, batch: int = 256) -> DataFrame:
    """Rows of the embeddings table. A wrong number of vectors, vectors of several
    lengths and entries that are not finite are errors that name the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = None
        for whole in batches:
            for part in (whole.slice(i, batch) for i in range(0, whole.num_rows, batch)):
                ids, texts = part["k"].to_pylist(), [t or "" for t in part["t"].to_pylist()]
                vectors = backend.embed_texts(texts)
                if len(vectors) != len(ids):
                    raise ValueError(f"{len(vectors)} vectors for {len(ids)} texts")
                bad = [i for i, v in zip(ids, vectors, strict=True) if not np.isfinite(v).all()]
                if bad:
                    raise ValueError(f"vectors that are not finite: {bad[:20]}")
                dim = dim or len(vectors[0])
                if any(len(v) != dim for v in vectors):
                    raise ValueError("vectors of several lengths")
                yield pa.RecordBatch.from_arrays([part["k"], pa.array(vectors, pa.list_(pa.float32())), pa.array([dim] * len(ids), pa.int32()), part["p"]], names=["anime_id", "embedding", "embedding_dim", "source_prepared_at"])

    prepared = F.col("prepared_at") if "prepared_at" in df.columns else F.lit(None)
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), prepared.cast("string").alias("p"))
    made = rows.mapInArrow(run, "anime_id long, embedding array<float>, embedding_dim int, source_prepared_at string")
    return made.select("anime_id", "embedding", "embedding_dim", F.lit(model_name).alias("model_name"), F.lit(embedded_at).alias("embedded_at"), "source_prepared_at")
