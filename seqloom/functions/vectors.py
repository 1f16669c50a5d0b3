"""Vectors, codes and semantic tokens."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.ArrayType(T.FloatType()))
def vector_from_bytes(blob: pd.Series) -> pd.Series:
    """Little-endian 32-bit floats; null for null and for a length that is no multiple of four."""
    return blob.map(lambda b: np.frombuffer(b, "<f4") if b is not None and len(b) % 4 == 0 else None)


@F.pandas_udf(T.BinaryType())
def vector_to_bytes(vector: pd.Series) -> pd.Series:
    """The inverse of :func:`vector_from_bytes`."""
    return vector.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())


def has_non_finite(vector: Column) -> Column:
    """Whether any entry is null, NaN or infinite; a null vector has one."""
    return F.coalesce(F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))


def norm(vector: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(vector: Column) -> Column:
    """Vector of length 1; a zero vector stays as it is."""
    # the outer lambda binds the length, which is else worked out for every entry
    return F.element_at(F.transform(F.array(norm(vector)), lambda n: F.transform(vector, lambda x: x / F.greatest(n, F.lit(1e-12)))), 1)


def level_tokens(codes: Column) -> Column:
    """One token per level: <L1_c>, <L2_c>, ..."""
    return F.transform(codes, lambda c, i: F.concat(F.lit("<L"), (i + 1).cast("string"), F.lit("_"), c.cast("string"), F.lit(">")))


def semantic_id(tokens: Column, concat: bool = True, separator: str = "") -> Column:
    """Tokens as one id; ``concat`` leaves the separator out."""
    return F.array_join(tokens, "" if concat else separator)


def parse_level_token(token: Column) -> Column:
    """(level, code) of a token, null if it is none."""
    pattern = r"^<L(\d+)_(\d+)>$"
    return F.when(token.rlike(pattern), F.struct(F.regexp_extract(token, pattern, 1).cast("int").alias("level"), F.regexp_extract(token, pattern, 2).cast("int").alias("code")))


def hamming_ratio(a: Column, b: Column) -> Column:
    """Share of levels in which two code arrays differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 0).otherwise(1)), F.lit(0), lambda s, x: s + x) / F.greatest(F.size(a), F.lit(1)).cast("double")


def prefix_depth(a: Column, b: Column) -> Column:
    """How many leading levels two code arrays share."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first_other = F.array_position(same, False)
    return F.when(first_other == 0, F.size(same)).otherwise(first_other - 1).cast("int")


def nearest_codes(rows: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """Index of the nearest code of each row by squared distance; the first of equal ones."""
    square = (codebook * codebook).sum(1)
    out = np.empty(len(rows), np.int64)
    for s in range(0, len(rows), 4096):
        part = rows[s : s + 4096]
        out[s : s + 4096] = np.argmin((part * part).sum(1)[:, None] - 2 * part @ codebook.T + square, axis=1)
    return out


def residual_codes(rows: np.ndarray, codebooks: list[np.ndarray]) -> np.ndarray:
    """Codes of each level, each level on what the earlier ones left."""
    left, codes = rows.astype(np.float64).copy(), np.empty((len(rows), len(codebooks)), np.int32)
    for level, book in enumerate(codebooks):
        codes[:, level] = nearest_codes(left, book)
        left -= book[codes[:, level]]
    return codes


def quantise(vector: Column, codebooks: list[np.ndarray]) -> Column:
    """Residual codes of a vector column (array<int>); null vectors stay null."""

    @F.pandas_udf("array<int>")
    def run(batch: pd.Series) -> pd.Series:
        out = np.full(len(batch), None, object)
        there = np.flatnonzero(batch.notna())
        if len(there):
            for i, code in zip(there, residual_codes(np.stack(batch.iloc[there].to_list()), codebooks), strict=True):
                out[i] = code
        return pd.Series(out)

    return run(vector)


def reconstruct(codes: Column, codebooks: list[np.ndarray]) -> Column:
    """Sum of the code vectors of every level (array<double>)."""

    @F.pandas_udf("array<double>")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda c: None if c is None else sum(book[i] for book, i in zip(codebooks, c, strict=False)))

    return run(codes)


def gelu_mlp(rows: np.ndarray, layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Linear, GELU, Linear with given weights, for encoders and decoders trained elsewhere."""
    w1, b1, w2, b2 = layers
    hidden = rows @ w1.T + b1
    hidden = 0.5 * hidden * (1 + np.vectorize(math.erf, otypes=[float])(hidden / math.sqrt(2)))
    return hidden @ w2.T + b2
