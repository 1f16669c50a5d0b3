"""Checks that stop a plan, and frames of what fails them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.vectors import has_non_finite


def invalid_vectors(df: DataFrame, key: str, vector: str, dim: str) -> DataFrame:
    """(key, reason) of vectors that are missing, of another length than stated, or not finite."""
    reason = (
        F.when(F.col(vector).isNull(), "missing")
        .when(F.size(vector) != F.col(dim), "length")
        .when(has_non_finite(F.col(vector)), "not finite")
    )
    return df.select(key, reason.alias("reason")).where("reason is not null")


def dimension_range(df: DataFrame, vector: str) -> DataFrame:
    """(least, most) length of the vectors."""
    return df.agg(F.min(F.size(vector)).alias("least"), F.max(F.size(vector)).alias("most"))


def checked_vectors(df: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """The same rows; the first faulty vector met ends the query with an error that names it."""
    fault = F.col(vector).isNull() | (F.size(vector) != dim) | has_non_finite(F.col(vector))
    message = F.concat(F.lit("faulty vector of "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return df.withColumn(vector, F.when(fault, F.raise_error(message).cast(df.schema[vector].dataType)).otherwise(F.col(vector)))


def require_vectors(df: DataFrame, key: str, vector: str, most: int = 20) -> DataFrame:
    """The frame, after a look at all rows: finite vectors of one length, and at least one row.

    The error names up to ``most`` faulty ids in order.
    """
    length = dimension_range(df.where(F.col(vector).isNotNull()), vector).first()["most"]
    if length is None:
        raise ValueError("no vectors")
    fault = F.col(vector).isNull() | (F.size(vector) != length) | has_non_finite(F.col(vector))
    bad = [str(r[0]) for r in df.where(fault).select(key).orderBy(key).limit(most).collect()]
    if bad:
        raise ValueError(f"faulty vectors, the first of: {', '.join(bad)}")
    return df


def require_rows(df: DataFrame, rows: int) -> DataFrame:
    """The frame, after a count that must match."""
    found = df.count()
    if found != rows:
        raise ValueError(f"{found} rows instead of {rows}")
    return df


def require_files(folder: str | Path, names: list[str]) -> None:
    """All named artefacts must exist."""
    missing = [n for n in names if not (Path(folder) / n).exists()]
    if missing:
        raise FileNotFoundError(f"missing artefacts in {folder}: {', '.join(missing)}")
