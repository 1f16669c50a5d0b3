"""Sinks: parquet, JSON lines, lookups, and one-row documents."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tables of an export.
EXPORTED = ("clubs", "users", "user_anime", "anime", "club_member_progress", "user_animelist_progress", "anime_catalog_progress", "state")


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Every exported table as <folder>/<name>.parquet, replacing what is there."""
    for name in EXPORTED:
        if name in tables:
            tables[name].write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object per line; null fields are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def write_document(row: DataFrame | Mapping, path: str) -> None:
    """A one-row frame, or a mapping, as one readable JSON document."""
    body = dict(row) if isinstance(row, Mapping) else row.limit(1).collect()[0].asDict(recursive=True)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(body, indent=2, ensure_ascii=False, default=str) + "\n", encoding="utf-8")


def write_lookup(rows: DataFrame, path: str) -> None:
    """Tab-separated items with their tokens and codes as JSON."""
    rows.select("anime_id", "name", "english_name", "semantic_id", F.to_json("tokens").alias("tokens"), F.to_json("codes").alias("codes")).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def inverse_lookup(rows: DataFrame) -> DataFrame:
    """(semantic_id, anime_id): items of an id, all of them if several share it."""
    return rows.select("semantic_id", "anime_id")


def append_usage(df: DataFrame, path: str) -> None:
    """Numbers with six decimals, added to a CSV log."""
    fixed = [F.format_string("%.6f", F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    df.select(*fixed).coalesce(1).write.mode("append").option("header", True).csv(path)


def write_codebooks(spark, books: list, path: str) -> None:
    """Codebooks as rows (level, code, vector)."""
    rows = [(level, code, [float(x) for x in vector]) for level, book in enumerate(books) for code, vector in enumerate(book)]
    spark.createDataFrame(rows, "level int, code int, vector array<double>").write.mode("overwrite").parquet(path)


def read_codebooks(spark, path: str) -> list:
    """The inverse of :func:`write_codebooks`; an empty or ragged file is an error."""
    import numpy as np

    rows = spark.read.parquet(path).orderBy("level", "code").collect()
    if not rows or len({len(r["vector"]) for r in rows}) != 1:
        raise ValueError("no usable codebook")
    return [np.array([r["vector"] for r in rows if r["level"] == level]) for level in range(rows[-1]["level"] + 1)]
