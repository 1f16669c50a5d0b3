"""Schemas of the tables, and fitting of frames to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SIMPLE = {"bigint": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "float": T.FloatType, "string": T.StringType, "boolean": T.BooleanType}


def split_fields(text: str) -> list[str]:
    """Top-level fields of a schema text."""
    out, deep, start = [], 0, 0
    for i, c in enumerate(text):
        deep += (c == "<") - (c == ">")
        if c == "," and not deep:
            out.append(text[start:i].strip())
            start = i + 1
    return [*out, text[start:].strip()]


def _type(text: str) -> T.DataType:
    if text.startswith("array<"):
        return T.ArrayType(_type(text[6:-1]))
    return _schema(text[7:-1]) if text.startswith("struct<") else _SIMPLE[text]()


def _schema(text: str) -> T.StructType:
    """A schema from text, without a session."""
    pairs = (f.replace(": ", " ", 1).split(" ", 1) for f in split_fields(text))
    return T.StructType([T.StructField(name, _type(kind.strip())) for name, kind in pairs])


CATALOGUE_COLUMNS = (
    "anime_id", "name", "english_name", "japanese_name", "title_synonyms", "score", "genres", "synopsis", "type", "episodes", "premiered", "season", "year",
    "studios", "producers", "licensors", "source", "anime_status", "rating", "duration", "aired_from", "aired_to", "members", "favorites", "scored_by", "rank", "popularity",
)
_WHOLE = {"anime_id", "episodes", "year", "members", "favorites", "scored_by", "rank", "popularity"}
_CATALOGUE = ", ".join(f"{c} {'bigint' if c in _WHOLE else 'double' if c == 'score' else 'string'}" for c in CATALOGUE_COLUMNS)

TABLES = {
    "clubs": _schema("club_id bigint, members bigint, discovered_at string"),
    "club_scan_progress": _schema("club_id bigint, scanned_at string"),
    "club_member_progress": _schema("club_id bigint, last_page int, completed int, updated_at string"),
    "users": _schema("user_id bigint, username string, source_club_id bigint, discovered_at string"),
    "user_animelist_progress": _schema("user_id bigint, last_page int, completed int, updated_at string"),
    "user_anime": _schema("user_id bigint, anime_id bigint, score int, watching_status int, watched_episodes int, scraped_at string"),
    "anime": _schema(
        "anime_id bigint, name string, english_name string, score double, genres string, synopsis string, type string, episodes bigint, premiered string, "
        "studios string, source string, rating string, members bigint, favorites bigint, scored_by bigint, imported_at string"
    ),
    "anime_full": _schema(_CATALOGUE + ", imported_at string"),
    "anime_catalog_progress": _schema("anime_id bigint, last_status int, completed int, updated_at string"),
    "state": _schema("key string, value string"),
    "anime_prep": _schema(_CATALOGUE + ", flag_missing_core int, flag_missing_synopsis int, anime_text string, prepared_at string, source_imported_at string"),
    "anime_embeddings": _schema("anime_id bigint, embedding array<float>, embedding_dim int, model_name string, embedded_at string, source_prepared_at string"),
    "anime_semantic_ids": _schema("anime_id bigint, semantic_id string, level_tokens_json string, codes_json string, source_checkpoint string, tokenized_at string, name string, english_name string"),
    "semantic_vocab": _schema("token_id bigint, token string"),
}
SEMANTIC_JSON = _schema("anime_id bigint, name string, english_name string, genres string, semantic_id string, tokens array<string>, codes array<int>")
EXAMPLE = _schema(
    "example_id string, task string, input string, output string, anime_ids array<bigint>, user_id bigint, "
    "meta struct<template_id: string, mask_mode: string, mask_index: int, history_len: int, kind: string>"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order: missing ones null, others cast where they can be."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
