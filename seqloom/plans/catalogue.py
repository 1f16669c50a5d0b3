"""Catalogue preparation: one projection over the scan, all of it in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.text import any_null, collapse, format_value, keep_score, keep_text, keep_whole, labelled_text, number
from seqloom.schemas import TABLES, conform
from seqloom.sources.readers import catalogue_rows

# Labels of the text, in order, with the column and its kind.
LABELS = (
    ("Anime ID", "anime_id", "bigint"), ("Name", "name", "string"), ("English Name", "english_name", "string"), ("Japanese Name", "japanese_name", "string"),
    ("Title Synonyms", "title_synonyms", "string"), ("Score", "score", "double"), ("Genres", "genres", "string"), ("Synopsis", "synopsis", "string"),
    ("Type", "type", "string"), ("Episodes", "episodes", "bigint"), ("Premiered", "premiered", "string"), ("Season", "season", "string"), ("Year", "year", "bigint"),
    ("Studios", "studios", "string"), ("Producers", "producers", "string"), ("Licensors", "licensors", "string"), ("Source", "source", "string"),
    ("Status", "anime_status", "string"), ("Rating", "rating", "string"), ("Duration", "duration", "string"), ("Aired From", "aired_from", "string"),
    ("Aired To", "aired_to", "string"), ("Members", "members", "bigint"), ("Favorites", "favorites", "bigint"), ("Scored By", "scored_by", "bigint"),
    ("Rank", "rank", "bigint"), ("Popularity", "popularity", "bigint"),
)
UNKNOWN_IS_NULL = {"type", "anime_status", "rating"}
CORE = ("name", "type", "episodes", "rating", "members")


def _parse(name: str, kind: str) -> Column:
    return collapse(F.col(name)) if kind == "string" else number(F.col(name))


def _keep(name: str, kind: str) -> Column:
    if kind == "bigint":
        return keep_whole(F.col(name))
    return keep_score(F.col(name)) if kind == "double" else keep_text(F.col(name), name in UNKNOWN_IS_NULL)


def prepare_catalogue(catalogue: DataFrame, prepared_at: str, limit: int = 0) -> DataFrame:
    """The 32 prepared columns: cleaned values, flags of missing ones, and the text.

    A row without a usable id is an error. Missing columns count as null.
    """
    rows = catalogue_rows(catalogue, limit)
    # two steps, so that each pattern is applied once and the generated code stays small
    parsed = rows.select(*[_parse(c, kind).alias(c) for _, c, kind in LABELS], collapse(F.col("imported_at")).alias("imported_at"))
    clean = parsed.select(*[_keep(c, kind).alias(c) for _, c, kind in LABELS], keep_text(F.col("imported_at")).alias("source_imported_at"))
    clean = clean.withColumn("anime_id", F.coalesce("anime_id", F.raise_error(F.lit("a catalogue row has no valid id")).cast("bigint")))
    flagged = clean.withColumns({
        "flag_missing_core": any_null([F.col(c) for c in CORE]), "flag_missing_synopsis": F.col("synopsis").isNull().cast("int"), "prepared_at": F.lit(prepared_at),
    })
    named = flagged.withColumn("name", F.coalesce("name", F.lit("Unknown")))
    return conform(named.withColumn("anime_text", labelled_text((label, format_value(F.col(c), kind)) for label, c, kind in LABELS)), TABLES["anime_prep"])
