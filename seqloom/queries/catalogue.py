"""Queries on catalogue text and numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import catalogue_text, genre_set, imported_text, leading_themes, nonnegative_int, preferred_title, score, split_list, strict_nonnegative_int, year_text
from seqloom.operators.instructions import evaluation_texts
from seqloom.plans.catalogue import CORE, LABELS, UNKNOWN_IS_NULL, prepare_catalogue
from seqloom.queries.common import PREP, catalogue, names, one_prep, whole
from seqloom.session import table

AT = "2024-01-01T00:00:00+00:00"


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    rows = one_prep(spark, d)
    return prepare_catalogue(rows.withColumn("imported_at", F.col("source_imported_at")), AT)


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    cols = ("name", "english_name", "synopsis", "genres", "studios")
    return one_prep(spark, d).select("anime_id", *[catalogue_text(F.col(c)).alias(c) for c in cols], catalogue_text(F.col("rating"), True).alias("rating"))


def missing_flags(spark: SparkSession, d: str) -> DataFrame:
    return _prepared(spark, d).select("anime_id", "flag_missing_core", "flag_missing_synopsis")


def anime_text(spark: SparkSession, d: str) -> DataFrame:
    return _prepared(spark, d).select("anime_id", "anime_text")


def prepared_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return _prepared(spark, d).select("anime_id", "name", "type", "episodes", "score", "year", "members", "rating", "source_imported_at")


def number_cleaning(spark: SparkSession, d: str) -> DataFrame:
    """Texts that are numbers, nearly numbers, or none."""
    texts = F.array(F.concat(F.col("value").cast("decimal(18,2)").cast("string")), F.concat(F.lit("-"), F.col("event_id")), F.concat(F.lit(" "), F.col("event_id"), F.lit(" ")), F.lit("12abc"), F.lit("1d"), F.lit(""), F.lit("7."))
    t = F.element_at(texts, (F.pmod("event_id", F.lit(7)) + 1).cast("int"))
    return table(spark, d, "events").select("event_id", nonnegative_int(t).alias("whole"), strict_nonnegative_int(t).alias("strict"), score(t).alias("score"))


def split_names(spark: SparkSession, d: str) -> DataFrame:
    p = one_prep(spark, d)
    return p.select("anime_id", F.array_join(split_list(F.col("genres")), "|").alias("names"), F.array_join(F.array_sort(genre_set(F.col("genres"))), "|").alias("genre_set"), leading_themes(F.col("genres")).alias("themes"))


def titles(spark: SparkSession, d: str) -> DataFrame:
    p = one_prep(spark, d)
    return p.select("anime_id", preferred_title(F.trim("english_name"), F.trim("name")).alias("title"), year_text(F.col("year"), F.col("premiered")).alias("year_text"))


def imported_names(spark: SparkSession, d: str) -> DataFrame:
    return one_prep(spark, d).select("anime_id", imported_text(F.col("studios")).alias("studios"))


def evaluation_lengths(spark: SparkSession, d: str) -> DataFrame:
    texts = evaluation_texts(table(spark, d, "orders").select(F.concat_ws(" ", F.lit(" "), F.col("o_orderpriority"), F.col("o_orderstatus")).alias("text")), 10**9)
    return texts.groupBy("text").agg(F.count("*").alias("n"))


def _value(c: str, kind: str) -> str:
    if kind == "double":
        fixed = f"regexp_replace(regexp_replace(printf('%.6f', {c}), '0+$', ''), '\\.$', '')"
        return f"CASE WHEN {c} IS NULL THEN 'Unknown' ELSE {fixed} END"
    return f"coalesce(CAST({c} AS VARCHAR), 'Unknown')"


def _clean(c: str, kind: str) -> str:
    if kind == "bigint":
        return whole(c)
    return f"CASE WHEN {c} BETWEEN 0 AND 10 THEN {c} END" if kind == "double" else catalogue(c, c in UNKNOWN_IS_NULL)


_CLEAN = PREP + ", c AS (SELECT " + ", ".join(f"{_clean(c, k)} AS {c}" for _, c, k in LABELS) + f", {catalogue('source_imported_at')} AS source_imported_at FROM prep)"
_TEXT = " || '; ' || ".join(f"'{label}: ' || " + (_value(c, k) if c != "name" else "coalesce(name, 'Unknown')") for label, c, k in LABELS) + " || '.'"
_T = "[CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '-' || event_id, ' ' || event_id || ' ', '12abc', '1d', '', '7.'][event_id % 7 + 1]"
_NUM = f"CASE WHEN regexp_full_match(trim({_T}), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST(trim({_T}) AS DOUBLE) END"
_UNIQUE = "list_filter({x}, lambda x, i: list_position({x}, x) = i)"

QUERIES = {
    "clean_text": clean_text, "missing_core_flags": missing_flags, "anime_text": anime_text, "prepared_catalogue": prepared_catalogue, "number_cleaning": number_cleaning,
    "split_names": split_names, "preferred_title": titles, "imported_names": imported_names, "evaluation_texts": evaluation_lengths,
}
ORACLES = {
    "clean_text": f"WITH {PREP} SELECT anime_id, " + ", ".join(f"{catalogue(c)} AS {c}" for c in ("name", "english_name", "synopsis", "genres", "studios")) + f", {catalogue('rating', True)} AS rating FROM prep",
    "missing_core_flags": f"WITH {_CLEAN} SELECT anime_id, CAST(" + " OR ".join(f"{c} IS NULL" for c in CORE) + " AS INTEGER) AS flag_missing_core, CAST(synopsis IS NULL AS INTEGER) AS flag_missing_synopsis FROM c",
    "anime_text": f"WITH {_CLEAN} SELECT anime_id, {_TEXT} AS anime_text FROM c",
    "prepared_catalogue": f"WITH {_CLEAN} SELECT anime_id, coalesce(name, 'Unknown') AS name, type, episodes, score, year, members, rating, source_imported_at FROM c",
    "number_cleaning": f"""SELECT event_id, CASE WHEN {_NUM} > -1 THEN CAST(trunc({_NUM}) AS BIGINT) END AS whole,
      CASE WHEN regexp_full_match(trim({_T}), '[+-]?\\d+') AND CAST(trim({_T}) AS BIGINT) >= 0 THEN CAST(trim({_T}) AS BIGINT) END AS strict, CASE WHEN {_NUM} BETWEEN 0 AND 10 THEN {_NUM} END AS score FROM events""",
    "split_names": f"""WITH {PREP} SELECT anime_id, array_to_string({names('genres')}, '|') AS names,
      array_to_string(list_sort({_UNIQUE.format(x="list_filter(list_transform(string_split(coalesce(genres, ''), ','), lambda x: lower(trim(x))), lambda x: x <> '')")}), '|') AS genre_set,
      array_to_string(({names('genres')})[1:3], ', ') AS themes FROM prep""",
    "preferred_title": f"WITH {PREP} SELECT anime_id, coalesce(nullif(trim(english_name), ''), nullif(trim(name), ''), 'Unknown') AS title, coalesce(CAST(year AS VARCHAR), premiered, '') AS year_text FROM prep",
    "imported_names": f"WITH {PREP} SELECT anime_id, CASE WHEN lower(trim(studios)) NOT IN ('', 'nan') THEN trim(studios) END AS studios FROM prep",
    "evaluation_texts": "SELECT text, CAST(count(*) AS BIGINT) AS n FROM (SELECT trim(concat_ws(' ', ' ', o_orderpriority, o_orderstatus)) AS text FROM orders) WHERE length(text) >= 8 GROUP BY 1",
}
