"""Views that several queries share, as plans and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.instants import instant_micros
from seqloom.operators.merge import upsert
from seqloom.operators.tasks import current_semantic_ids
from seqloom.session import table


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of every user and title, scraped_at as microseconds."""
    log = table(spark, sf_dir, "user_anime").where("user_id > 0 and anime_id > 0")
    rows = log.withColumn("scraped_at", instant_micros(F.col("scraped_at")))
    return upsert(None, rows, ["user_id", "anime_id"], [F.coalesce(c, F.lit(-1)) for c in ("scraped_at", "score", "watching_status", "watched_episodes")])


def semantic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current semantic id of every title."""
    return current_semantic_ids(table(spark, sf_dir, "anime_semantic_ids"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(anime_id, codes) of titles with all eight levels."""
    rows = semantic(spark, sf_dir).select("anime_id", F.from_json("codes_json", "array<int>").alias("codes"))
    return rows.where("size(codes) = 8")


def one_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue row per title: the latest prepared."""
    prep = table(spark, sf_dir, "anime_prep").where("anime_id is not null")
    version = [F.coalesce(instant_micros(F.col("prepared_at")), F.lit(-1).cast("long")), F.coalesce("anime_text", F.lit("")), F.coalesce("genres", F.lit("")), F.coalesce("studios", F.lit(""))]
    return upsert(None, prep, ["anime_id"], version)


_TS = "CAST(CASE WHEN {c} LIKE '%Z' OR substr({c}, -6, 1) IN ('+', '-') THEN {c} ELSE {c} || '+00:00' END AS TIMESTAMPTZ)"
UA = f"""ua AS (SELECT user_id, anime_id, score, watching_status, watched_episodes, scraped_at FROM (
  SELECT user_id, anime_id, score, watching_status, watched_episodes, epoch_us({_TS.format(c="scraped_at")}) AS scraped_at,
    row_number() OVER (PARTITION BY user_id, anime_id ORDER BY epoch_us({_TS.format(c="scraped_at")}) DESC, coalesce(score, -1) DESC, coalesce(watching_status, -1) DESC, coalesce(watched_episodes, -1) DESC) AS r
  FROM user_anime WHERE user_id > 0 AND anime_id > 0) WHERE r = 1)"""
SEM = f"""sem AS (SELECT anime_id, trim(semantic_id) AS semantic_id, level_tokens_json, codes_json FROM (
  SELECT *, row_number() OVER (PARTITION BY anime_id ORDER BY epoch_us({_TS.format(c="tokenized_at")}) DESC NULLS LAST, semantic_id DESC) AS r
  FROM anime_semantic_ids WHERE anime_id IS NOT NULL AND trim(semantic_id) <> '') WHERE r = 1)"""
CODES = SEM + """, codes AS (SELECT anime_id, codes FROM (SELECT anime_id, CAST(CAST(codes_json AS JSON) AS INTEGER[]) AS codes FROM sem) WHERE len(codes) = 8)"""
PREP = f"""prep AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY anime_id ORDER BY coalesce(epoch_us({_TS.format(c="prepared_at")}), -1) DESC,
  coalesce(anime_text, '') DESC, coalesce(genres, '') DESC, coalesce(studios, '') DESC) AS r FROM anime_prep WHERE anime_id IS NOT NULL) WHERE r = 1)"""

SPACE = r"[\t\n\v\f\r \x1c-\x1f\x{85}\p{Z}]"


def collapse(c: str) -> str:
    """SQL of collapsed white space."""
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'))"


def catalogue(c: str, unknown: bool = False) -> str:
    """SQL of catalogue text."""
    words = "('', 'nan', 'none', 'null'" + (", 'unknown', 'n/a'" if unknown else "") + ")"
    return f"CASE WHEN lower({collapse(c)}) NOT IN {words} THEN replace({collapse(c)}, ';', ',') END"


def whole(c: str) -> str:
    """SQL of a number that is cut to a whole one, null below zero."""
    text = f"trim(CAST({c} AS VARCHAR))"
    num = f"CASE WHEN regexp_full_match({text}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') THEN TRY_CAST({text} AS DOUBLE) END"
    return f"CASE WHEN {num} > -1 AND {num} < 9e18 THEN CAST(trunc({num}) AS BIGINT) END"


def names(c: str, lower: bool = False) -> str:
    """SQL of the names of a comma or semicolon list, each once in order."""
    item = f"lower(trim(x, ' '))" if lower else "trim(x, ' ')"
    source = f"coalesce({c}, '')" if lower else f"replace(coalesce({c}, ''), ';', ',')"
    every = f"list_filter(list_transform(string_split({source}, ','), lambda x: {item}), lambda x: x <> '')"
    return f"list_transform(list_filter({every}, lambda x, i: list_position({every}, x) = i), lambda x: x)"
