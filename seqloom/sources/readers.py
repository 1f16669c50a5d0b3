"""Sources: table files, imported CSV folders, JSON lines and page files."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.functions.text import imported_text, int_or, join_names, number, status_code, strip
from seqloom.schemas import CATALOGUE_COLUMNS, SEMANTIC_JSON, TABLES, conform, split_fields

# Accepted column names of imported files, in order of preference.
CATALOGUE_ALIASES = {"anime_id": ("anime_id", "mal_id"), "name": ("name", "title"), "english_name": ("english_name", "title_english")}
LIST_ALIASES = {
    "user_id": ("user_id", "userid"), "anime_id": ("anime_id", "mal_id", "animeid"), "score": ("rating", "score"),
    "watching_status": ("watching_status", "status"), "watched_episodes": ("watched_episodes", "episodes_watched"),
}
# Files of an import folder in the order in which they win, with the state of their rows.
CATALOGUE_FILES = ("anime_with_synopsis.csv", "anime.csv")
LIST_FILES = (("animelist.csv", 2), ("rating_complete.csv", 2), ("rating.csv", 2))


def catalogue_rows(df: DataFrame, limit: int = 0) -> DataFrame:
    """The 27 catalogue columns and imported_at as text, absent ones null, by id."""
    columns = [*CATALOGUE_COLUMNS, "imported_at"]
    rows = df.select(*[(F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns])
    return rows.orderBy(F.col("anime_id").try_cast("bigint")).limit(limit) if limit > 0 else rows


def metadata_rows(catalogue: DataFrame, ids: DataFrame) -> DataFrame:
    """Ten catalogue columns of the items that are wanted."""
    columns = ["anime_id", "name", "english_name", "genres", "synopsis", "studios", "year", "premiered", "type", "source"]
    return catalogue.select(*columns).join(ids.select("anime_id").distinct(), "anime_id", "left_semi")


def embeddings_with_names(embeddings: DataFrame, prep: DataFrame) -> DataFrame:
    """Embeddings joined to the names and genres of their items, nulls as empty texts."""
    names = prep.select("anime_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "english_name", "genres")])
    return embeddings.join(names, "anime_id")


def find_file(root: str | Path, name: str) -> str | None:
    """First file of that name in any letter case below a folder."""
    for folder, folders, files in os.walk(root):
        folders.sort()
        for file in sorted(files):
            if file.lower() == name.lower():
                return os.path.join(folder, file)
    return None


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with header; every column is text and cast later."""
    return spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def normal_columns(columns: Sequence[str]) -> dict[str, str]:
    """Column by its trimmed lower-case name with _ for blanks; the last of equal ones."""
    return {c.strip().lower().replace(" ", "_"): c for c in columns}


def aliased(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> dict[str, Column | None]:
    """Column of each field by the first alias that the frame has."""
    known = normal_columns(df.columns)
    return {field: next((F.col(f"`{known[a]}`") for a in names if a in known), None) for field, names in aliases.items()}


def imported_catalogue(df: DataFrame, imported_at: str) -> DataFrame | None:
    """Catalogue rows of one imported file; None if it has no id column.

    Counts that are no numbers become 0, absent columns null; ids below 1 are dropped.
    """
    fields = [f.name for f in TABLES["anime"] if f.name != "imported_at"]
    cols = aliased(df, {f: CATALOGUE_ALIASES.get(f, (f,)) for f in fields})
    if cols["anime_id"] is None:
        return None
    whole = {"episodes", "members", "favorites", "scored_by"}

    def value(field: str) -> Column:
        column = cols[field]
        if column is None:
            return F.lit(None)
        if field == "anime_id" or field in whole:
            return int_or(column, 0)
        return number(column) if field == "score" else imported_text(column)

    rows = df.select(*[value(f).alias(f) for f in fields], F.lit(imported_at).alias("imported_at"))
    return conform(rows.where("anime_id > 0"), TABLES["anime"])


def imported_list(df: DataFrame, default_status: int, scraped_at: str) -> DataFrame | None:
    """Interaction rows of one imported file; None if it lacks users or items. Scores below 0 become 0."""
    cols = aliased(df, LIST_ALIASES)
    if cols["user_id"] is None or cols["anime_id"] is None:
        return None
    zero = F.lit(0).cast("bigint")
    rows = df.select(
        int_or(cols["user_id"], 0).alias("user_id"), int_or(cols["anime_id"], 0).alias("anime_id"),
        (zero if cols["score"] is None else F.greatest(zero, int_or(cols["score"], 0))).alias("score"),
        (F.lit(default_status) if cols["watching_status"] is None else status_code(cols["watching_status"], default_status)).alias("watching_status"),
        (zero if cols["watched_episodes"] is None else int_or(cols["watched_episodes"], 0)).alias("watched_episodes"), F.lit(scraped_at).alias("scraped_at"),
    )
    return conform(rows.where("user_id > 0 and anime_id > 0"), TABLES["user_anime"])


def derived_users(interactions: DataFrame, at: str, prefix: str = "kaggle_user_") -> tuple[DataFrame, DataFrame]:
    """(users, progress) for the users of imported lists, which count as complete."""
    ids = interactions.select("user_id").distinct()
    users = ids.select("user_id", F.concat(F.lit(prefix), F.col("user_id")).alias("username"), F.lit(None).cast("bigint").alias("source_club_id"), F.lit(at).alias("discovered_at"))
    return users, ids.select("user_id", F.lit(0).alias("last_page"), F.lit(1).alias("completed"), F.lit(at).alias("updated_at"))


def ranked_union(frames: Sequence[DataFrame]) -> DataFrame | None:
    """Frames one under the other with their rank as ``source_rank``, and row order inside as ``source_row``."""
    out = None
    for rank, frame in enumerate(frames):
        part = frame.withColumn("source_rank", F.lit(rank)).withColumn("source_row", F.monotonically_increasing_id())
        out = part if out is None else out.unionByName(part)
    return out


def semantic_rows(spark: SparkSession, path: str) -> DataFrame:
    """Semantic ids from JSON lines: the last row of an item wins; an empty id is an error."""
    rows = spark.read.schema(SEMANTIC_JSON).json(path).where("anime_id is not null").withColumn("_n", F.monotonically_increasing_id())
    last = F.row_number().over(Window.partitionBy("anime_id").orderBy(F.desc("_n")))
    sid = F.coalesce(strip(F.col("semantic_id")), F.lit(""))
    checked = F.when(sid == "", F.raise_error(F.concat(F.lit("empty semantic id of "), F.col("anime_id").cast("string"))).cast("string")).otherwise(sid)
    return rows.withColumn("semantic_id", checked).withColumn("_r", last).where("_r = 1").drop("_r", "_n")


def vocabulary_file(spark: SparkSession, path: str) -> DataFrame:
    """(token_id, token) from a JSON document with a list of tokens."""
    rows = spark.read.option("multiLine", True).json(path)
    return rows.select(F.posexplode("tokens").alias("token_id", "token")).select(F.col("token_id").cast("long").alias("token_id"), "token")


# Fixed value: layout of a page of the catalogue service.
PAYLOAD = (
    "mal_id bigint, title string, title_english string, score double, synopsis string, type string, episodes bigint, season string, year bigint, source string, rating string, "
    "members bigint, favorites bigint, scored_by bigint, genres array<struct<name: string>>, themes array<struct<name: string>>, demographics array<struct<name: string>>, studios array<struct<name: string>>"
)


def payload_rows(pages: DataFrame, column: str, imported_at: str) -> DataFrame:
    """Catalogue rows of JSON payloads {data: {...}}; zeros of counts become null, ids below 1 are dropped."""
    d = F.from_json(F.col(column), f"data struct<{', '.join(': '.join(f.split(' ', 1)) for f in split_fields(PAYLOAD))}>")["data"]
    rows = pages.select(d.alias("d")).where("d.mal_id > 0")
    genres = F.concat_ws(", ", *[join_names(F.col(f"d.{x}")) for x in ("genres", "themes", "demographics")])
    season, year = imported_text(F.col("d.season")), F.coalesce("d.year", F.lit(0))
    premiered = F.when(season.isNotNull() & (year > 0), F.concat_ws(" ", season, year.cast("string"))).when(season.isNotNull(), season).when(year > 0, year.cast("string"))
    count = lambda c: F.nullif(F.col(f"d.{c}"), F.lit(0).cast("bigint"))
    return rows.select(
        F.col("d.mal_id").alias("anime_id"), imported_text(F.col("d.title")).alias("name"), imported_text(F.col("d.title_english")).alias("english_name"), "d.score",
        F.nullif(genres, F.lit("")).alias("genres"), imported_text(F.col("d.synopsis")).alias("synopsis"), imported_text(F.col("d.type")).alias("type"), count("episodes").alias("episodes"),
        premiered.alias("premiered"), join_names(F.col("d.studios")).alias("studios"), imported_text(F.col("d.source")).alias("source"), imported_text(F.col("d.rating")).alias("rating"),
        count("members").alias("members"), count("favorites").alias("favorites"), count("scored_by").alias("scored_by"), F.lit(imported_at).alias("imported_at"),
    )


# Fixed value: layout of a page of a user's list, in both spellings of its fields.
LIST_PAGE = (
    "data array<struct<anime: struct<mal_id: bigint>, anime_id: bigint, mal_id: bigint, score: string, status: string, "
    "episodes_watched: string, watched_episodes: string>>, pagination struct<has_next_page: boolean>"
)


def list_page_rows(pages: DataFrame, column: str) -> DataFrame:
    """Interaction rows of JSON pages (user_id, scraped_at, <column>); entries without an item are dropped."""
    x = F.col("x")
    parsed = pages.select("user_id", "scraped_at", F.explode(F.from_json(column, LIST_PAGE)["data"]).alias("x"))
    item = F.coalesce(F.nullif(x["anime"]["mal_id"], F.lit(0).cast("bigint")), F.nullif(x["anime_id"], F.lit(0).cast("bigint")), x["mal_id"], F.lit(0).cast("bigint"))
    rows = parsed.select(
        "user_id", item.alias("anime_id"), F.coalesce(x["score"].try_cast("int"), F.lit(0)).alias("score"), status_code(x["status"], 0).alias("watching_status"),
        F.coalesce(x["episodes_watched"].try_cast("int"), x["watched_episodes"].try_cast("int"), F.lit(0)).alias("watched_episodes"), "scraped_at",
    )
    return rows.where("anime_id > 0")


def member_page_rows(pages: DataFrame, column: str) -> DataFrame:
    """(username, source_club_id, discovered_at) of JSON pages of club members; empty names are dropped."""
    page = F.from_json(column, "data array<struct<username: string, user: struct<username: string>>>")
    rows = pages.select("club_id", "discovered_at", F.explode(page["data"]).alias("m"))
    name = strip(F.coalesce("m.username", "m.user.username", F.lit("")))
    return rows.select(name.alias("username"), F.col("club_id").alias("source_club_id"), "discovered_at").where("username <> ''")


def club_page_rows(pages: DataFrame, column: str) -> DataFrame:
    """(club_id, members, discovered_at) of JSON pages of clubs."""
    page = F.from_json(column, "data array<struct<mal_id: bigint, members: bigint>>")
    rows = pages.select("discovered_at", F.explode(page["data"]).alias("c"))
    return rows.select(F.coalesce("c.mal_id", F.lit(0).cast("bigint")).alias("club_id"), F.coalesce("c.members", F.lit(0).cast("bigint")).alias("members"), "discovered_at").where("club_id > 0")
