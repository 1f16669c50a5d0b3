"""Queries on merging, progress and import."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.instants import instant_micros
from seqloom.functions.text import join_url, status_code
from seqloom.operators.merge import club_candidates, first_writer, insert_or_ignore, missing_items, pending, progress_rows, resume_snapshot, total_members, upsert, with_progress
from seqloom.queries.common import _TS, UA, interactions
from seqloom.session import shared_folder, table
from seqloom.sources.readers import derived_users, payload_rows
from seqloom.streaming.pages import TableStore, page_progress, page_stream, upsert_stream


def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    return interactions(spark, d)


def first_interactions(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "user_anime").withColumn("at", instant_micros(F.col("scraped_at")))
    order = [F.coalesce(c, F.lit(-1)) for c in ("at", "score", "watching_status", "watched_episodes")]
    return first_writer(rows, ["user_id", "anime_id"], order).select("user_id", "anime_id", "score", "watching_status", F.col("at").alias("at_us"))


def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    """Old list rows first; later ones only where the pair is new."""
    rows = interactions(spark, d)
    cut = 1_685_577_600_000_000  # 2023-06-01
    order = [F.col("scraped_at")]
    _, fresh = insert_or_ignore(rows.where(F.col("scraped_at") < cut).select("user_id", "anime_id"), rows.select("anime_id", "user_id", "scraped_at"), ["user_id", "anime_id"], order)
    return fresh.groupBy("user_id").agg(F.count("*").alias("n_new"))


def missing_catalog_ids(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "anime_embeddings").where("anime_id % 7 = 0").select("anime_id", F.lit(1).alias("completed")).distinct()
    return missing_items(table(spark, d, "user_anime"), table(spark, d, "anime_prep"), done)


def _progress(spark: SparkSession, d: str) -> DataFrame:
    """Pages of 100 rows a user; complete if the last page is not full."""
    per_user = table(spark, d, "user_anime").where("user_id > 0").groupBy("user_id").agg(F.count("*").alias("n"))
    made = per_user.select("user_id", F.floor(F.col("n") / 100).cast("int").alias("page"), (F.col("n") % 100 > 50).alias("done"), F.lit("2024-01-01").alias("at"))
    return progress_rows(made, "user_id", "page", "done", "at")


def progress_left_join(spark: SparkSession, d: str) -> DataFrame:
    return with_progress(table(spark, d, "users").select("user_id", "username"), _progress(spark, d), "user_id")


def pending_users(spark: SparkSession, d: str) -> DataFrame:
    return pending(table(spark, d, "users").select("user_id"), _progress(spark, d), "user_id").select("user_id", "last_page")


def _clubs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "users").where("source_club_id is not null").groupBy(F.col("source_club_id").alias("club_id")).agg(F.count("*").alias("members"))


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    clubs = _clubs(spark, d)
    club_done = clubs.select("club_id", F.when(F.col("members") > 20, 1).otherwise(0).alias("completed"))
    return resume_snapshot(clubs, club_done, table(spark, d, "users"), _progress(spark, d), table(spark, d, "user_anime"), table(spark, d, "anime_prep"))


def club_sum(spark: SparkSession, d: str) -> DataFrame:
    return total_members(_clubs(spark, d))


def club_filter(spark: SparkSession, d: str) -> DataFrame:
    return club_candidates(_clubs(spark, d), _clubs(spark, d).where("club_id % 5 = 0"), 10)


def latest_users(spark: SparkSession, d: str) -> DataFrame:
    """Last writer per lower-case name."""
    users = table(spark, d, "users").withColumn("username", F.lower("username"))
    return upsert(None, users.select("username", "user_id", "source_club_id", "discovered_at"), ["username"], [F.coalesce(instant_micros(F.col("discovered_at")), F.lit(-1)), F.col("user_id")]).select("username", "user_id")


def imported_users(spark: SparkSession, d: str) -> DataFrame:
    users, progress = derived_users(table(spark, d, "user_anime").where("user_id > 0"), "2024-01-01")
    return users.join(progress, "user_id").select("user_id", "username", "completed")


def status_codes(spark: SparkSession, d: str) -> DataFrame:
    """States given as names and numbers."""
    words = F.element_at(F.array(*[F.lit(w) for w in ("Watching", "COMPLETED", "on-hold", "Dropped", "plan_to watch", "6", "-3", "other")]), (F.pmod("event_id", F.lit(8)) + 1).cast("int"))
    return table(spark, d, "events").select("event_id", status_code(words, 2).alias("code"))


def request_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "anime_prep").select("anime_id").distinct().select("anime_id", join_url("http://localhost/v4/", F.concat(F.lit("/anime/"), F.col("anime_id"), F.lit("/full"))).alias("url"))


def payload_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue rows as JSON payloads, and read again."""
    p = table(spark, d, "part")
    names = F.transform(F.split("p_name", " "), lambda x: F.struct(x.alias("name")))
    data = F.struct(
        F.col("p_partkey").alias("mal_id"), F.concat(F.lit("  "), F.col("p_name")).alias("title"), F.col("p_brand").alias("title_english"), F.lit(7.5).alias("score"), F.col("p_type").alias("type"),
        F.when(F.col("p_size") > 25, F.col("p_size")).otherwise(0).alias("episodes"), F.when(F.col("p_size") % 2 == 0, "spring").alias("season"), (F.col("p_size") + 1970).alias("year"),
        names.alias("genres"), F.array(F.struct(F.col("p_brand").alias("name"))).alias("themes"),
    )
    pages = p.select(F.to_json(F.struct(data.alias("data"))).alias("body"))
    return payload_rows(pages, "body", "2024-01-01").select("anime_id", "name", "english_name", "genres", "episodes", "premiered")


def page_state(spark: SparkSession, d: str) -> DataFrame:
    """Progress of fetched pages, here the events of every user."""
    e = table(spark, d, "events")
    pages = e.select("user_id", F.pmod("event_id", F.lit(9)).alias("page"), (F.col("value") > 10).alias("has_next"), F.when(F.pmod("event_id", F.lit(13)) == 0, 429).otherwise(200).alias("status"), F.col("ts").alias("fetched_at"))
    return page_progress(pages, "user_id").select("user_id", "last_page", "completed")


def stream_latest_events(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of files, merged into a table of the latest of each user and kind."""
    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    store = TableStore(spark, f"{at}/table")
    stream = page_stream(spark, f"{d}/events.parquet*", table(spark, d, "events").schema)
    upsert_stream(stream.select("user_id", "event_type", "event_id", "ts", "value"), store, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], f"{at}/offsets").awaitTermination()
    return store.read().select("user_id", "event_type", "event_id", "value")


_PROG = """p AS (SELECT user_id, CAST(floor(count(*) / 100) AS INTEGER) AS last_page, CAST(count(*) % 100 > 50 AS INTEGER) AS completed FROM user_anime WHERE user_id > 0 GROUP BY 1)"""
_CLUBS = "clubs AS (SELECT source_club_id AS club_id, count(*) AS members FROM users WHERE source_club_id IS NOT NULL GROUP BY 1)"
QUERIES = {
    "upsert_latest": upsert_latest, "first_interactions": first_interactions, "insert_ignore": insert_ignore, "missing_catalog_ids": missing_catalog_ids,
    "progress_left_join": progress_left_join, "pending_users": pending_users, "resume_snapshot": snapshot, "club_sum": club_sum, "club_filter": club_filter,
    "latest_users": latest_users, "imported_users": imported_users, "status_codes": status_codes, "request_urls": request_urls, "payload_catalogue": payload_catalogue,
    "page_state": page_state, "stream_latest_events": stream_latest_events,
}
ORACLES = {
    "upsert_latest": f"WITH {UA} SELECT * FROM ua",
    "first_interactions": f"""SELECT user_id, anime_id, score, watching_status, at_us FROM (SELECT *, epoch_us({_TS.format(c="scraped_at")}) AS at_us,
      row_number() OVER (PARTITION BY user_id, anime_id ORDER BY epoch_us({_TS.format(c="scraped_at")}), coalesce(score, -1), coalesce(watching_status, -1), coalesce(watched_episodes, -1)) AS r
      FROM user_anime WHERE user_id IS NOT NULL AND anime_id IS NOT NULL) WHERE r = 1""",
    "insert_ignore": f"WITH {UA} SELECT user_id, CAST(count(*) AS BIGINT) AS n_new FROM ua WHERE scraped_at >= 1685577600000000 GROUP BY 1",
    "missing_catalog_ids": """SELECT DISTINCT u.anime_id FROM user_anime u LEFT JOIN anime_prep a ON a.anime_id = u.anime_id
      LEFT JOIN (SELECT DISTINCT anime_id FROM anime_embeddings WHERE anime_id % 7 = 0) p ON p.anime_id = u.anime_id WHERE a.anime_id IS NULL AND p.anime_id IS NULL AND u.anime_id IS NOT NULL""",
    "progress_left_join": f"WITH {_PROG} SELECT u.user_id, u.username, coalesce(last_page, 0) AS last_page, coalesce(completed, 0) AS completed FROM users u LEFT JOIN p ON p.user_id = u.user_id",
    "pending_users": f"WITH {_PROG} SELECT u.user_id, coalesce(last_page, 0) AS last_page FROM users u LEFT JOIN p ON p.user_id = u.user_id WHERE coalesce(completed, 0) = 0",
    "resume_snapshot": f"""WITH {_PROG}, {_CLUBS} SELECT a AS clubs, b AS clubs_done, c AS users, e AS users_done, f AS interactions, g AS catalogue, round(b * 100.0 / a, 6) AS clubs_pct, round(e * 100.0 / c, 6) AS users_pct FROM (
      SELECT (SELECT count(*) FROM clubs) AS a, (SELECT count(*) FROM clubs WHERE members > 20) AS b, (SELECT count(*) FROM users) AS c,
      (SELECT count(*) FROM p WHERE completed = 1) AS e, (SELECT count(*) FROM user_anime) AS f, (SELECT count(*) FROM anime_prep) AS g)""",
    "club_sum": f"WITH {_CLUBS} SELECT CAST(coalesce(sum(members), 0) AS BIGINT) AS members FROM clubs",
    "club_filter": f"WITH {_CLUBS} SELECT club_id, members FROM clubs WHERE club_id > 0 AND members > 10 AND club_id % 5 <> 0",
    "latest_users": f"SELECT username, user_id FROM (SELECT lower(username) AS username, user_id, row_number() OVER (PARTITION BY lower(username) ORDER BY coalesce(epoch_us({_TS.format(c='discovered_at')}), -1) DESC, user_id DESC) AS r FROM users) WHERE r = 1",
    "imported_users": "SELECT DISTINCT user_id, 'kaggle_user_' || user_id AS username, 1 AS completed FROM user_anime WHERE user_id > 0",
    "status_codes": "SELECT event_id, [1, 2, 3, 4, 6, 6, 2, 2][event_id % 8 + 1] AS code FROM events",
    "request_urls": "SELECT DISTINCT anime_id, 'http://localhost/v4/anime/' || anime_id || '/full' AS url FROM anime_prep WHERE anime_id IS NOT NULL",
    "payload_catalogue": """SELECT p_partkey AS anime_id, p_name AS name, p_brand AS english_name, list_aggregate(list_filter(string_split(p_name, ' '), lambda x, i: list_position(string_split(p_name, ' '), x) = i), 'string_agg', ', ') || ', ' || p_brand AS genres,
      CASE WHEN p_size > 25 THEN CAST(p_size AS BIGINT) END AS episodes, CASE WHEN p_size % 2 = 0 THEN 'spring ' ELSE '' END || (p_size + 1970) AS premiered FROM part WHERE p_partkey > 0""",
    "page_state": """SELECT user_id, CAST(coalesce(max(CASE WHEN event_id % 13 <> 0 THEN event_id % 9 END), 0) AS INTEGER) AS last_page,
      CAST(coalesce(bool_or(event_id % 13 <> 0 AND NOT coalesce(value > 10, false)), false) AS INTEGER) AS completed FROM events GROUP BY 1""",
    "stream_latest_events": "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
}
