"""Insert-or-ignore, upsert and progress keeping as plans over immutable tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import checkpoint


def first_writer(incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ingest order; rows with a null key are kept out."""
    rows = incoming.where(~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_r", place).where("_r = 1").drop("_r")


def insert_or_ignore(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(table, inserted): rows whose key is new are added, the first one of each key."""
    fresh = first_writer(incoming, keys, order)
    if existing is None:
        return fresh, fresh
    fresh = fresh.join(existing.select(*keys), list(keys), "left_anti")
    columns = existing.columns
    fresh = fresh.select(*columns)
    return existing.unionByName(fresh), fresh


def insert_or_ignore_two_keys(existing: DataFrame | None, incoming: DataFrame, first: str, second: str, order: Sequence[Column]) -> DataFrame:
    """Insert-or-ignore where either key alone must be new, for rows in one ingest order.

    Rows that clash with the table go first, then each key keeps its first writer.
    A row that loses by its second key does not block its first key for a later row:
    the losers are tried again against the winners until none is left. The first of
    all pending rows always wins, so every round settles some; a chain of n clashes
    takes about n / 2 rounds. A null key clashes with nothing.
    """
    columns = incoming.columns
    keyless = F.col(first).isNull() & F.col(second).isNull()
    pending = checkpoint(incoming.where(~keyless).withColumn("_row", F.monotonically_increasing_id()))  # decides between equal places
    free = incoming.where(keyless)
    table = free if existing is None else existing.unionByName(free)
    taken = existing
    while True:
        if taken is not None:
            for key in (first, second):
                pending = pending.join(taken.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
            pending = checkpoint(pending)
        if pending.isEmpty():
            return table
        # rows with a null key are alone, each in a window of its own
        place = lambda key: F.row_number().over(Window.partitionBy(key, F.when(F.col(key).isNull(), F.col("_row"))).orderBy(*order, "_row"))
        taken = checkpoint(pending.withColumn("_a", place(first)).withColumn("_b", place(second)).where("_a = 1 and _b = 1").select(*columns, "_row"))
        pending = pending.join(taken.select("_row"), "_row", "left_anti")
        table = table.unionByName(taken.select(*columns))


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], version: Sequence[Column]) -> DataFrame:
    """The row of the highest version for each key; ``version`` must order rows fully.

    A struct maximum, which is partly reduced before the shuffle, so a key with very
    many versions is never gathered.
    """
    rows = incoming if existing is None else existing.unionByName(incoming)
    values = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*[v.alias(f"_v{i}") for i, v in enumerate(version)], *values)).alias("_m"))
    return best.select(*keys, *[F.col("_m")[c].alias(c) for c in values]).select(*rows.columns)


def progress_rows(df: DataFrame, key: str, page: str, completed: str, updated_at: str) -> DataFrame:
    """Progress rows: the last page is at least 0, completed is 0 or 1."""
    return df.select(
        key,
        F.greatest(F.lit(0), F.coalesce(F.col(page), F.lit(0))).cast("int").alias("last_page"),
        F.coalesce(F.col(completed).cast("boolean"), F.lit(False)).cast("int").alias("completed"),
        F.col(updated_at).alias("updated_at"),
    )


def with_progress(items: DataFrame, progress: DataFrame, key: str) -> DataFrame:
    """Items with last_page and completed, 0 where there is no progress yet."""
    known = progress.select(key, "last_page", "completed")
    return items.join(known, key, "left").withColumns({c: F.coalesce(c, F.lit(0)).cast("int") for c in ("last_page", "completed")})


def pending(items: DataFrame, progress: DataFrame, key: str, limit: int = 0) -> DataFrame:
    """Items that are not completed, at most ``limit`` by key (0: all)."""
    left = with_progress(items, progress, key).where("completed = 0")
    return left.orderBy(key).limit(limit) if limit > 0 else left


def state_value(state: DataFrame, key: str, default: int = 0) -> DataFrame:
    """One row with the whole number kept under a key of (key, value), or the default."""
    found = F.max(F.when(F.col("key") == key, F.col("value").try_cast("bigint")))
    return state.agg(F.coalesce(found, F.lit(default).cast("bigint")).alias("value"))


def drop_state(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key-value rows without the given keys."""
    return state.where(~F.col("key").isin(list(keys)))


def completed_scans(scans: DataFrame) -> DataFrame:
    """Progress rows for scans of an older layout: all are complete."""
    return scans.select("club_id", F.lit(0).alias("last_page"), F.lit(1).alias("completed"), F.col("scanned_at").alias("updated_at"))


def missing_items(interactions: DataFrame, catalogue: DataFrame, progress: DataFrame, key: str = "anime_id") -> DataFrame:
    """Distinct item ids that have no catalogue row and are not marked as completed."""
    done = progress.where("completed = 1").select(key)
    ids = interactions.select(key).where(F.col(key).isNotNull()).distinct()
    return ids.join(catalogue.select(key), key, "left_anti").join(done, key, "left_anti")


def resume_snapshot(clubs: DataFrame, club_progress: DataFrame, users: DataFrame, user_progress: DataFrame, interactions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row of counts, with the share of clubs and users that are done (0 of none)."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    def done(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count_if(F.col("completed") == 1).alias(name))

    row = count(clubs, "clubs")
    for part in (done(club_progress, "clubs_done"), count(users, "users"), done(user_progress, "users_done"), count(interactions, "interactions"), count(catalogue, "catalogue")):
        row = row.crossJoin(part)  # one row each
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) * 100.0 / F.col(b)).otherwise(0.0)
    return row.withColumns({"clubs_pct": F.round(share("clubs_done", "clubs"), 6), "users_pct": F.round(share("users_done", "users"), 6)})


def club_candidates(clubs: DataFrame, seen: DataFrame, min_members: int) -> DataFrame:
    """New clubs with a positive id and more than the least number of members."""
    return clubs.where((F.col("club_id") > 0) & (F.col("members") > min_members)).join(seen.select("club_id"), "club_id", "left_anti")


def total_members(clubs: DataFrame) -> DataFrame:
    """Sum of members, 0 for no clubs."""
    return clubs.agg(F.coalesce(F.sum("members"), F.lit(0)).alias("members"))
