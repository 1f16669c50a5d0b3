"""Ordered watch histories, masks and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks in prompts.
ANIME_START, ANIME_END, MASK = "<anime_start>", "<anime_end>", "[MASK]"
WATCH, LIKED, DISLIKED, DROPPED = "<watch>", "<liked>", "<disliked>", "<dropped>"
STATUSES = (1, 2, 3, 4, 6)


def sentiment(score: Column, status: Column, liked_from: int = 7) -> Column:
    """Dropped by state, else liked, disliked or plain watch by score; 0 is no score."""
    return (
        F.when(status == 4, DROPPED)
        .when(score >= liked_from, LIKED)
        .when((score > 0) & (score <= max(1, liked_from // 2)), DISLIKED)
        .otherwise(WATCH)
    )


def history_order(newest_first: bool = False) -> list[Column]:
    """Order of a history: time, state, higher score, more episodes, id."""
    keys = [("scraped_at", True), ("watching_status", True), ("score", False), ("watched_episodes", False), ("anime_id", True)]
    return [F.col(c).asc() if up != newest_first else F.col(c).desc() for c, up in keys]


def known_interactions(interactions: DataFrame, items: DataFrame, statuses: Sequence[int] = STATUSES) -> DataFrame:
    """Rows with an allowed state, of items that have a semantic id."""
    return interactions.where(F.col("watching_status").isin(list(statuses))).join(items.select("anime_id").distinct(), "anime_id", "left_semi")


def histories(interactions: DataFrame, min_history: int = 4, max_history: int = 30) -> DataFrame:
    """Each user's last ``max_history`` rows with pos, history_len and whether there were enough.

    Ranked newest first, so Spark keeps no more than ``max_history`` rows a user on
    either side of the shuffle; the full count comes from a partial aggregate.
    """
    counts = interactions.groupBy("user_id").agg(F.count("*").alias("total"))
    newest = F.row_number().over(Window.partitionBy("user_id").orderBy(*history_order(newest_first=True)))
    kept = interactions.withColumn("_r", newest).where(F.col("_r") <= max_history)
    length = F.least(F.col("total"), F.lit(max_history)).cast("int")
    return (
        kept.join(counts, "user_id")
        .withColumn("history_len", length)
        .withColumn("pos", (F.col("history_len") - F.col("_r")).cast("int"))
        .withColumn("valid", F.col("total") >= min_history)
        .drop("_r", "total")
    )


def random_position(user_id: Column, history_len: Column, seed: int) -> Column:
    """A position before the last one, fixed by user and seed."""
    upper = F.greatest(F.lit(1), history_len - 1)
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), user_id)), 1, 8), 16, 10).cast("bigint"), upper.cast("bigint")).cast("int")


def mask_positions(user_id: Column, history_len: Column, modes: Sequence[str], seed: int) -> Column:
    """Array of (mode, index), each index once; none for fewer than two rows."""
    found = []
    for mode in modes:
        if mode == "last":
            found.append(F.struct(F.lit("last").alias("mode"), (history_len - 1).cast("int").alias("index")))
        elif mode == "random":
            found.append(F.struct(F.lit("random").alias("mode"), random_position(user_id, history_len, seed).alias("index")))
        else:
            raise ValueError(f"unknown mask mode {mode!r}")
    every = F.array(*found)
    first = F.filter(every, lambda x, i: ~F.exists(F.slice(every, F.lit(1), i), lambda y: y["index"] == x["index"]))
    return F.when(history_len >= 2, first).otherwise(F.slice(every, 1, 0))


def user_sequences(history: DataFrame, semantic: DataFrame, liked_from: int = 7) -> DataFrame:
    """(user_id, history_len, items): ordered (anime_id, sid, mark) of each user with enough history."""
    rows = history.where("valid").join(semantic.select("anime_id", "semantic_id"), "anime_id")
    item = F.struct("pos", "anime_id", F.col("semantic_id").alias("sid"), sentiment(F.col("score"), F.col("watching_status"), liked_from).alias("mark"))
    return rows.groupBy("user_id", "history_len").agg(F.array_sort(F.collect_list(item)).alias("items"))  # at most max_history a user


def mask_prompt(items: Column, index: Column) -> Column:
    """'A user watched <..>sid<..> mark then watched ...' with one position masked."""

    def chunk(x: Column, i: Column) -> Column:
        masked = i == index
        shown = F.when(masked, MASK).otherwise(x["sid"])
        lead = F.when(i == 0, "A user watched ").otherwise("then watched ")
        return F.concat(lead, F.lit(ANIME_START), shown, F.lit(ANIME_END), F.when(masked, "").otherwise(F.concat(F.lit(" "), x["mark"])))

    return F.array_join(F.transform(items, chunk), " ")


def masked_rows(sequences: DataFrame, modes: Sequence[str] = ("last", "random"), seed: int = 42) -> DataFrame:
    """Task B rows: one for each distinct masked position of each user."""
    masks = sequences.withColumn("m", F.explode(mask_positions(F.col("user_id"), F.col("history_len"), modes, seed)))
    index = F.col("m.index")
    return masks.select(
        F.lit("B").alias("task"), mask_prompt(F.col("items"), index).alias("input"), F.try_element_at("items", index + 1)["sid"].alias("output"),
        F.transform("items", lambda x: x["anime_id"]).alias("anime_ids"), "user_id",
        F.struct(F.lit("watch_sequence_mask").alias("template_id"), F.col("m.mode").alias("mask_mode"), index.alias("mask_index"), "history_len", F.lit(None).cast("string").alias("kind")).alias("meta"),
    )


def liked_items(history: DataFrame, interactions: DataFrame, liked_from: int = 7, most: int = 3) -> DataFrame:
    """(user_id, liked): the best ``most`` items of each user by score, then id.

    Users with enough history are judged by their kept rows, the others by all rows.
    """
    short = interactions.join(history.where("valid").select("user_id").distinct(), "user_id", "left_anti")
    rows = history.where("valid").select("user_id", "anime_id", "score").unionByName(short.select("user_id", "anime_id", "score"))
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("score"), "anime_id"))
    best = rows.where(F.col("score") >= liked_from).withColumn("r", rank).where(F.col("r") <= most)
    return best.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "anime_id"))), lambda x: x["anime_id"]).alias("liked"))


def seeds(liked: DataFrame) -> DataFrame:
    """(user_id, kind, anime_ids): a single seed for any liked item, a triple for three."""
    one = F.struct(F.lit("single").alias("kind"), F.slice("liked", 1, 1).alias("ids"))
    three = F.struct(F.lit("triple").alias("kind"), F.slice("liked", 1, 3).alias("ids"))
    both = F.filter(F.array(one, three), lambda x: F.size(x["ids"]) == F.when(x["kind"] == "single", 1).otherwise(3))
    return liked.select("user_id", F.explode(both).alias("s")).select("user_id", "s.kind", F.col("s.ids").alias("anime_ids"))


def users_until_full(per_user: DataFrame, want_masks: int, want_seeds: int) -> DataFrame:
    """Users in order of id up to the one at which both pools are full.

    ``per_user``: (user_id, masks, seeds). The running sums go over counts per user,
    range-partitioned by user: each partition adds up on its own and starts from the
    sum of those before it.
    """
    from seqloom.operators.sampling import running_totals

    summed = running_totals(per_user, "user_id", ("masks", "seeds"))
    return summed.where(~((F.col("masks_before") >= want_masks) & (F.col("seeds_before") >= want_seeds))).select("user_id")


def scan_statistics(interactions: DataFrame, items: DataFrame, statuses: Sequence[int] = STATUSES, min_history: int = 4) -> DataFrame:
    """One row: rows and users scanned, unknown items dropped, users with enough and too little history."""
    known = items.select("anime_id", F.lit(1).alias("k")).distinct()
    rows = interactions.where(F.col("watching_status").isin(list(statuses))).join(known, "anime_id", "left")
    per_user = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count("k").alias("m"))
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_scanned"), F.count("*").alias("users_scanned"), F.count_if(F.col("m") >= min_history).alias("users_with_valid_history"),
        F.coalesce(F.sum(F.col("n") - F.col("m")), F.lit(0)).alias("dropped_unknown_items"), F.count_if(F.col("m") < min_history).alias("dropped_short_history_users"),
    )
