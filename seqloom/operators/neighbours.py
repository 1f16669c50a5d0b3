"""Neighbours of items by shared users and by codes, and how well they agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.vectors import hamming_ratio, prefix_depth


def positive_edges(interactions: DataFrame, items: DataFrame | None, status: int = 2, min_score: int = 7) -> DataFrame:
    """Distinct (user_id, anime_id) that were completed and scored high, of known items."""
    edges = interactions.where((F.col("watching_status") == status) & (F.col("score") >= min_score)).select("user_id", "anime_id")
    edges = edges.where("user_id is not null and anime_id is not null").distinct()
    return edges if items is None else edges.join(items.select("anime_id").distinct(), "anime_id", "left_semi")


def item_support(edges: DataFrame) -> DataFrame:
    """Users of each item, over distinct edges."""
    return edges.groupBy("anime_id").agg(F.count("*").alias("support"))


def query_items(edges: DataFrame, min_support: int = 10, most: int = 500, seed: int = 42) -> DataFrame:
    """Items with enough support, at most ``most`` in a seeded order (0: all)."""
    eligible = item_support(edges).where(F.col("support") >= min_support).select("anime_id")
    return eligible.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("anime_id"))), "anime_id").limit(most) if most > 0 else eligible


def shared_users(edges: DataFrame, queries: DataFrame) -> DataFrame:
    """(anime_id, other_id, shared): users that a query item shares with every other item.

    The query items are put on the left side before the join, so only their users'
    lists are met; counts are partly summed before the shuffle.
    """
    left = edges.join(queries.select("anime_id"), "anime_id", "left_semi")
    right = edges.select("user_id", F.col("anime_id").alias("other_id"))
    return left.join(right, "user_id").where("anime_id <> other_id").groupBy("anime_id", "other_id").agg(F.count("*").alias("shared"))


def jaccard_neighbours(edges: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(anime_id, other_id, jaccard, rank): the k items whose users overlap most, ties by id."""
    support = item_support(edges)
    pairs = shared_users(edges, queries).join(support.withColumnRenamed("support", "s_a"), "anime_id").join(support.select(F.col("anime_id").alias("other_id"), F.col("support").alias("s_b")), "other_id")
    pairs = pairs.withColumn("union", F.col("s_a") + F.col("s_b") - F.col("shared")).where("union > 0")
    pairs = pairs.select("anime_id", "other_id", (F.col("shared").cast("double") / F.col("union")).alias("jaccard"))
    rank = F.row_number().over(Window.partitionBy("anime_id").orderBy(F.desc("jaccard"), "other_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def code_neighbours(codes: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(anime_id, other_id, distance, prefix, rank): the k items with the nearest codes.

    Nearest by the share of differing levels, then by the longer common prefix, then by
    id. The codes are exploded to (level, code), and only items that share one meet;
    where fewer than k do, the smallest other ids follow at distance 1.
    """
    mine = codes.join(queries.select("anime_id"), "anime_id", "left_semi")
    at = lambda df: df.select("anime_id", "codes", F.posexplode("codes").alias("level", "code"))
    a = at(mine)
    b = at(codes).select(F.col("anime_id").alias("other_id"), F.col("codes").alias("other_codes"), "level", "code")
    met = a.join(b, ["level", "code"]).where("anime_id <> other_id").groupBy("anime_id", "other_id").agg(F.any_value("codes").alias("codes"), F.any_value("other_codes").alias("other_codes"))
    near = met.select("anime_id", "other_id", hamming_ratio(F.col("codes"), F.col("other_codes")).alias("distance"), prefix_depth(F.col("codes"), F.col("other_codes")).alias("prefix"))
    # k smallest ids that the query does not meet lie among its smallest (met + k + 1)
    rank = F.row_number().over(Window.partitionBy("anime_id").orderBy("distance", F.desc("prefix"), "other_id"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= k)
    short = mine.select("anime_id").join(near.groupBy("anime_id").agg(F.count("*").alias("n")), "anime_id", "left").where(F.coalesce("n", F.lit(0)) < k).select("anime_id")
    first = codes.select(F.col("anime_id").alias("other_id")).orderBy("other_id").limit(2 * k + 1)  # fewer than k are met, so these suffice
    fill = short.join(F.broadcast(first), F.col("anime_id") != F.col("other_id")).join(near.select("anime_id", "other_id"), ["anime_id", "other_id"], "left_anti")
    rest = fill.select("anime_id", "other_id", F.lit(1.0).alias("distance"), F.lit(0).alias("prefix"))
    return near.drop("rank").unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k)


def recall_at_k(proxy: DataFrame, coded: DataFrame, k: int = 20) -> DataFrame:
    """(anime_id, hits, wanted, recall): share of the proxy neighbours that codes find too."""
    both = proxy.select("anime_id", "other_id").join(coded.select("anime_id", "other_id", F.lit(1).alias("hit")), ["anime_id", "other_id"], "left")
    counted = both.groupBy("anime_id").agg(F.count("hit").alias("hits"), F.least(F.lit(k), F.count("*")).cast("bigint").alias("wanted"))
    return counted.withColumn("recall", F.col("hits") / F.greatest(F.col("wanted"), F.lit(1)))


def recall_report(recall: DataFrame, k: int, min_support: int) -> DataFrame:
    """One row: queries evaluated, mean and median recall, and the status."""
    return recall.agg(
        F.when(F.count("*") > 0, "ok").otherwise("skipped").alias("status"), F.lit(k).alias("recall_k"), F.lit(min_support).alias("min_support"),
        F.count("*").alias("evaluated_queries"), F.round(F.avg("recall"), 9).alias("mean_recall"), F.round(F.median("recall"), 9).alias("median_recall"),
    )


def recall_examples(recall: DataFrame, n: int = 5) -> DataFrame:
    """The n best and the n worst queries, ties by id."""
    worst = recall.orderBy("recall", "anime_id").limit(n).withColumn("kind", F.lit("worst"))
    best = recall.orderBy(F.desc("recall"), F.desc("anime_id")).limit(n).withColumn("kind", F.lit("best"))
    return worst.unionByName(best).select("kind", "anime_id", "recall")


def code_buckets(tokens: DataFrame) -> DataFrame:
    """(first_token, bucket_size, first_id): items by their first token."""
    return tokens.where(F.size("tokens") > 0).groupBy(F.element_at("tokens", 1).alias("first_token")).agg(F.count("*").alias("bucket_size"), F.min("anime_id").alias("first_id"))


def bucket_purity(tokens: DataFrame, min_bucket: int = 20, most: int = 20, sample: int = 10, seed: int = 42) -> DataFrame:
    """(first_token, bucket_size, avg_genre_jaccard) of the largest buckets.

    ``tokens``: (anime_id, tokens, genres array). Of each bucket a seeded sample is
    compared pair by pair; members without genres are left out, and fewer than two
    give null.
    """
    large = code_buckets(tokens).where(F.col("bucket_size") >= min_bucket).orderBy(F.desc("bucket_size"), "first_id").limit(most)
    rows = tokens.where(F.size("tokens") > 0).select(F.element_at("tokens", 1).alias("first_token"), "anime_id", "genres").join(F.broadcast(large), "first_token")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("anime_id")))
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("first_token").orderBy(order, "anime_id"))).where(F.col("r") <= sample)
    a, b = rows.where(F.size("genres") > 0).alias("a"), rows.where(F.size("genres") > 0).alias("b")
    pairs = a.join(b, (F.col("a.first_token") == F.col("b.first_token")) & (F.col("a.r") < F.col("b.r")))
    score = F.size(F.array_intersect("a.genres", "b.genres")) / F.size(F.array_union("a.genres", "b.genres"))
    purity = pairs.groupBy(F.col("a.first_token").alias("first_token")).agg(F.round(F.avg(score), 9).alias("avg_genre_jaccard"))
    return large.select("first_token", "bucket_size").join(purity, "first_token", "left")


def global_purity(purity: DataFrame) -> DataFrame:
    """One row: buckets inspected, and the mean of those purities that there are (null of none)."""
    return purity.agg(F.count("*").alias("inspected_buckets"), F.round(F.avg("avg_genre_jaccard"), 9).alias("global_avg_genre_jaccard"))


def bucket_samples(tokens: DataFrame, buckets: DataFrame, sample: int = 10, seed: int = 42) -> DataFrame:
    """(first_token, samples): the members that :func:`bucket_purity` compared, with their names and genres."""
    rows = tokens.where(F.size("tokens") > 0).withColumn("first_token", F.element_at("tokens", 1)).join(F.broadcast(buckets.select("first_token")), "first_token")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("anime_id")))
    place = F.row_number().over(Window.partitionBy("first_token").orderBy(order, "anime_id"))
    shown = [c for c in ("anime_id", "name", "english_name", "genres", "semantic_id") if c in rows.columns]
    kept = rows.withColumn("_r", place).where(F.col("_r") <= sample)
    return kept.groupBy("first_token").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", *shown))), lambda x: F.struct(*[x[c].alias(c) for c in shown])).alias("samples"))
