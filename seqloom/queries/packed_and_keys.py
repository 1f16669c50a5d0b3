"""Queries p4_ and p6_: packed fields and keys with very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.key_stats import heavy_keys, key_stats
from seqloom.operators.packed_fields import explode_packed, known_names
from seqloom.session import table

FIELDS = ("genres", "studios", "producers", "licensors")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_packed(table(spark, sf_dir, "anime_prep"), "anime_id", FIELDS, known_names(table(spark, sf_dir, "credit_names")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names of every packed field with their place."""
    return _packed(spark, sf_dir).distinct()


def p4_name_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many titles bear each name, and how often it stands first."""
    return (
        _packed(spark, sf_dir)
        .groupBy("field", "item", "anime_id")
        .agg(F.min("pos").alias("pos"))
        .groupBy("field", "item")
        .agg(F.count("*").alias("n_titles"), F.count_if(F.col("pos") == 0).alias("n_first"))
    )


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a score counts from 1 to 10: 0 means unrated, others are faults
    score = F.when(F.col("score").between(1, 10), F.col("score"))
    return key_stats(table(spark, sf_dir, "user_anime"), "anime_id", "user_id", score)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that hold at least 2 % of the stored rows."""
    total = table(spark, sf_dir, "user_anime").count()
    return heavy_keys(_stats(spark, sf_dir), total, 0.02).select("key_field", "key_value")


def p6_key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct counterparts and mean score of every title and every user."""
    return _stats(spark, sf_dir).select("key_field", "key_value", "n_rows", "n_counterparts", F.round("mean_value", 6).alias("mean_score"))


_ONE = """SELECT '{k}' AS key_field, {k} AS key_value, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(DISTINCT {o}) AS BIGINT) AS n_counterparts, round(avg(CASE WHEN score BETWEEN 1 AND 10 THEN score END), 6) AS mean_score
  FROM user_anime WHERE {k} IS NOT NULL GROUP BY {k}"""
_BOTH = _ONE.format(k="anime_id", o="user_id") + " UNION ALL " + _ONE.format(k="user_id", o="anime_id")

QUERIES = {"p4_found": p4_found, "p4_name_counts": p4_name_counts, "p6_found": p6_found, "p6_key_stats": p6_key_stats}
ORACLES = {
    "p6_key_stats": _BOTH,
    "p6_found": f"SELECT key_field, key_value FROM ({_BOTH}) WHERE n_rows >= 0.02 * (SELECT count(*) FROM user_anime)",
}
