"""Around a run: reuse of what is there, dry runs, and summaries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.config import StageSettings

# Sentences for an evaluation without a data set.
DEFAULT_EVALUATION = (
    "The quick brown fox jumps over the lazy dog.",
    "Language models should preserve fluent English while learning domain tokens.",
    "Anime recommendation benefits from both structured IDs and natural language reasoning.",
    "A reliable training pipeline needs checkpoints, metrics, and reproducible configuration.",
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def built(spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool) -> DataFrame:
    """The parquet table at ``path``: the one that is there, if it has rows and no rebuild is asked for, else a new one."""
    if not rebuild and path_exists(spark, path):
        there = spark.read.parquet(path)
        if not there.isEmpty():
            return there
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def dry_stage(stage: StageSettings, rows: int) -> StageSettings:
    """A stage that uses at most ``rows`` rows."""
    return replace(stage, max_domain_rows=min(stage.max_domain_rows or rows, rows))


def dry_limit(limit: int, dry: int) -> int:
    """Rows of a dry run: at least two, and no more than a limit that is set."""
    return min(max(2, dry), limit) if limit > 0 else max(2, dry)


def evaluation_defaults(spark: SparkSession) -> DataFrame:
    """(text) of the default evaluation."""
    return spark.createDataFrame([(t,) for t in DEFAULT_EVALUATION], "text string")


def training_summary(rows: DataFrame) -> DataFrame:
    """One row: examples, those of each task, distinct users and titles' lists, mean lengths."""
    by_task = [F.count_if(F.col("task") == t).alias(f"task_{t.lower()}") for t in "ABC"]
    return rows.agg(
        F.count("*").alias("examples"), *by_task, F.count_distinct("user_id").alias("users"), F.count_if(F.size("anime_ids") > 1).alias("with_several_titles"),
        F.round(F.avg(F.length("input")), 6).alias("mean_input"), F.round(F.avg(F.length("output")), 6).alias("mean_output"),
    )
