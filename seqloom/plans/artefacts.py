"""Artefacts of a tokenisation and of a training set: tables, documents, summaries."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.codebooks import token_counts, vocabulary
from seqloom.operators.neighbours import bucket_purity, bucket_samples, code_buckets, code_neighbours, global_purity, item_support, jaccard_neighbours, positive_edges, query_items, recall_at_k, recall_examples
from seqloom.operators.sampling import quotas
from seqloom.operators.sequences import scan_statistics
from seqloom.operators.tasks import template_counts
from seqloom.operators.validation import require_rows
from seqloom.plans.tokenise import semantic_ids
from seqloom.plans.training_set import PrepSettings, pools, training_set
from seqloom.session import checkpoint
from seqloom.sources.writers import write_json_lines

# The files that a rebuild deletes first.
MANAGED = (
    "semantic_ids.jsonl", "semantic_lookup.tsv", "semantic_id_to_anime.jsonl", "semantic_vocab.json", "special_tokens.json", "token_stats.json",
    "cluster_inspection.jsonl", "cluster_summary.json", "recall_report.json", "tokenize_config.json", "tokenize_run_summary.json",
)


@dataclass(frozen=True)
class TokeniseSettings:
    """``limit``: items with the smallest ids only, 0 for all; the recall settings are those of the evaluation."""

    limit: int = 0
    rebuild: bool = False
    concat: bool = True
    separator: str = ""
    special: tuple[str, ...] = ("<anime_start>", "<anime_end>", "<watch>", "<liked>", "<disliked>", "<dropped>")
    cluster_sample: int = 10
    cluster_min_bucket: int = 20
    recall_k: int = 20
    recall_min_support: int = 10
    recall_max_queries: int = 500
    completed_status: int = 2
    score_min: int = 7
    seed: int = 42


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def write_json(spark: SparkSession, body: Mapping, name: str) -> None:
    """A mapping as one readable JSON document, on any file system that Spark knows."""
    fs, path = _path(spark, name)
    out = fs.create(path, True)
    try:
        out.write(bytearray((json.dumps(body, indent=2, ensure_ascii=False, default=str) + "\n").encode()))
    finally:
        out.close()


def reset(spark: SparkSession, folder: str) -> list[str]:
    """Deletes the managed files of a folder, and nothing else; their names."""
    gone = []
    for name in MANAGED:
        fs, path = _path(spark, f"{folder}/{name}")
        if fs.exists(path):
            fs.delete(path, True)
            gone.append(name)
    return gone


def vocabulary_documents(vocab: DataFrame, counts: DataFrame, levels: int, size: int, at: str) -> dict[str, dict]:
    """The three documents on the vocabulary, whose size is levels times codes."""
    rows = vocab.orderBy("token_id").collect()
    special = [r["token"] for r in rows if r["kind"] == "special"]
    observed = [[r["token"], r["n"]] for r in counts.orderBy(F.desc("n"), "token").collect()]
    tokens = [r["token"] for r in rows]
    return {
        "semantic_vocab.json": {"tokenized_at": at, "rq_levels": levels, "codebook_size": size, "vocab_size": len(tokens), "special_tokens": special, "tokens": tokens, "token_to_id": {r["token"]: r["token_id"] for r in rows}},
        "special_tokens.json": {"special_tokens": special},
        "token_stats.json": {"observed_counts": observed, "observed_token_total": sum(n for _, n in observed)},
    }


def inspect_clusters(tokens: DataFrame, settings: TokeniseSettings = TokeniseSettings()) -> tuple[DataFrame, dict]:
    """(the largest buckets with their purity and samples, the summary over all of them)."""
    purity = checkpoint(bucket_purity(tokens, settings.cluster_min_bucket, 20, settings.cluster_sample, settings.seed))
    eligible = code_buckets(tokens).where(F.col("bucket_size") >= settings.cluster_min_bucket).count()
    total = global_purity(purity).first()
    summary = {"bucket_min_size": settings.cluster_min_bucket, "eligible_bucket_count": eligible, "inspected_bucket_count": total["inspected_buckets"], "global_avg_genre_jaccard": total["global_avg_genre_jaccard"]}
    return purity.join(bucket_samples(tokens, purity, settings.cluster_sample, settings.seed), "first_token"), summary


def recall_document(interactions: DataFrame | None, codes: DataFrame, settings: TokeniseSettings = TokeniseSettings()) -> dict:
    """The recall report; ``skipped`` without a log, without items of enough support, and without any query that was evaluated."""
    if interactions is None:
        return {"status": "skipped", "reason": "no interactions"}
    edges = checkpoint(positive_edges(interactions, codes, settings.completed_status, settings.score_min))
    if item_support(edges).where(F.col("support") >= settings.recall_min_support).isEmpty():
        people = edges.select("user_id").distinct().count()
        return {"status": "skipped", "reason": "no item has enough support", "min_support": settings.recall_min_support, "total_positive_users": people, "target_anime_count": codes.select("anime_id").distinct().count()}
    queries = checkpoint(query_items(edges, settings.recall_min_support, settings.recall_max_queries, settings.seed))
    k = settings.recall_k
    found = checkpoint(recall_at_k(jaccard_neighbours(edges, queries, k), code_neighbours(codes, queries, k), k))
    total = found.agg(F.count("*").alias("n"), F.avg("recall").alias("mean"), F.median("recall").alias("median")).first()
    if not total["n"]:
        return {"status": "skipped", "reason": "no query has neighbours of both kinds", "eligible_queries": queries.count()}
    examples = [r.asDict() for r in recall_examples(found).collect()]
    return {
        "status": "ok", "recall_k": k, "completed_status": settings.completed_status, "score_min": settings.score_min, "min_support": settings.recall_min_support, "eligible_queries": queries.count(),
        "evaluated_queries": total["n"], "mean_recall_at_k": total["mean"], "median_recall_at_k": total["median"],
        "best_examples": [r for r in examples if r["kind"] == "best"], "worst_examples": [r for r in examples if r["kind"] == "worst"],
    }


def tokenise_run(items: DataFrame, codebooks: Sequence[np.ndarray], folder: str, at: str, interactions: DataFrame | None = None, settings: TokeniseSettings = TokeniseSettings(), source: str = "") -> dict:
    """Writes all artefacts of a tokenisation to ``folder``; the run's summary, which is one of them.

    ``items``: (anime_id, name, english_name, genres, embedding), one row an item; faulty
    vectors must have been refused. Tables are folders of part files under the names of
    the files.
    """
    spark = items.sparkSession
    if settings.rebuild:
        reset(spark, folder)
    chosen = items.orderBy("anime_id").limit(settings.limit) if settings.limit > 0 else items
    rows = checkpoint(semantic_ids(chosen, "embedding", codebooks, settings.concat, settings.separator).drop("embedding"))
    levels, size = len(codebooks), len(codebooks[0])
    write_json_lines(rows, f"{folder}/semantic_ids.jsonl")
    lookup = rows.select("anime_id", "name", "english_name", "semantic_id", F.to_json("tokens").alias("level_tokens_json"), F.to_json("codes").alias("codes_json"))
    lookup.write.mode("overwrite").option("header", True).option("sep", "\t").csv(f"{folder}/semantic_lookup.tsv")
    write_json_lines(rows.select("semantic_id", "anime_id", "name", "english_name"), f"{folder}/semantic_id_to_anime.jsonl")
    documents = vocabulary_documents(vocabulary(spark, levels, size, settings.special), token_counts(rows), levels, size, at)
    genres = F.filter(F.transform(F.split(F.coalesce("genres", F.lit("")), ","), lambda g: F.lower(F.trim(g))), lambda g: g != "")
    inspected, clusters = inspect_clusters(rows.withColumn("genres", genres), settings)
    write_json_lines(inspected, f"{folder}/cluster_inspection.jsonl")
    recall = recall_document(interactions, rows.select("anime_id", "codes"), settings)
    summary = {"tokenized_at": at, "row_count": rows.count(), "rq_levels": levels, "codebook_size": size, "checkpoint_path": source, "cluster_summary": clusters, "recall_summary": recall}
    documents |= {"cluster_summary.json": clusters, "recall_report.json": recall, "tokenize_config.json": asdict(settings) | {"out_dir": folder, "checkpoint_path": source}, "tokenize_run_summary.json": summary}
    for name, body in documents.items():
        write_json(spark, body, f"{folder}/{name}")
    return summary


def training_run(interactions: DataFrame, semantic: DataFrame, catalogue: DataFrame, folder: str, at: str, settings: PrepSettings = PrepSettings()) -> dict:
    """Writes a training set, its summary and its manifest; the summary.

    The rows are counted again after they are written; another number than the target
    is an error.
    """
    spark = semantic.sparkSession
    log = checkpoint(interactions)
    made = {task: checkpoint(pool) for task, pool in pools(log, semantic, catalogue, settings).items()}
    rows = checkpoint(training_set(log, semantic, catalogue, settings))
    write_json_lines(rows, f"{folder}/llm_prep_train.jsonl")
    rows.write.mode("overwrite").parquet(f"{folder}/llm_prep_train.parquet")
    require_rows(spark.read.parquet(f"{folder}/llm_prep_train.parquet"), settings.target_examples)
    count = {r["task"]: r["n"] for r in rows.groupBy("task").agg(F.count("*").alias("n")).collect()}
    kinds = {r["kind"]: r["n"] for r in made["C"].groupBy("meta.kind").agg(F.count("*").alias("n")).collect()}
    summary = {
        "generated_at": at, "target_examples": settings.target_examples,
        "counts": {f"task_{t.lower()}": count.get(t, 0) for t in "ABC"},
        "quotas": {f"task_{t.lower()}": n for t, n in quotas(settings.target_examples, settings.share_a, settings.share_b).items()},
        "pool_sizes": {f"task_{t.lower()}_pool": made[t].count() for t in "ABC"},
        "task_a_stats": {r["template_id"]: r["n"] for r in template_counts(made["A"]).collect()},
        "stream_stats": scan_statistics(log, semantic).first().asDict(), "task_c_stats": kinds,
        "semantic_rows": semantic.count(), "anime_meta_rows": catalogue.count(),
    }
    write_json(spark, summary, f"{folder}/prep_summary.json")
    manifest = {"generated_at": at, "output_jsonl": f"{folder}/llm_prep_train.jsonl", "output_parquet": f"{folder}/llm_prep_train.parquet", "summary_json": f"{folder}/prep_summary.json", "config": asdict(settings)}
    write_json(spark, manifest, f"{folder}/prep_manifest.json")
    return summary
