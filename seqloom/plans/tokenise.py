"""From vectors to semantic ids, and their evaluation against shared users."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.vectors import level_tokens, quantise, semantic_id
from seqloom.operators.neighbours import code_neighbours, item_support, jaccard_neighbours, positive_edges, query_items, recall_at_k, recall_report


def semantic_ids(items: DataFrame, vector: str, codebooks: Sequence[np.ndarray], concat: bool = True, separator: str = "") -> DataFrame:
    """Items with codes, tokens and semantic id; their other columns are kept."""
    coded = items.withColumn("codes", quantise(F.col(vector), list(codebooks)))
    tokens = level_tokens(F.col("codes"))
    kept = [c for c in items.columns if c != vector]
    return coded.select(*kept, semantic_id(tokens, concat, separator).alias("semantic_id"), tokens.alias("tokens"), "codes")


def evaluate_recall(interactions: DataFrame, codes: DataFrame, k: int = 20, min_support: int = 10, most: int = 500, status: int = 2, min_score: int = 7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(recall per query, one-row report): do the nearest codes agree with shared users?"""
    edges = positive_edges(interactions, codes, status, min_score)
    queries = query_items(edges, min_support, most, seed)
    recall = recall_at_k(jaccard_neighbours(edges, queries, k), code_neighbours(codes, queries, k), k)
    return recall, recall_report(recall, k, min_support)


def eligible_items(interactions: DataFrame, items: DataFrame, min_support: int = 10) -> DataFrame:
    """Items with enough users who finished them and scored them high."""
    return item_support(positive_edges(interactions, items)).where(F.col("support") >= min_support)
