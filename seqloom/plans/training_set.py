"""The training set: three pools, drawn to quotas, shuffled and numbered."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.sampling import numbered, quotas, sample_to_quota
from seqloom.operators.sequences import STATUSES, histories, known_interactions, liked_items, mask_positions, masked_rows, seeds, user_sequences, users_until_full
from seqloom.operators.tasks import fact_rows, item_facts, liked_rows
from seqloom.schemas import EXAMPLE, TABLES
from seqloom.session import checkpoint


@dataclass(frozen=True)
class PrepSettings:
    """Defaults of a full run."""

    target_examples: int = 400_000
    share_a: float = 0.5
    share_b: float = 0.25
    share_c: float = 0.25
    max_templates: int = 12
    min_history: int = 4
    max_history: int = 30
    mask_modes: tuple[str, ...] = ("last", "random")
    liked_from: int = 7
    statuses: tuple[int, ...] = STATUSES
    stop_early: bool = False
    seed: int = 42

    def __post_init__(self) -> None:
        if abs(self.share_a + self.share_b + self.share_c - 1) > 1e-8:
            raise ValueError("shares must add up to 1")
        if self.target_examples < 1 or self.min_history < 2 or self.max_history < self.min_history or self.max_templates < 1:
            raise ValueError("counts out of range")
        if not 1 <= self.liked_from <= 10 or not self.mask_modes or not set(self.mask_modes) <= {"last", "random"}:
            raise ValueError("unknown mask mode or score")


def pools(interactions: DataFrame, semantic: DataFrame, catalogue: DataFrame, settings: PrepSettings = PrepSettings()) -> dict[str, DataFrame]:
    """Rows of tasks A, B and C before any draw."""
    # read by several pools, each of which is counted and drawn from
    facts = checkpoint(item_facts(semantic, catalogue))
    known = checkpoint(known_interactions(interactions, semantic, settings.statuses).select(*TABLES["user_anime"].fieldNames()))
    history = checkpoint(histories(known, settings.min_history, settings.max_history))
    wanted = checkpoint(seeds(liked_items(history, known, settings.liked_from)))
    if settings.stop_early:
        # rows per user follow from the length of the history, so no prompt is made for users past the stop
        want = quotas(settings.target_examples, settings.share_a, settings.share_b)
        none = F.lit(0).cast("bigint")
        made = history.groupBy("user_id").agg(F.max("history_len").alias("n"), F.bool_or("valid").alias("valid"))
        masks = F.size(mask_positions(F.col("user_id"), F.col("n"), settings.mask_modes, settings.seed)).cast("bigint")
        made = made.select("user_id", F.when(F.col("valid"), masks).otherwise(none).alias("masks"), none.alias("seeds"))
        sown = wanted.groupBy("user_id").agg(F.count("*").alias("seeds")).select("user_id", none.alias("masks"), "seeds")
        per_user = made.unionByName(sown).groupBy("user_id").agg(F.sum("masks").alias("masks"), F.sum("seeds").alias("seeds"))
        kept = checkpoint(users_until_full(per_user, 2 * want["B"], 2 * want["C"]))
        history, wanted = history.join(kept, "user_id", "left_semi"), wanted.join(kept, "user_id", "left_semi")
    masks = masked_rows(user_sequences(history, semantic, settings.liked_from), settings.mask_modes, settings.seed)
    return {"A": fact_rows(facts, settings.max_templates), "B": masks, "C": liked_rows(wanted, facts)}


def training_set(interactions: DataFrame, semantic: DataFrame, catalogue: DataFrame, settings: PrepSettings = PrepSettings()) -> DataFrame:
    """Exactly ``target_examples`` numbered rows in shuffled order, alike for any partitioning."""
    want = quotas(settings.target_examples, settings.share_a, settings.share_b)
    out = None
    key = ("task", "input", "output", F.coalesce(F.col("user_id").cast("string"), F.lit("")))
    for task, pool in pools(interactions, semantic, catalogue, settings).items():
        drawn = sample_to_quota(pool, want[task], key, settings.seed)
        out = drawn if out is None else out.unionByName(drawn)
    return numbered(out, key, settings.seed).select(*EXAMPLE.fieldNames())
