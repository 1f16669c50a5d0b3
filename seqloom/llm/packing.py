"""Filling containers of fixed capacity with items of varying length.

A container has limits on tokens, on the number of segments and on the tokens
that bear loss. Items go into the open container by the dot product of their
size vector and the room that is left, each limit scaled by its capacity and
weighted by how scarce it is (the demand of all items still waiting): the largest
product that still fits is taken, and a new container is opened when nothing fits.
Once segments grow scarce, room is kept for as many small items as each container must
take, so that they do not remain for containers of their own. Items are spread over shards by a hash, so every shard sees the
same mix of sizes and at most its last containers are less full.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.session import checkpoint

#: Items that one task packs.
SHARD_ITEMS = 20_000
#: Part of the allowed segments, taken by all containers on average, from which they are kept for small items.
SCARCE = 0.75


@dataclass(frozen=True)
class PackLimits:
    """Limits of one kind of container; no limit on loss-bearing tokens by default."""

    name: str
    capacity: int
    max_segments: int = 2**31 - 1
    max_loss: int | None = None

    def __post_init__(self) -> None:
        if self.capacity < 1 or self.max_segments < 1 or (self.max_loss is not None and self.max_loss < 1):
            raise ValueError("limits must be positive")

    @property
    def loss(self) -> int:
        return self.capacity if self.max_loss is None else self.max_loss


def pack_vectors(tokens: np.ndarray, loss: np.ndarray, limits: PackLimits) -> np.ndarray:
    """Container of each item, numbered from 0; every item must fit an empty one."""
    kinds, kind_of = np.unique(np.stack([tokens, loss], 1), axis=0, return_inverse=True)  # ascending by tokens
    kind_of = kind_of.ravel()
    waiting = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(np.bincount(kind_of, minlength=len(kinds)))[:-1])
    left = np.array([len(w) for w in waiting])
    most = np.array([limits.capacity, min(limits.max_segments, max(1, len(tokens))), limits.loss], float)
    sizes = np.stack([kinds[:, 0], np.ones(len(kinds)), kinds[:, 1]], 1) / most  # parts of a container
    bins = np.empty(len(tokens), np.int64)
    demand = left @ sizes  # containers that each limit alone would need
    number, placed = 0, 0
    while placed < len(tokens):
        live = np.flatnonzero(left)
        weight = demand / demand.max()
        # where segments grow scarce: what each container must take of them, and what the smallest items need for that
        share = min(most[1], np.ceil((len(tokens) - placed) / np.ceil(demand.max() - 1e-9)))
        share = share if share >= SCARCE * limits.max_segments else 0
        counts = np.cumsum(left[live])
        small = np.cumsum(sizes[live] * left[live, None], axis=0)
        room, fits, taken = np.ones(3), live, 0
        while True:
            fits = fits[(sizes[fits] <= room + 1e-12).all(1) & (left[fits] > 0)]
            if not len(fits):
                break
            chosen = fits
            if (ahead := share - taken - 1) > 0:
                k = min(np.searchsorted(counts, ahead), len(live) - 1)
                kept = small[k] - sizes[live[k]] * max(0, counts[k] - ahead)
                close = fits[(sizes[fits] + kept <= room + 1e-12).all(1)]
                chosen = close if len(close) else fits[:1]
            best = chosen[np.argmax(sizes[chosen] @ (room * weight))]
            bins[waiting[best][left[best] - 1]] = number
            left[best] -= 1
            placed += 1
            taken += 1
            room = room - sizes[best]
            demand = demand - sizes[best]
        number += 1
    return bins


def cut_items(sizes: DataFrame, key: str, limits: PackLimits) -> DataFrame:
    """(key, piece, start_token, n_tokens, loss_tokens): items longer than a container in pieces.

    ``sizes``: (key, n_tokens, loss_tokens); the last tokens of an item bear loss. Pieces
    also keep the limit on loss.
    """
    most = min(limits.capacity, limits.loss)
    whole = (F.col("n_tokens") <= limits.capacity) & (F.col("loss_tokens") <= limits.loss)
    pieces = F.when(whole, F.lit(1)).otherwise(F.ceil(F.col("n_tokens") / most)).cast("long")
    cut = sizes.select(key, "n_tokens", "loss_tokens", whole.alias("whole"), F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
    start = F.col("piece") * most
    part = F.when(F.col("whole"), F.col("n_tokens")).otherwise(F.least(F.lit(most), F.col("n_tokens") - start))
    bears = F.greatest(F.lit(0), start + part - F.greatest(start, F.col("n_tokens") - F.col("loss_tokens")))
    return cut.select(key, "piece", start.alias("start_token"), part.alias("n_tokens"), bears.cast("long").alias("loss_tokens"))


def pack_items(sizes: DataFrame, key: str, kinds: Sequence[PackLimits], loss: str | None = None, seed: int = 42) -> DataFrame:
    """(pack_name, container_id, slot, key, piece, start_token, n_tokens, loss_tokens, unused_tokens).

    ``sizes``: (key, n_tokens) and the column ``loss``, how many of the last tokens bear
    loss; without it all but the first do, null is none. Each item is whole unless it is longer than the
    container (or bears more loss than it may). Items without tokens, or with null
    sizes, need no room: they are listed with a null container. Repeated rows are
    packed as often as they stand; a null key stays null. Same input, same result.
    """
    bears = F.col("n_tokens") - 1 if loss is None else F.least(F.greatest(F.coalesce(loss, F.lit(0)), F.lit(0)), "n_tokens")
    sizes = checkpoint(sizes.select(key, "n_tokens", bears.cast("long").alias("loss_tokens")))  # else every kind counts the tokens again
    items = None
    for limits in kinds:
        cut = cut_items(sizes.where("n_tokens > 0"), key, limits).withColumn("pack_name", F.lit(limits.name))
        items = cut if items is None else items.unionByName(cut)
    if items is None:
        raise ValueError("no kind of container")
    by_name = {x.name: x for x in kinds}
    total = sizes.agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).first()
    shards = {x.name: max(1, round(((total["n"] or 0) + (total["t"] or 0) / x.capacity) / SHARD_ITEMS)) for x in kinds}
    of = F.lit(1)
    for name, n in shards.items():
        of = F.when(F.col("pack_name") == name, n).otherwise(of)
    placed = items.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), key, "piece", "n_tokens"), of.cast("long")))
    kind = sizes.schema[key].dataType.simpleString()

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "piece"], kind="stable", ignore_index=True)
        limits = by_name[pdf["pack_name"].iloc[0]]
        bins = pack_vectors(pdf["n_tokens"].to_numpy(), pdf["loss_tokens"].to_numpy(), limits)
        used = np.bincount(bins, pdf["n_tokens"].to_numpy()).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        first = np.r_[0, np.flatnonzero(np.diff(bins[order])) + 1]
        slot = np.empty(len(bins), np.int64)
        slot[order] = np.arange(len(bins)) - np.repeat(first, np.diff(np.r_[first, len(bins)]))
        pdf["container_id"] = pdf["shard"] * 2**32 + bins
        pdf["slot"] = slot
        pdf["unused_tokens"] = limits.capacity - used[bins]
        return pdf[["pack_name", "container_id", "slot", key, "piece", "start_token", "n_tokens", "loss_tokens", "unused_tokens"]]

    schema = f"pack_name string, container_id long, slot long, `{key}` {kind}, piece long, start_token long, n_tokens long, loss_tokens long, unused_tokens long"
    packed = placed.groupBy("pack_name", "shard").applyInPandas(fill, schema)
    names = F.explode(F.array(*[F.lit(x.name) for x in kinds])).alias("pack_name")
    empty = sizes.where("n_tokens is null or n_tokens <= 0").select(
        names, F.lit(None).cast("long").alias("container_id"), F.lit(None).cast("long").alias("slot"), key, F.lit(0).cast("long").alias("piece"),
        F.lit(0).cast("long").alias("start_token"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("loss_tokens"), F.lit(None).cast("long").alias("unused_tokens"),
    )
    return packed.unionByName(empty)
