"""Per-key results although a few keys hold much of the table.

The rows are first reduced to one row per pair of keys, which spreads by both
keys together, so that no key is ever gathered in one task. Equal splits of the
pairs then encode their keys in a dictionary and scatter-reduce into dense
arrays; the arrays of a block of keys are summed over the splits in two steps.
A key is one slot of an array, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys with the same value but for these bits share a block of the arrays.
BLOCK_BITS = 12
#: Rows that a split takes in before it folds them into its arrays.
CHUNK_ROWS = 500_000
#: Splits are first summed in so many groups a block, then the groups are.
FAN_IN = 32

_BLOCK = "key_field string, block long, split int, slots array<int>, n array<long>, d array<long>, v array<double>, c array<long>"


def _pairs(df: DataFrame, first: str, second: str, measure: Column | None) -> DataFrame:
    """One row per pair of keys: rows, and sum and count of the measure."""
    measure = F.lit(None).cast("double") if measure is None else measure
    return (
        df.select(F.col(first).cast("long").alias("a"), F.col(second).cast("long").alias("b"), measure.cast("double").alias("m"))
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.sum("m").alias("v"), F.count("m").alias("c"))
    )


class _Arrays:
    """Dense accumulators over a dictionary of the keys seen so far."""

    def __init__(self) -> None:
        self.keys = np.empty(0, np.int64)
        self.sums = np.empty((4, 0))

    def add(self, keys: np.ndarray, weights: list[np.ndarray]) -> None:
        seen, codes = np.unique(keys, return_inverse=True)
        fresh = np.stack([np.bincount(codes, w, len(seen)) for w in weights])
        every = np.union1d(self.keys, seen)
        total = np.zeros((4, len(every)))
        total[:, np.searchsorted(every, self.keys)] += self.sums
        total[:, np.searchsorted(every, seen)] += fresh
        self.keys, self.sums = every, total

    def blocks(self) -> Iterator[tuple]:
        """(block, slots, n, d, v, c) with the keys of one block each."""
        block = self.keys >> BLOCK_BITS
        cuts = np.flatnonzero(np.diff(block)) + 1
        for at, s in zip(np.split(np.arange(len(self.keys)), cuts), np.split(self.sums, cuts, axis=1), strict=True):
            if len(at):
                yield int(block[at[0]]), (self.keys[at] & ((1 << BLOCK_BITS) - 1)), *s


def _reduce_split(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()
        held: dict[str, _Arrays] = {first: _Arrays(), second: _Arrays()}
        waiting: list[pa.RecordBatch] = []

        def fold() -> None:
            t = pa.Table.from_batches(waiting)
            waiting.clear()
            a, b = t["a"].combine_chunks(), t["b"].combine_chunks()
            n, c = t["n"].to_numpy(), t["c"].to_numpy()
            v = t["v"].fill_null(0.0).to_numpy()
            for name, own, other in ((first, a, b), (second, b, a)):
                there = np.asarray(own.is_valid())
                keys = own.fill_null(0).to_numpy(zero_copy_only=False)[there]
                met = np.asarray(other.is_valid())[there].astype(np.float64)
                if len(keys):
                    held[name].add(keys, [n[there], met, v[there], c[there]])

        for batch in batches:
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) >= CHUNK_ROWS:
                fold()
        if waiting:
            fold()
        rows = [(name, block, split, slots.astype(np.int32), n.astype(np.int64), d.astype(np.int64), v, c.astype(np.int64)) for name, x in held.items() for block, slots, n, d, v, c in x.blocks()]
        if rows:
            names = ["key_field", "block", "split", "slots", "n", "d", "v", "c"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _sum_blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum of the arrays that several splits have for one block."""
    width = 1 << BLOCK_BITS
    slots = np.concatenate(pdf["slots"].to_list())
    total = [np.bincount(slots, np.concatenate(pdf[x].to_list()), width) for x in ("n", "d", "v", "c")]
    there = np.flatnonzero(total[0])
    return pd.DataFrame([[key[0], key[1], key[2], there.astype(np.int32), *(t[there].astype(np.float64 if i == 2 else np.int64) for i, t in enumerate(total))]], columns=["key_field", "block", "split", "slots", "n", "d", "v", "c"])


def key_stats(df: DataFrame, first: str, second: str, measure: Column | None = None) -> DataFrame:
    """Rows (key_field, key_value, n_rows, n_counterparts, mean_value).

    For each non-null value of ``first`` and of ``second``: the rows that hold it,
    the distinct non-null values of the other column beside it, and the mean of
    the non-null ``measure`` (null if there is none). Rows in which both are null
    give nothing. Repeated rows count as often as they are stored. An empty table
    gives no rows. Other columns are not read. Sums are exact up to 2**53.
    """
    blocks = _pairs(df, first, second, measure).mapInArrow(_reduce_split(first, second), _BLOCK)
    some = blocks.withColumn("split", F.col("split") % FAN_IN).groupBy("key_field", "block", "split").applyInPandas(_sum_blocks, _BLOCK)
    whole = some.withColumn("split", F.lit(0)).groupBy("key_field", "block", "split").applyInPandas(_sum_blocks, _BLOCK)
    return (
        whole.select("key_field", "block", F.explode(F.arrays_zip("slots", "n", "d", "v", "c")).alias("x"))
        .select(
            "key_field",
            (F.shiftleft("block", BLOCK_BITS) + F.col("x.slots")).alias("key_value"),
            F.col("x.n").alias("n_rows"),
            F.col("x.d").alias("n_counterparts"),
            F.when(F.col("x.c") > 0, F.col("x.v") / F.col("x.c")).alias("mean_value"),
        )
    )


def heavy_keys(stats: DataFrame, total_rows: int, share: float) -> DataFrame:
    """The keys of :func:`key_stats` that hold at least ``share`` of all rows."""
    return stats.where(F.col("n_rows") >= F.lit(share) * F.lit(total_rows)).where(F.lit(total_rows) > 0)
