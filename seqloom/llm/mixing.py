"""Mixing sources to target weights.

Every source gets a budget of tokens. Documents are counted by exact length; a
source is used whole as often as its budget allows, and the rest of the budget
is fitted by lengths: the same share of every length, what cannot be taken of one
being carried to the next from a seeded start, so that documents of all lengths are
as likely; then a bounded knapsack, over lengths in a seeded order, for the small
part of the budget that is kept back for it. The documents themselves are drawn by a
seeded hash within their length, so only counts by length ever reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import checkpoint

#: Tokens that are kept back for the exact fit, at most; else a fiftieth of the budget, or two of the longest documents.
FIT_TOKENS = 65_536


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, fit: int = FIT_TOKENS, seed: int = 42) -> np.ndarray:
    """How many of each length to take so that their sum comes nearest to ``budget`` from below.

    Short lengths come first, so that what is carried never makes the sum exceed the
    budget; what is left for the knapsack is at most ``fit`` tokens and the longest
    document's.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    whole = int(lengths @ counts)
    if budget >= whole:
        return counts.copy()
    rng = np.random.default_rng([seed, len(lengths), whole % 2**31])
    start, order = rng.random(), rng.permutation(len(lengths))
    kept = min(fit, max(budget // 50, 2 * int(lengths.max(initial=0))))
    while True:
        take = _shares(lengths, counts, budget, max(0, budget - kept) / whole, start)
        take = _fill(lengths, counts, take, budget - int(lengths @ take), order)
        if int(lengths @ take) == budget or kept >= min(fit, budget):
            return take
        kept = min(fit, 4 * kept)  # with more at hand the sum comes nearer


def _shares(lengths: np.ndarray, counts: np.ndarray, budget: int, share: float, start: float) -> np.ndarray:
    """The share of every length in whole documents, short lengths first."""
    take, left, carried = np.zeros_like(counts), max(0, budget), None
    for i in np.argsort(lengths, kind="stable"):
        if not lengths[i]:
            continue
        carried = (start * int(lengths[i]) if share else 0.0) if carried is None else carried
        carried += share * int(lengths[i] * counts[i])
        take[i] = min(int(counts[i]), int(carried // lengths[i]), left // int(lengths[i]))
        carried -= int(take[i] * lengths[i])
        left -= int(take[i] * lengths[i])
    return take


def _fill(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, left: int, order: np.ndarray) -> np.ndarray:
    """``take`` with the subset of what remains whose sum comes nearest to ``left`` from below.

    Subset sums are bits of one integer; the sums before each length lead back.
    """
    if left <= 0:
        return take
    take, mask = take.copy(), (1 << (left + 1)) - 1
    reach, before = 1, []
    order = [int(i) for i in order if 0 < lengths[i] <= left and counts[i] > take[i]]
    for i in order:
        before.append(reach)
        spare, unit = min(int(counts[i] - take[i]), left // int(lengths[i])), 1
        while spare > 0:
            step = min(unit, spare)
            reach |= (reach << (step * int(lengths[i]))) & mask
            spare -= step
            unit *= 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, earlier in zip(reversed(order[: len(before)]), reversed(before), strict=True):
        used = 0
        while not earlier >> at & 1:
            at -= int(lengths[i])
            used += 1
        take[i] += used
    return take


def mix_sources(sizes: DataFrame, targets: DataFrame, key: str, total_tokens: int | None = None, seed: int = 42) -> DataFrame:
    """(key, source, n_tokens, repeats): the chosen documents and how often each is used.

    ``sizes``: (key, source, n_tokens); ``targets``: (source, target_share, max_repeats),
    one row a source. The budget of a source is its share of ``total_tokens``, by
    default all tokens of the targeted sources. No document is used more than
    max_repeats times; a source that cannot fill its budget is used as far as that
    allows and stays short, a source without documents stays empty. Documents
    without tokens and of other sources (null ones too) are not chosen. Equal keys
    are drawn separately.
    """
    wanted = {r["source"]: (max(0.0, r["target_share"] or 0.0), max(0, r["max_repeats"] or 0)) for r in targets.collect() if r["source"] is not None}
    spark = sizes.sparkSession
    known = sizes.where(F.col("source").isin(list(wanted)) & (F.col("n_tokens") > 0)).select(key, "source", "n_tokens")
    known = checkpoint(known.withColumn("h", F.xxhash64(F.lit(seed), key, "n_tokens")).withColumn("part", F.shiftright("h", 56)))
    counted = known.groupBy("source", "n_tokens").agg(F.count("*").alias("c")).collect()
    available = {s: sum(r["n_tokens"] * r["c"] for r in counted if r["source"] == s) for s in wanted}
    total = sum(available.values()) if total_tokens is None else total_tokens
    weight = sum(share for share, _ in wanted.values()) or 1.0
    plan: list[tuple[str, int, int, int]] = []
    for source, (share, most) in wanted.items():
        own = sorted((r["n_tokens"], r["c"]) for r in counted if r["source"] == source)
        if not own or not most:
            continue
        lengths, counts = np.array([x for x, _ in own]), np.array([c for _, c in own])
        budget = int(round(total * share / weight))
        full = min(most, budget // available[source])
        more = fit_lengths(lengths, counts, budget - full * available[source], seed=seed) if full < most else np.zeros_like(counts)
        plan += [(source, int(n), int(full), int(m)) for n, m in zip(lengths, more, strict=True)]
    chosen = spark.createDataFrame(plan, "source string, n_tokens long, full int, more long")
    # draw ``more`` documents of each length: whole parts of the hash, then ranks within one part
    parts = known.groupBy("source", "n_tokens", "part").agg(F.count("*").alias("c"))
    earlier = F.sum("c").over(Window.partitionBy("source", "n_tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(chosen, ["source", "n_tokens"])
    state = F.when(F.col("earlier") + F.col("c") <= F.col("more"), "in").when(F.col("earlier") >= F.col("more"), "out").otherwise("cut")
    parts = checkpoint(parts.select("source", "n_tokens", "part", "full", (F.col("more") - F.col("earlier")).alias("room"), state.alias("state")))
    placed = known.join(parts, ["source", "n_tokens", "part"])
    sure = placed.where("state != 'cut'").select(key, "source", "n_tokens", (F.col("full") + (F.col("state") == "in").cast("int")).alias("repeats"))
    rank = F.row_number().over(Window.partitionBy("source", "n_tokens", "part").orderBy("h", key))
    cut = placed.where("state = 'cut'").withColumn("rank", rank).select(key, "source", "n_tokens", (F.col("full") + (F.col("rank") <= F.col("room")).cast("int")).alias("repeats"))
    return sure.unionByName(cut).where("repeats > 0")


def mix_report(mix: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: wanted and actual share, tokens at hand and used, most repeats, and whether it fell short.

    ``target_tokens`` is the source's budget, ``met`` whether it was filled to within a
    thousandth. What unmet sources lack makes the actual shares of all others larger,
    by one common factor.
    """
    used = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("used"), F.sum("repeats").alias("uses"), F.max("repeats").alias("most_used"))
    there = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    whole = F.sum("used").over(Window.partitionBy())  # one row a source
    report = targets.select("source", "target_share", "max_repeats").join(there, "source", "left").join(used, "source", "left")
    report = report.withColumn("whole", whole).withColumn("all_tokens", F.sum("available_tokens").over(Window.partitionBy()))
    budget = F.round(F.coalesce("all_tokens", F.lit(0)) * F.col("target_share") / F.sum("target_share").over(Window.partitionBy())).cast("long")
    report = report.withColumn("target_tokens", budget)
    share = F.coalesce(F.col("used") / F.col("whole"), F.lit(0.0))
    return report.select(
        "source", "target_share", F.round(share, 6).alias("actual_share"), F.coalesce("available_tokens", F.lit(0)).alias("available_tokens"),
        "target_tokens", F.coalesce("used", F.lit(0)).alias("used_tokens"), F.coalesce("uses", F.lit(0)).alias("uses"), "max_repeats",
        F.coalesce("most_used", F.lit(0)).alias("most_used"), (F.coalesce("used", F.lit(0)) >= 0.999 * F.col("target_tokens")).alias("met"),
    )
