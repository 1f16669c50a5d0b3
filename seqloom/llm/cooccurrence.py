"""Items that appear together, and how surprising that is.

Counting. Baskets hold distinct items. A pair can only pass if both items are
frequent enough and their frequencies are near enough for the least Jaccard, so
other pairs are never formed. Baskets up to ``hot_basket`` items are counted in
Arrow batches, each added up before anything is shuffled. Larger baskets do not pair
all their items. With baskets in order of size, two items that meet the limits share
one among those that are left when each drops its o-1 largest, o being the least
count or Jaccard times its own, whichever is more; so most items pair in no large
basket. Those that do meet by blocks of the basket, never the basket at a time. The
share of large baskets in the count of a pair is the overlap of the items' lists of
them, kept in pieces of bounded length. All of this is exact.

Chance. The null is the bipartite configuration model: every basket keeps its
size and every item its frequency on average, an item being in a basket with
probability xy/(1+xy). Sizes and frequencies are few numbers, so the fit runs
over their histograms. Under it a pair's count is Poisson-binomial; its upper
tail is taken by the saddlepoint formula and corrected by Benjamini-Hochberg
over all pairs of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import checkpoint

_PAIR = "item_a long, item_b long, n long"


@dataclass(frozen=True)
class PairLimits:
    """Least count, lift and Jaccard of a pair, and from how many items on a basket is large.

    ``block``: items of a large basket that are paired at a time; ``piece``: baskets in a
    piece of an item's list of large ones.
    """

    min_count: int = 10
    min_lift: float = 2.0
    min_jaccard: float = 0.25
    hot_basket: int = 2048
    block: int = 2048
    piece: int = 4096


def latest_score_baskets(log: DataFrame, when: Column, low: int, high: int) -> DataFrame:
    """Distinct (basket, item) of the rows that count.

    For each user_id > 0 and non-null anime_id only the row with the latest ``when``
    (microseconds; null is earliest) counts, of equal ones that with the highest
    score in range; it counts if its score is in low..high. Instant and score are
    packed in one long so that the reduction is a plain maximum.
    """
    code = F.when(F.col("score").between(low, high), F.col("score") - low + 1).otherwise(0)
    packed = F.coalesce(when, F.lit(-(2**53))) * 64 + code
    if not 0 <= high - low < 63:
        raise ValueError("at most 63 scores")
    return (
        log.where("user_id > 0 and anime_id is not null")
        .select(F.col("user_id").cast("long").alias("basket"), F.col("anime_id").cast("long").alias("item"), packed.alias("p"))
        .groupBy("basket", "item")
        .agg(F.max("p").alias("p"))
        .where(F.pmod("p", F.lit(64)) > 0)
        .select("basket", "item")
    )


def _pairs_of(items: np.ndarray, counts: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each row of two matrices (baskets of one size), items ascending by count."""
    i, j = np.triu_indices(items.shape[1], 1)
    out_a, out_b = [], []
    step = max(1, 2_000_000 // max(1, len(i)))
    for k in range(0, len(items), step):
        near = counts[k : k + step, j] * ratio <= counts[k : k + step, i]
        out_a.append(items[k : k + step, i][near])
        out_b.append(items[k : k + step, j][near])
    return np.concatenate(out_a), np.concatenate(out_b)


def _count_small(ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def fold() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            a, b = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, np.int64)
            n = np.diff(np.r_[new, len(a)])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(n.astype(np.int64))], names=["item_a", "item_b", "n"])

        for batch in batches:
            lists = batch["members"].combine_chunks() if isinstance(batch["members"], pa.ChunkedArray) else batch["members"]
            offsets = lists.offsets.to_numpy()
            flat = lists.values
            count, item = flat.field("n").to_numpy(), flat.field("item").to_numpy()
            length = np.diff(offsets)
            for d in np.unique(length[length > 1]):
                at = offsets[:-1][length == d][:, None] + np.arange(d)
                held.append(_pairs_of(item[at], count[at], ratio))
                size += len(held[-1][0])
                if size > 4_000_000:
                    yield fold()
                    size = 0
        if held:
            yield fold()

    return run


def count_pairs(baskets: DataFrame, limits: PairLimits) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(pairs, item counts, basket sizes, number of baskets) of distinct (basket, item).

    ``pairs`` has (item_a, item_b, n_a, n_b, n_ab) for exactly those pairs that meet
    the limits, item_a < item_b.
    """
    baskets = checkpoint(baskets)
    items = baskets.groupBy("item").agg(F.count("*").alias("n"))
    sizes = baskets.groupBy("basket").agg(F.count("*").alias("size"))
    total = sizes.count()
    # lift = n_ab N / (n_a n_b) is at most N / max(n_a, n_b)
    usable = items.where((F.col("n") >= limits.min_count) & (F.col("n") * limits.min_lift <= total))
    member = baskets.join(usable, "item").join(sizes, "basket")
    ratio = float(limits.min_jaccard)
    small = (
        member.where(F.col("size") <= limits.hot_basket)
        .groupBy("basket")
        .agg(F.array_sort(F.collect_list(F.struct("n", "item"))).alias("members"))
        .where(F.size("members") > 1)
        .select("members")
        .mapInArrow(_count_small(ratio), _PAIR)
        .groupBy("item_a", "item_b")
        .agg(F.sum("n").alias("n_small"))
    )
    hot = member.where(F.col("size") > limits.hot_basket)
    if hot.isEmpty():
        counted = small.withColumnRenamed("n_small", "n_ab").where(F.col("n_ab") >= limits.min_count)
    else:
        counted = _with_hot(small, hot, limits)
    n_a, n_b = usable.select(F.col("item").alias("item_a"), F.col("n").alias("n_a")), usable.select(F.col("item").alias("item_b"), F.col("n").alias("n_b"))
    pairs = counted.join(n_a, "item_a").join(n_b, "item_b").select("item_a", "item_b", "n_a", "n_b", "n_ab")
    pairs = pairs.where(
        (F.col("n_ab") >= limits.min_count)
        & (F.col("n_ab") * F.lit(float(total)) >= limits.min_lift * F.col("n_a").cast("double") * F.col("n_b"))
        & (F.col("n_ab") >= limits.min_jaccard * (F.col("n_a") + F.col("n_b") - F.col("n_ab")))
    )
    return pairs, items, sizes, total


def _pair_blocks(ratio: float):
    """Pairs within one block of a large basket, or between two, whose counts allow the Jaccard."""

    def run(group: pa.Table) -> pa.Table:
        item, n, part = (group[c].to_numpy() for c in ("item", "n", "part"))
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for s in range(0, len(left), 256):
            own = left[s : s + 256]
            low, high = np.minimum(n[own][:, None], n[right]), np.maximum(n[own][:, None], n[right])
            x, y = np.nonzero((high * ratio <= low) & ((item[own][:, None] < item[right]) if i == j else True))
            found.append((item[own][x], item[right][y]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table({"item_a": np.minimum(a, b), "item_b": np.maximum(a, b)})

    return run


def _with_hot(small: DataFrame, hot: DataFrame, limits: PairLimits) -> DataFrame:
    """Counts of the small baskets, completed by those of the large ones (basket, item, n, size)."""
    hot = checkpoint(hot)
    # an item's o-1 largest baskets need not be looked at
    least = F.greatest(F.lit(limits.min_count), F.ceil(F.col("n") * F.lit(limits.min_jaccard) - 1e-9)).cast("long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("size"), F.desc("basket")))
    prefix = checkpoint(hot.withColumn("place", place).where(F.col("place") >= least).select("basket", "item", "n"))
    blocks = prefix.groupBy("basket").agg(F.ceil(F.count("*") / F.lit(limits.block)).cast("int").alias("blocks"))
    parted = prefix.join(blocks, "basket").withColumn("part", F.pmod(F.xxhash64("item"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    meeting = parted.withColumn("q", other).select("basket", F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"), "part", "item", "n")
    only = meeting.groupBy("basket", "i", "j").applyInArrow(_pair_blocks(float(limits.min_jaccard)), "item_a long, item_b long").distinct()
    every = small.join(only, ["item_a", "item_b"], "full").withColumn("n_small", F.coalesce("n_small", F.lit(0)))
    held = hot.groupBy("item").agg(F.count("*").alias("held"))
    a, b = held.select(F.col("item").alias("item_a"), F.col("held").alias("held_a")), held.select(F.col("item").alias("item_b"), F.col("held").alias("held_b"))
    every = every.join(a, "item_a", "left").join(b, "item_b", "left")
    most = F.least(F.coalesce("held_a", F.lit(0)), F.coalesce("held_b", F.lit(0)))
    every = checkpoint(every.withColumn("most", most).where(F.col("n_small") + F.col("most") >= limits.min_count).select("item_a", "item_b", "n_small", "most"))
    # lists in pieces by basket, so that none grows with the table
    pieces = max(1, math.ceil(hot.select("basket").distinct().count() / limits.piece))
    lists = checkpoint(hot.groupBy("item", F.pmod(F.xxhash64("basket"), F.lit(pieces)).cast("int").alias("piece")).agg(F.collect_list("basket").alias("h")))
    a, b = lists.select(F.col("item").alias("item_a"), "piece", F.col("h").alias("h_a")), lists.select(F.col("item").alias("item_b"), "piece", F.col("h").alias("h_b"))
    shared = every.where("most > 0").join(a, "item_a").join(b, ["item_b", "piece"])
    shared = shared.select("item_a", "item_b", F.size(F.array_intersect("h_a", "h_b")).alias("n_large")).groupBy("item_a", "item_b").agg(F.sum("n_large").alias("n_large"))
    counted = every.join(shared, ["item_a", "item_b"], "left")
    return counted.select("item_a", "item_b", (F.col("n_small") + F.coalesce("n_large", F.lit(0))).alias("n_ab"))


@dataclass(frozen=True)
class ConfigurationNull:
    """Fitted model: factor and number of the baskets of each size, factor of each item frequency."""

    basket_x: np.ndarray
    basket_m: np.ndarray
    item_n: np.ndarray
    item_y: np.ndarray

    def chances(self, n: np.ndarray) -> np.ndarray:
        """Probability of items of frequency n in a basket of each class."""
        y = np.exp(np.interp(np.log(np.maximum(n, 1)), np.log(self.item_n), np.log(self.item_y)))
        t = y[:, None] * self.basket_x[None, :]
        return t / (1 + t)


def _classes(values: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(mean value, count) by value up to 256, beyond that by steps of 2 %: at most some 1,500 classes."""
    step = F.when(F.col(column) <= 256, F.col(column)).otherwise(256 + F.floor(F.log(F.col(column) / 256.0) / math.log(1.02)))
    rows = values.groupBy(step.alias("k")).agg(F.avg(column).alias("v"), F.count("*").alias("m")).orderBy("k").collect()
    return np.array([r["v"] for r in rows], float), np.array([r["m"] for r in rows], float)


def fit_null(items: DataFrame, sizes: DataFrame, rounds: int = 400, tolerance: float = 1e-8) -> ConfigurationNull:
    """Factors whose expected basket sizes and item frequencies are the observed ones."""
    d, m = _classes(sizes, "size")
    n, w = _classes(items, "n")
    total = max(1.0, float(d @ m))
    x, y = d / math.sqrt(total), n / math.sqrt(total)
    for _ in range(rounds):
        x_new = d / np.maximum((w * y / (1 + x[:, None] * y)).sum(1), 1e-300)
        y_new = n / np.maximum((m * x_new / (1 + y[:, None] * x_new)).sum(1), 1e-300)
        change = max(np.abs(x_new / x - 1).max(initial=0), np.abs(y_new / y - 1).max(initial=0))
        x, y = x_new, y_new
        if change < tolerance:
            break
    return ConfigurationNull(x, m, n, y)


def log_upper_tail(q: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log10 P(X >= n) for Poisson-binomial X of m[k] trials of chance q[:, k] each.

    Lugannani-Rice with continuity correction; exact to a few percent deep in the
    tail. 0 where n is not above the mean, -inf where n exceeds the trials.
    """
    mean = q @ m
    out = np.zeros(len(n))
    trials = m.sum()
    up = (n > mean + 1e-9) & (n <= trials)
    out[n > trials] = -np.inf
    if not up.any():
        return out
    q, k = q[up], n[up].astype(float)
    at = np.minimum(k, trials - 1e-6)
    lo, hi = np.zeros(len(k)), np.full(len(k), 1.0)

    def tilted(s: np.ndarray) -> np.ndarray:
        e = q * np.exp(np.minimum(s, 700))[:, None]
        return e / (1 - q + e)

    while (low := tilted(hi) @ m < at).any() and hi.max() < 600:
        hi = np.where(low, hi * 2, hi)
    for _ in range(60):
        s = (lo + hi) / 2
        below = tilted(s) @ m < at
        lo, hi = np.where(below, s, lo), np.where(below, hi, s)
    s = np.maximum((lo + hi) / 2, 1e-9)
    p = tilted(s)
    big_k = np.log1p(q * np.expm1(np.minimum(s, 700))[:, None]) @ m
    w = np.sqrt(np.maximum(2 * (s * at - big_k), 1e-18))
    u = (1 - np.exp(-s)) * np.sqrt(np.maximum((p * (1 - p)) @ m, 1e-18))
    # log of phi(w) (1/u - 1/w) + Q(w), with Q by its continued fraction beyond w = 5
    log_phi = -w * w / 2 - 0.5 * math.log(2 * math.pi)
    mills = np.where(w > 5, 1 / (w + 1 / (w + 2 / (w + 3 / (w + 4 / (w + 5 / np.maximum(w, 1)))))), 0.0)
    near = np.array([0.5 * math.erfc(min(x, 37.0) / math.sqrt(2)) for x in w]) / np.maximum(np.exp(log_phi), 1e-300)
    term = np.where(w > 5, mills, near) + 1 / u - 1 / w
    out[up] = np.minimum((log_phi + np.log(np.maximum(term, 1e-12))) / math.log(10), 0.0)
    return out


def pair_surprise(baskets: DataFrame, limits: PairLimits = PairLimits()) -> DataFrame:
    """Pairs with their counts, lift, expected count, log10 tail and log10 q-value.

    Columns item_a < item_b, n_ab, n_a, n_b, n_baskets, lift, jaccard, expected,
    log10_p, log10_q. q-values count every pair of items as a test and rank only the
    pairs that meet the limits, which errs on the safe side; p-values enter the rank
    rounded up to the next hundredth of a power of ten. Repeated (basket, item) must
    have been removed. An empty table gives no rows.
    """
    pairs, items, sizes, total = count_pairs(baskets, limits)
    null = fit_null(items, sizes)
    tests = max(1.0, (k := items.count()) * (k - 1) / 2)

    @F.pandas_udf("struct<expected: double, log10_p: double>")
    def chance(n_a: pd.Series, n_b: pd.Series, n_ab: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(n_ab), 2))
        for i in range(0, len(n_ab), 1000):
            c = slice(i, i + 1000)
            q = null.chances(n_a.to_numpy(float)[c]) * null.chances(n_b.to_numpy(float)[c])
            out[c, 0] = q @ null.basket_m
            out[c, 1] = log_upper_tail(q, null.basket_m, n_ab.to_numpy(float)[c])
        return pd.DataFrame({"expected": out[:, 0], "log10_p": out[:, 1]})

    scored = checkpoint(pairs.withColumn("c", chance("n_a", "n_b", "n_ab")).select("*", "c.*").drop("c"))
    grade = F.ceil(F.greatest(F.col("log10_p"), F.lit(-400.0)) * 100).cast("long")
    # at most 40,001 grades; the running count over them is one small window
    by_grade = scored.groupBy(grade.alias("grade")).agg(F.count("*").alias("m")).withColumn("rank", F.sum("m").over(Window.orderBy("grade")))
    by_grade = by_grade.withColumn("q", F.col("grade") / 100.0 + math.log10(tests) - F.log10(F.col("rank").cast("double")))
    by_grade = by_grade.withColumn("log10_q", F.least(F.lit(0.0), F.min("q").over(Window.orderBy(F.desc("grade"))))).select("grade", "log10_q")
    return (
        scored.withColumn("grade", grade)
        .join(F.broadcast(by_grade), "grade")
        .select(
            "item_a", "item_b", "n_ab", "n_a", "n_b", F.lit(total).cast("long").alias("n_baskets"),
            (F.col("n_ab") * F.lit(float(total)) / (F.col("n_a").cast("double") * F.col("n_b"))).alias("lift"),
            (F.col("n_ab") / (F.col("n_a") + F.col("n_b") - F.col("n_ab"))).alias("jaccard"),
            "expected", "log10_p", "log10_q",
        )
    )
