"""Seeded sampling, quotas, splits and numbering, alike under any partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import checkpoint, parallelism


def seeded(seed: int, *keys: str | Column) -> Column:
    """A text that orders rows at random but fixed by seed and keys."""
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]))


def half_even(value: float) -> int:
    """Rounded to the nearest whole number, halves to the even one."""
    return round(value)


def quotas(target: int, share_a: float, share_b: float) -> dict[str, int]:
    """Examples of each task; the third takes the rest."""
    a, b = half_even(target * share_a), half_even(target * share_b)
    if min(a, b, target - a - b) < 0:
        raise ValueError("shares exceed the target")
    return {"A": a, "B": b, "C": target - a - b}


def running_totals(df: DataFrame, order: str | Column, values: Sequence[str], width: int | None = None) -> DataFrame:
    """``df`` with place (from 0) and, for every value, <value>_before: the sum over earlier rows.

    Rows are range-partitioned; each partition is numbered on its own and starts from
    the sums of those before it, so no task sees all rows. ``order`` must order rows fully.
    """
    order = F.col(order) if isinstance(order, str) else order
    parts = df.withColumn("_o", order).repartitionByRange(width or max(1, parallelism(df.sparkSession) // 2), "_o").withColumn("_p", F.spark_partition_id())
    parts = checkpoint(parts)  # the ranges are sampled anew each time a plan runs
    sums = parts.groupBy("_p").agg(F.count("*").alias("_n"), *[F.sum(v).alias(f"_s_{v}") for v in values])
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    sums = sums.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_s0_{v}") for v in values])
    inner = Window.partitionBy("_p").orderBy("_o")
    earlier = inner.rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(F.broadcast(sums), "_p").withColumn("place", F.col("_n0") + F.row_number().over(inner) - 1)
    for v in values:
        out = out.withColumn(f"{v}_before", F.col(f"_s0_{v}") + F.coalesce(F.sum(v).over(earlier), F.lit(0)))
    return out.drop("_p", "_o", "_n0", *[f"_s0_{v}" for v in values])


#: Leading hex digits of the seeded text that rows are counted by: at most 65,536 counts.
_DIGITS = 4


def _first(pool: DataFrame, quota: int, key: Column, counts: dict[str, int]) -> DataFrame:
    """The ``quota`` rows of least ``key``.

    Counts by leading digits tell which rows are in for certain; only those of the one
    group of digits in which the quota ends are ordered.
    """
    before = 0
    for digits in sorted(counts):
        if before + counts[digits] >= quota:
            break
        before += counts[digits]
    columns = pool.columns
    keyed = pool.withColumn("_key", key)
    lead = F.substring("_key", 1, _DIGITS)
    edge = keyed.where(lead == digits).orderBy("_key").limit(quota - before)
    return (keyed.where(lead < digits).unionByName(edge) if before else edge).select(*columns)


def sample_to_quota(pool: DataFrame, quota: int, order: Sequence[str | Column], seed: int = 42) -> DataFrame:
    """``quota`` rows of the pool: a seeded draw, or whole reshuffled cycles if it is too small.

    ``order``: columns that name a row. An empty pool with a quota is an error.
    """
    if quota <= 0:
        return pool.limit(0)

    def counts(key: Column) -> dict[str, int]:
        return {r["d"]: r["n"] for r in pool.groupBy(F.substring(key, 1, _DIGITS).alias("d")).agg(F.count("*").alias("n")).collect()}

    key = seeded(seed, *order)
    found = counts(key)
    n = sum(found.values())
    if not n:
        raise ValueError(f"no rows for a quota of {quota}")
    if n > quota:
        return _first(pool, quota, key, found)
    full, rest = divmod(quota, n)
    whole = pool if full == 1 else pool.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(full)))).drop("_c")
    if not rest:
        return whole
    key = seeded(seed + full, *order)
    return whole.unionByName(_first(pool, rest, key, counts(key)))


def sample_groups(pool: DataFrame, group: str, wanted: Mapping[str, int], order: Sequence[str | Column], seed: int = 42) -> DataFrame:
    """:func:`sample_to_quota` for each value of a column; groups that are not wanted are left out."""
    out = None
    for value, quota in wanted.items():
        if quota > 0:
            part = sample_to_quota(pool.where(F.col(group) == value), quota, order, seed)
            out = part if out is None else out.unionByName(part)
    return pool.limit(0) if out is None else out


def shuffled(df: DataFrame, order: Sequence[str | Column], seed: int = 42) -> DataFrame:
    """Rows in a random order fixed by the seed."""
    return df.orderBy(seeded(seed, *order), *order)


def numbered(df: DataFrame, order: Sequence[str | Column], seed: int = 42, pattern: str = "prep_%09d", name: str = "example_id") -> DataFrame:
    """Rows with ids from 1 on in shuffled order."""
    placed = running_totals(df.withColumn("_k", F.concat_ws("\x1f", seeded(seed, *order), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in order])), "_k", ())
    return placed.select(F.format_string(pattern, F.col("place") + 1).alias(name), *df.columns)


def split_sizes(rows: int, share: float) -> int:
    """Rows that are held out: at least one, and never all of them."""
    if rows <= 0 or not 0 < share < 1:
        raise ValueError("rows and a share between 0 and 1 are needed")
    held = max(1, half_even(rows * share))
    return held if held < rows else max(1, rows // 5)


def validation_size(rows: int, share: float) -> int:
    """Rows for validation: between one and all but one."""
    return min(max(1, half_even(rows * share)), max(1, rows - 1))


def held_out(df: DataFrame, share: float, order: Sequence[str | Column], seed: int = 42, name: str = "part", size=split_sizes) -> DataFrame:
    """Rows with 'eval' for a seeded draw of the wanted size, else 'train'."""
    held = size(df.count(), share)
    key = F.concat_ws("\x1f", seeded(seed, *order), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in order])
    placed = running_totals(df.withColumn("_k", key), "_k", ())
    return placed.select(*df.columns, F.when(F.col("place") < held, "eval").otherwise("train").alias(name))


def stage_mix(domain: DataFrame, general: DataFrame | None, weights: Mapping[str, float], general_share: float, order: Sequence[str], most: int = 0, seed: int = 42, least: int = 128) -> DataFrame:
    """Rows of a training stage: weighted tasks, and general rows up to their share of the whole."""
    there = domain.count()
    target = there if most <= 0 else min(there, most)
    if target < least:
        raise ValueError(f"{target} rows are too few for a stage")
    wanted = {task: half_even(target * weight) for task, weight in weights.items()}
    mixed = sample_groups(domain, "task", wanted, order, seed)
    if general_share > 0:
        if general is None or general.isEmpty():
            raise ValueError("general rows are wanted but there are none")
        extra = half_even(sum(q for q in wanted.values() if q > 0) * general_share / max(1e-9, 1 - general_share))
        mixed = mixed.unionByName(sample_to_quota(general, extra, order, seed))
    return mixed
