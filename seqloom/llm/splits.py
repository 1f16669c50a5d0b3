"""Splits that keep related records together.

Records that share a key are related. Keys are the vertices of a graph and
records that hold two keys its edges; its components are found by contracting,
round by round, the least edge of every component. The edges chosen make up a
spanning forest, which can be written as a table. The components are then put in
bands by size and dealt systematically, the largest band first: along a running
sum of sizes, each falls to the split whose share of the cycle it meets; a band's
cycle is shared out by what the splits still lack after the bands before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import checkpoint


def _least_edges(edges: DataFrame) -> DataFrame:
    """(v, to, w, p, q): the least edge of every vertex."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("x").alias("v"), F.col("y").alias("to")), F.struct(F.col("y").alias("v"), F.col("x").alias("to")))).alias("e"), "w", "p", "q")
    best = ends.groupBy("e.v").agg(F.min(F.struct("w", "p", "q", "e.to")).alias("m"))
    return best.select("v", "m.to", "m.w", "m.p", "m.q")


def _roots(picks: DataFrame) -> DataFrame:
    """(v, root) of the trees that the least edges make.

    With distinct weights the only cycles are edges that both ends chose; the smaller
    end becomes the root. Paths are halved until none is left.
    """
    both = picks.groupBy("w", "p", "q").agg(F.count("*").alias("c"), F.min("v").alias("r")).where("c = 2").select(F.col("r").alias("v"), F.lit(True).alias("top"))
    parents = checkpoint(picks.select("v", "to").join(both, "v", "left").select("v", F.when(F.col("top"), F.col("v")).otherwise(F.col("to")).alias("root")))
    while True:
        up = parents.select(F.col("v").alias("root"), F.col("root").alias("next"))
        halved = checkpoint(parents.join(up, "root").select("v", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")))
        parents = halved.select("v", "root")
        if halved.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((vertex, root), forest (p, q)) of the edges (p, q); root is one of the component's vertices.

    Loops and repeated edges do no harm. Weights are hashes, made distinct by the ends.
    """
    edges = edges.where("p is not null and q is not null and p != q").select("p", "q").distinct()
    edges = checkpoint(edges.select(F.col("p").alias("x"), F.col("q").alias("y"), F.xxhash64("p", "q").alias("w"), "p", "q"))
    member = None
    forest = []
    while not edges.isEmpty():
        picks = checkpoint(_least_edges(edges))
        forest.append(picks.select("p", "q").distinct())
        roots = _roots(picks)
        if member is None:
            member = roots.select(F.col("v").alias("vertex"), "root")
        else:
            step = roots.select(F.col("v").alias("root"), F.col("root").alias("next"))
            member = checkpoint(member.join(step, "root", "left").select("vertex", F.coalesce("next", "root").alias("root")))
        x, y = roots.select(F.col("v").alias("x"), F.col("root").alias("rx")), roots.select(F.col("v").alias("y"), F.col("root").alias("ry"))
        joined = edges.join(x, "x").join(y, "y").where("rx != ry").select(F.least("rx", "ry").alias("x"), F.greatest("rx", "ry").alias("y"), "w", "p", "q")
        edges = checkpoint(joined.groupBy("x", "y").agg(F.min(F.struct("w", "p", "q")).alias("m")).select("x", "y", "m.w", "m.p", "m.q"))
    if member is None:
        return edges.select(F.col("x").alias("vertex"), F.col("y").alias("root")), edges.select("p", "q")
    tree = forest[0]
    for more in forest[1:]:
        tree = tree.unionByName(more)
    return member, tree


def related_groups(df: DataFrame, row: str, keys: Sequence[Column], keep: Sequence[str] = (), forest: str | None = None) -> DataFrame:
    """(row, keep..., root): rows related by an equal non-null key, directly or through others.

    ``forest``: folder, shared by all executors, to which the spanning forest is written
    as parquet (p, q); its vertices are ``1:`` and ``2:`` before a value of either key.

    ``keys``: two columns; a value of one never equals a value of the other. A row
    without keys is its own group, and so is each such row with a null id.
    """
    first, second = keys
    rows = df.select(
        F.col(row).cast("string").alias(row), *[F.col(c) for c in keep if c != row],
        F.concat(F.lit("1:"), first.cast("string")).alias("_p"), F.concat(F.lit("2:"), second.cast("string")).alias("_q"),
    )
    rows = checkpoint(rows)
    member, tree = components(rows.select(F.col("_p").alias("p"), F.col("_q").alias("q")))
    if forest is not None:
        tree.write.mode("overwrite").parquet(forest)
    # an anchor without edges is its own component
    found = rows.withColumn("vertex", F.coalesce("_p", "_q")).join(member, "vertex", "left")
    alone = F.concat(F.lit("0:"), F.coalesce(F.col(row), F.concat(F.lit("?"), F.monotonically_increasing_id().cast("string"))))
    return checkpoint(found.select(*[c for c in rows.columns if c not in ("_p", "_q")], F.coalesce("root", "vertex", alone).alias("root")))


def running_sum(df: DataFrame, group: Sequence[str], order: Column, tie: str, value: str, bits: int = 8) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over the rows of the group that come earlier.

    ``order``: a hash as long, equal ones by ``tie``. Its leading bits cut each group in parts that are summed
    on their own, so that no group is put in one window; the parts' sums are few.
    """
    parted = df.withColumn("_o", order).withColumn("_part", F.shiftright("_o", 64 - bits))
    sums = parted.groupBy(*group, "_part").agg(F.sum(value).alias("_s"))
    offset = F.sum("_s").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("_at", F.coalesce(offset, F.lit(0))).drop("_s")
    inner = Window.partitionBy(*group, "_part").orderBy("_o", tie).rowsBetween(Window.unboundedPreceding, -1)
    return parted.join(sums, [*group, "_part"]).withColumn("before", F.col("_at") + F.coalesce(F.sum(value).over(inner), F.lit(0))).drop("_o", "_part", "_at")


def _dealt(at: Column, lacks: dict[tuple[str, str], float], names: Sequence[str], task: str, spare: str) -> Column:
    """The split at ``at`` in 0..1, which is shared out by what each lacks of the task."""
    need = {s: n for s in names if (n := max(0.0, lacks[s, task])) > 0} or {spare: 1.0}
    whole, edge = sum(need.values()), 1.0
    choice = F.lit(list(need)[-1])
    for s, after in reversed(list(zip(need, list(need)[1:]))):
        edge -= need[after] / whole
        choice = F.when(at < edge, F.lit(s)).otherwise(choice)
    return choice


def deal_groups(rows: DataFrame, task: Column, targets: Sequence[tuple[str, float]], seed: int = 42) -> DataFrame:
    """(root, split_name): a split for every group, shares kept overall and per task.

    Groups stand in bands by the power of two of their size, and in one chain for each
    band and leading task (there must be few tasks), of which they hold the largest part. Bands are dealt from the largest
    down, every chain systematically in a seeded order. Only a group larger than the
    whole smallest split, of which there are fewer than 1 / share, is placed before, in
    the split that it overfills least. Fewer groups than splits leave splits empty.
    To the driver go sums by split and task, a band at a time.
    """
    total_share = sum(max(0.0, s) for _, s in targets)
    if not targets or total_share <= 0:
        raise ValueError("a positive share is needed")
    shares = {name: s / total_share for name, s in targets if s > 0}
    least, spare = min(shares.values()), max(shares, key=lambda s: shares[s])
    counted = rows.withColumn("task", F.coalesce(task, F.lit(""))).groupBy("root", "task").agg(F.count("*").alias("n"))
    groups = checkpoint(counted.groupBy("root").agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("task", "n"))).alias("by_task")))
    all_tasks = {r["task"]: r["n"] for r in groups.select(F.explode("by_task").alias("task", "n")).groupBy("task").agg(F.sum("n").alias("n")).collect()}
    # the task of which a group holds the largest part of all rows
    part = F.array(*[F.struct((F.coalesce(F.try_element_at("by_task", F.lit(t)), F.lit(0)) / n).alias("part"), F.lit(t).alias("task")) for t, n in sorted(all_tasks.items())] or [F.struct(F.lit(0.0).alias("part"), F.lit("").alias("task"))])
    groups = groups.withColumn("task", F.array_max(part)["task"])
    total = sum(all_tasks.values())
    lacks = {(s, t): share * n for s, share in shares.items() for t, n in all_tasks.items()}
    bound = max(1.0, total * least)
    fixed: list[tuple[str, str]] = []
    for r in groups.where(F.col("size") > bound).orderBy(F.desc("size"), "root").collect():
        own = r["by_task"]

        def cost(s: str, own: dict[str, int] = own) -> tuple[float, float]:
            over = sum(max(0.0, n - lacks[s, t]) / all_tasks[t] for t, n in own.items())
            return over, -sum(n * lacks[s, t] / (shares[s] * all_tasks[t]) for t, n in own.items())

        chosen = min(shares, key=cost)
        fixed.append((r["root"], chosen))
        for t, n in own.items():
            lacks[chosen, t] -= n
    rest = groups.where(F.col("size") <= bound).withColumn("band", F.floor(F.log2("size")).cast("int"))
    # parts of some 20,000 groups, also in the band that holds nearly all of them
    bits = min(20, max(4, math.ceil(math.log2(max(1, groups.count()) / 20_000))))
    summed = running_sum(rest, ["task", "band"], F.xxhash64(F.lit(seed), "root"), "root", "size", bits)
    cycle = F.pow(F.lit(2.0), F.col("band") + 1) / least
    placed = checkpoint(summed.withColumn("at", ((F.col("before") + F.col("size") / 2.0) / cycle) % 1.0).select("root", "task", "band", "at", "by_task"))
    several = checkpoint(placed.where("band > 0"))  # few beside the single rows, and read once a band
    bands = [r["band"] for r in several.select("band").distinct().orderBy(F.desc("band")).collect()]
    dealt = rows.sparkSession.createDataFrame(fixed, "root string, split_name string")
    for band in [*bands, 0]:
        choice = F.lit(None).cast("string")
        for t in all_tasks:
            choice = F.when(F.col("task") == t, _dealt(F.col("at"), lacks, list(shares), t, spare)).otherwise(choice)
        chain = (several if band else placed).where(F.col("band") == band).withColumn("split_name", choice)
        if band:
            for r in chain.select("split_name", F.explode("by_task").alias("t", "n")).groupBy("split_name", "t").agg(F.sum("n").alias("n")).collect():
                lacks[r["split_name"], r["t"]] -= r["n"]
        dealt = dealt.unionByName(chain.select("root", "split_name"))
    return dealt


def split_related(df: DataFrame, row: str, keys: Sequence[Column], task: Column, targets: Sequence[tuple[str, float]], seed: int = 42, forest: str | None = None) -> DataFrame:
    """(row, task, root, split_name) for every row; related rows share a split.

    Null ids, keys and tasks are allowed (a null task is a task of its own); repeated
    rows are related by their keys. An empty table gives no rows.
    """
    rows = related_groups(df.withColumn("_task", task), row, keys, ["_task"], forest).withColumnRenamed("_task", "task")
    dealt = deal_groups(rows, F.col("task"), targets, seed)
    return rows.join(dealt, "root").select(row, "task", "root", "split_name")
