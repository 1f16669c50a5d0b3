"""The most similar vectors of every vector, by shifted space-filling curves.

The vectors are projected several times onto a few random directions inside of
their leading principal components and each time put in the order of a shifted
Hilbert curve. Spark range-partitions and sorts the keys, which gives every vector
its rank on every curve. Ranks are cut into blocks; a block also gets the window of
rows on either side of it, so that windows neither end at a partition nor depend on
the number of partitions or the size of an Arrow batch. Every vector is compared
with those within its window; the lists that the curves give are merged and ranked
again by the exact cosine. Rows of one key have no order on the curve and may hardly
differ; where they are more than a list holds, all of them are compared with each
other in double precision.

Equal vectors are one class: they get one key, and no class is longer than its
first k + 1 members in the lists, so that copies cannot fill a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import checkpoint, parallelism


@dataclass(frozen=True)
class CurveIndex:
    """Settings of the curves.

    ``sample``: rows the principal components are fitted on, the only bound on rows;
    every row is put on every curve. ``window``: rows before and after that each row
    is compared with on each curve. ``stretch``: windows in a block, which is what one
    task holds beside a window on either side. ``block``: rows of a long run of one key
    that are compared at a time; the run itself may be of any length.
    """

    curves: int = 16
    dims: int = 8
    bits: int = 6
    subspace: int = 48
    window: int = 768
    sample: int = 5000
    spare: int = 2
    seed: int = 42
    stretch: int = 8
    block: int = 16_384


def floats(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow column of lists, or of packed single-precision vectors, as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.empty((0, 0), np.float32)
    if pa.types.is_binary(column.type):
        _, offsets, data = column.buffers()
        first, last = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
        return np.frombuffer(data, np.float32, (last - first) // 4, first).reshape(len(column), -1)
    return column.flatten().to_numpy().reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.Array:
    """A matrix as a column of packed vectors; Spark copies those without looking at their entries."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize if len(rows) else 0
    ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, ends.buffers()[1], pa.py_buffer(rows)])


def usable_vectors(df: DataFrame, key: str, vector: str, dim: int, order: Column, where: Column) -> DataFrame:
    """(id, vec): the latest usable vector of each key, scaled to length 1.

    Usable: ``where`` holds, ``dim`` entries, all finite, not all zero. Of equal
    ``order`` the greater vector is taken. Null keys are left out.
    """
    rows = df.where(where & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), order.alias("o"), F.col(vector).cast("array<float>").alias("v")).where(F.size("v") == dim)

    def finite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["v"].flatten()
            x = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield batch.filter(pa.array(np.isfinite(x).all(1) & x.any(1)))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = floats(batch["v"]).astype(np.float64)
            x /= np.sqrt((x * x).sum(1))[:, None] if len(x) else 1
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * np.int32(dim))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["id", "vec"])

    best = rows.mapInArrow(finite, rows.schema).groupBy("id").agg(F.max(F.struct("o", "v")).alias("m"))
    return best.select("id", F.col("m.v").alias("v")).mapInArrow(scaled, "id long, vec array<double>")


def _sortable(x: np.ndarray) -> np.ndarray:
    """Each row of floats as bytes that sort as the row does."""
    top = {2: 0x8000, 4: 0x8000_0000}[x.itemsize]
    bits = x.view(f"u{x.itemsize}")
    return np.where(bits & top, ~bits, bits | top).astype(f">u{x.itemsize}")


def _sorted_floats(column: pa.Array, width: int) -> np.ndarray:
    """Rows of :func:`_sortable`, of ``width`` bytes an entry, as floats."""
    top = {2: 0x8000, 4: 0x8000_0000}[width]
    _, offsets, data = column.buffers()
    first, last = np.frombuffer(offsets, np.int32)[[column.offset, column.offset + len(column)]]
    bits = np.frombuffer(data, f">u{width}", (last - first) // width, first).astype(f"u{width}")
    return np.where(bits & top, bits & (top - 1), ~bits).astype(f"u{width}").view(f"f{width}").reshape(len(column), -1)


def short(x: np.ndarray) -> pa.Array:
    """Rows that half precision holds as they are; a byte more tells them from rows in single precision."""
    rows = np.zeros((len(x), 2 * x.shape[1] + 1), np.uint8)
    rows[:, :-1] = np.ascontiguousarray(x, np.float16).view(np.uint8)
    return packed(rows)


def units(column: pa.Array | pa.ChunkedArray, kind: type = np.float32) -> np.ndarray:
    """Packed rows, in single precision or :func:`short`, scaled to length 1."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    if not n:
        return np.empty((0, 0), kind)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1]
    size = np.diff(ends)
    halves = size % 2 == 1
    dim = int(size[0] // 2 if halves[0] else size[0] // 4)
    x = np.empty((n, dim))
    for own, entry, width in ((halves, np.float16, 2 * dim + 1), (~halves, np.float32, 4 * dim)):
        if own.all():
            rows = np.frombuffer(data, np.uint8, n * width, ends[0]).reshape(n, width)
        elif own.any():
            rows = np.frombuffer(data, np.uint8)[ends[:-1][own][:, None] + np.arange(width)]
        else:
            continue
        x[own] = np.ascontiguousarray(rows[:, : width // 2 * 2]).view(entry)
    length = np.sqrt(np.einsum("ij,ij->i", x, x))
    return (x / np.where(length > 0, length, 1)[:, None]).astype(kind)


def compact_vectors(df: DataFrame, key: str, vector: str, dim: int, order: Column, where: Column) -> DataFrame:
    """(id, vec): the rows of :func:`usable_vectors`, packed as they are and not scaled; see :func:`units`.

    A row whose entries half precision holds exactly takes two bytes an entry, any other
    four, so that no more is moved than the table itself holds.
    """
    rows = df.where(where & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), order.alias("o"), F.col(vector).cast("array<float>").alias("v")).where(F.size("v") == dim)
    kind = rows.schema["o"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["v"].flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            usable = np.isfinite(x).all(1) & x.any(1)
            x, batch = x[usable] + np.float32(0), batch.filter(pa.array(usable))  # -0 is 0
            with np.errstate(over="ignore"):
                halves = x.astype(np.float16)
            exact = (halves == x).all(1)
            for own, y in ((exact, halves), (~exact, x)):
                if own.any():
                    part = batch.filter(pa.array(own))
                    yield pa.RecordBatch.from_arrays([part["id"], part["o"], packed(_sortable(y[own]))], names=["id", "o", "k"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, none = pa.Table.from_batches([batch]), pa.compute.is_null
            both = table.filter(pa.compute.invert(pa.compute.or_(none(table["a"]), none(table["b"]))))
            single = set()
            for id_, a, b in zip(both["id"].to_pylist(), both["a"].to_pylist(), both["b"].to_pylist(), strict=True):
                x, y = (_sorted_floats(pa.array([s["k"]], pa.binary()), w)[0].tolist() for s, w in ((a, 2), (b, 4)))
                if (b["o"] is not None, b["o"] or 0, y) > (a["o"] is not None, a["o"] or 0, x):
                    single.add(id_)
            wide = np.asarray(none(table["a"])) | np.isin(table["id"].to_numpy(), list(single))
            for own, column, width in ((~wide, "a", 2), (wide, "b", 4)):
                if own.any():
                    part = table.filter(pa.array(own)).combine_chunks()
                    x = _sorted_floats(pa.compute.struct_field(part[column].combine_chunks(), "k"), width)
                    yield pa.RecordBatch.from_arrays([part["id"].combine_chunks(), short(x) if width == 2 else packed(x)], names=["id", "vec"])

    made = rows.mapInArrow(pack, f"id long, o {kind}, k binary")
    # as bytes, vectors of one width are in the order of their entries
    both = made.groupBy("id").agg(*[F.max(F.when(F.length("k") == n * dim, F.struct("o", "k"))).alias(c) for c, n in (("a", 2), ("b", 4))])
    return both.mapInArrow(choose, "id long, vec binary")


def pack_vectors(vectors: DataFrame, kind: type = np.float32) -> DataFrame:
    """(id, vec) with vec packed in bytes, in single precision by default."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["id"], packed(floats(batch["vec"]).astype(kind))], names=["id", "vec"])

    return vectors.select("id", "vec").mapInArrow(run, "id long, vec binary")


def vector_classes(vectors: DataFrame, keep: int) -> DataFrame:
    """(id, vec, members): equal packed vectors together; id is the smallest, members the ``keep`` smallest.

    Ranked within a limit, which Spark applies before and after the shuffle, so that
    a class is never gathered however large it is.
    """
    rows = vectors.select("id", "vec").withColumn("h", F.xxhash64("vec"))
    place = F.row_number().over(Window.partitionBy("h", "vec").orderBy("id"))
    return rows.withColumn("place", place).where(F.col("place") <= keep).groupBy("h", "vec").agg(F.array_sort(F.collect_list("id")).alias("members")).select(F.element_at("members", 1).alias("id"), "vec", "members")


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers, as a non-negative long.

    Works on the transposed form: exchange and inversion of the lower bits from the
    top bit down, then the Gray code.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for i in range(n):
            invert = (x[i] >> bit) & 1 == 1
            swap = np.where(invert, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(invert, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


@dataclass(frozen=True)
class _Projection:
    centre: np.ndarray
    axes: np.ndarray
    low: np.ndarray
    width: np.ndarray
    shift: np.ndarray

    def keys(self, rows: np.ndarray, bits: int) -> np.ndarray:
        place = ((rows - self.centre) @ self.axes - self.low) / self.width * 0.8 + 0.2 * self.shift
        return hilbert_keys(np.clip(place * (1 << bits), 0, (1 << bits) - 1), bits)


def fit_projections(classes: DataFrame, index: CurveIndex) -> list[_Projection]:
    """Random directions in the leading components of at most ``index.sample`` rows."""
    rows = classes.select("id", "vec").orderBy(F.xxhash64(F.lit(index.seed), "id"), "id").limit(index.sample).collect()
    if not rows:
        return []
    x = np.stack([np.frombuffer(r["vec"], np.float32) for r in rows]).astype(np.float64)
    centre = x.mean(0)
    _, axes = np.linalg.eigh(np.cov((x - centre).T) if len(x) > 1 else np.eye(x.shape[1]))
    axes = axes[:, ::-1][:, : min(index.subspace, x.shape[1])]
    rng = np.random.default_rng(index.seed)
    found = []
    for _ in range(index.curves):
        turn = np.linalg.qr(rng.standard_normal((axes.shape[1], min(index.dims, axes.shape[1]))))[0]
        place = (x - centre) @ (axes @ turn)
        low, high = np.quantile(place, [0.01, 0.99], axis=0)
        found.append(_Projection(centre, axes @ turn, low, np.maximum(high - low, 1e-9), rng.random(turn.shape[1])))
    return found


def _top(sims: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of at least the ``keep`` greatest of each row; ties at the edge come along.

    The ``keep``-th of the maxima of column groups is a lower bound, which few entries
    pass; that is several times faster than ordering the row.
    """
    n, m = sims.shape
    wide = max(1, m // (4 * keep))
    groups = m // wide
    if wide < 2 or groups <= keep:
        return np.nonzero(np.ones_like(sims, bool))
    heads = sims[:, : groups * wide].reshape(n, wide, groups).max(1)
    bound = np.partition(heads, groups - keep, axis=1)[:, groups - keep]
    at = np.flatnonzero(sims >= bound[:, None])
    return at // m, at % m


_NEAR = "id long, near array<struct<d: double, other: long>>"


def _ranked(own_ids: np.ndarray, at: np.ndarray, others: np.ndarray, far: np.ndarray, keep: int) -> pa.RecordBatch:
    """(id, near): the ``keep`` entries of least (far, other) for every id; ``at`` is ascending."""
    order = np.lexsort((others, far, at))
    at, others, far = at[order], others[order], far[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    kept = place < keep
    at, others, far = at[kept], others[kept], far[kept]
    ends = np.cumsum(np.bincount(at, minlength=len(own_ids)))
    pairs = pa.StructArray.from_arrays([pa.array(far), pa.array(others)], names=["d", "other"])
    return pa.RecordBatch.from_arrays([pa.array(own_ids), pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pairs)], names=["id", "near"])


def _nothing() -> pa.RecordBatch:
    none = np.empty(0, np.int64)
    return _ranked(none, none, none, np.empty(0), 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision; lengths are divided out again, as single precision moves them by 1e-8."""
    wide = rows.astype(np.float64)
    wide /= np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]
    return wide


def _best(own_ids: np.ndarray, own: np.ndarray, own_unit: np.ndarray, ids: np.ndarray, rows: np.ndarray, unit: np.ndarray, keep: int, least: float = -2.0) -> pa.RecordBatch:
    """(id, near): the ``keep`` most similar of ``rows`` to each of ``own``, itself and those below ``least`` left out.

    Single precision chooses, with one to spare for the row itself, and double decides.
    """
    sims = own @ rows.T
    at, col = _top(sims, keep + 1)
    near = (sims[at, col] >= least - 1e-5) & (own_ids[at] != ids[col])
    at, col = at[near], col[near]
    sim = np.empty(len(at))
    for s in range(0, len(at), 1024):
        c = slice(s, s + 1024)
        sim[c] = np.einsum("ij,ij->i", own_unit[at[c]], unit[col[c]])
    return _ranked(own_ids, at, ids[col], -np.round(sim, 12), keep)


def _best_fine(own_ids: np.ndarray, own: np.ndarray, ids: np.ndarray, rows: np.ndarray, keep: int) -> list[pa.RecordBatch]:
    """Like :func:`_best`, chosen in double precision at twelve digits, equal ones by smaller id, as rows that hardly differ need."""
    unit = _unit(rows)
    place = np.argsort(np.argsort(ids))
    out = []
    for s in range(0, len(own), 256):
        sims = _unit(own[s : s + 256]) @ unit.T
        far = np.rint((1 - sims) * 1e12).astype(np.int64) * len(ids) + place
        same = own_ids[s : s + 256, None] == ids[None, :]
        far[same] = np.iinfo(np.int64).max
        top = np.argpartition(far, keep - 1, axis=1)[:, :keep] if far.shape[1] > keep else np.argsort(far, axis=1)
        at, slot = np.nonzero(~np.take_along_axis(same, top, 1))
        col = top[at, slot]
        out.append(_ranked(own_ids[s : s + 256], at, ids[col], -np.round(sims[at, col], 12), keep))
    return out


def curve_keys(rows: DataFrame, projections: list[_Projection], index: CurveIndex) -> DataFrame:
    """(id, key) of every row of (id, vec) on every curve; the curve's number leads the key, so that one long sorts."""
    free = index.dims * index.bits
    if free + (len(projections) - 1).bit_length() > 63:
        raise ValueError("curves, dims and bits do not fit one key")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = floats(batch["vec"]).astype(np.float64)
            for curve, projection in enumerate(projections):
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(projection.keys(x, index.bits) | curve << free)], names=["id", "key"])

    return rows.select("id", "vec").mapInArrow(keyed, "id long, key long")


def curve_ranks(keys: DataFrame, index: CurveIndex) -> DataFrame:
    """(id, curve, rank): rank from 0 of every row on its curve, by key.

    Rows of one key stand in another order on every curve. The order is made by a
    range partitioning; a partition's first ranks follow from the row counts of the
    partitions before it, one small row for each.
    """
    curve = F.shiftright("key", index.dims * index.bits).cast("int")
    tied = keys.withColumn("tie", F.xxhash64(curve, "id"))
    order = ["key", "tie", "id"]
    ordered = tied.repartitionByRange(parallelism(keys.sparkSession), *order).sortWithinPartitions(*order)
    placed = checkpoint(ordered.select("id", curve.alias("curve"), F.monotonically_increasing_id().alias("m")))
    placed = placed.withColumn("part", F.shiftright("m", 33))
    sums = placed.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("curve", "part", (before - F.col("first")).alias("offset"))
    return placed.join(F.broadcast(sums), ["curve", "part"]).select("id", "curve", (F.col("m") + F.col("offset")).alias("rank"))


def _window_lists(rows: DataFrame, ranks: DataFrame, index: CurveIndex, keep: int, least: float) -> DataFrame:
    """(id, near) of every curve: each asking row against the ``window`` ranks before and after it."""
    window, size = index.window, index.window * index.stretch
    block = F.expr(f"rank div {size}")
    into = F.col("rank") - block * size
    places = F.array(
        F.struct(block.alias("b"), F.lit(True).alias("own")),
        F.when((into < window) & (block > 0), F.struct((block - 1).alias("b"), F.lit(False).alias("own"))),
        F.when(into >= size - window, F.struct((block + 1).alias("b"), F.lit(False).alias("own"))),
    )
    placed = ranks.join(rows, "id").select("id", "vec", "ask", "curve", "rank", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("p"))
    placed = placed.select("id", "vec", (F.col("ask") & F.col("p.own")).alias("asks"), "rank", (F.col("p.b") * index.curves + F.col("curve")).alias("block"))
    step = min(512, window)

    def compare(group: pa.Table) -> pa.Table:
        rank = group["rank"].to_numpy()
        order = np.argsort(rank)
        rank = rank[order]
        ids, x, asks = group["id"].to_numpy()[order], floats(group["vec"])[order], np.asarray(group["asks"])[order]
        found, unit = [], _unit(x)
        # steps begin at multiples of their length, so who meets whom follows from the ranks alone
        edges = np.searchsorted(rank, np.arange(rank[0] // step * step, rank[-1] + step + 1, step))
        for a, b in zip(edges, edges[1:]):
            mine = a + np.flatnonzero(asks[a:b])
            if len(mine):
                first = rank[a] // step * step
                c, d = np.searchsorted(rank, [first - window, first + step + window])
                found.append(_best(ids[mine], x[mine], unit[mine], ids[c:d], x[c:d], unit[c:d], keep, least))
        return pa.Table.from_batches(found or [_nothing()])

    return placed.groupBy("block").applyInArrow(compare, _NEAR)


def _long_runs(rows: DataFrame, keys: DataFrame, index: CurveIndex, keep: int) -> DataFrame | None:
    """(id, near) within the runs of more than ``keep`` rows of one key, every row with every other.

    A run is cut into blocks by hash, and each pair of blocks is one group, so that no
    task holds more than about two blocks; the work is quadratic in the run. A run that
    holds the same rows on several curves is compared once. None if no run is that long.
    """
    print_of = [F.count("*").alias("n"), F.min("id").alias("least"), F.sum(F.shiftright(F.xxhash64("id"), 32)).alias("sum")]
    runs = keys.groupBy("key").agg(*print_of).where(F.col("n") > keep)
    runs = checkpoint(runs.groupBy("n", "least", "sum").agg(F.min("key").alias("key")).select("key", "n"))
    if runs.isEmpty():
        return None
    parts = F.ceil(F.col("n") / F.lit(index.block)).cast("int")
    inside = keys.join(runs, "key").join(rows, "id").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    one = ["id", "vec", "key"]
    asking = inside.where("ask").select(*one, F.col("part").alias("a"), F.explode(every).alias("b"), F.lit(True).alias("asks"))
    asked = inside.select(*one, F.explode(every).alias("a"), F.col("part").alias("b"), F.lit(False).alias("asks"))

    def compare(group: pa.Table) -> pa.Table:
        asks = np.asarray(group["asks"])
        ids, x = group["id"].to_numpy(), floats(group["vec"])
        if not asks.any() or asks.all():
            return pa.Table.from_batches([_nothing()])
        return pa.Table.from_batches(_best_fine(ids[asks], x[asks], ids[~asks], x[~asks], keep))

    return asking.unionByName(asked).groupBy("key", "a", "b").applyInArrow(compare, _NEAR)


def _merge(lists: DataFrame, keep: int) -> DataFrame:
    """(id, near): the best ``keep`` of the lists of one id, equal similarity by smaller id."""
    whole = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))
    return lists.groupBy("id").agg(F.slice(whole, 1, keep).alias("near"))


def nearest_classes(classes: DataFrame, k: int, index: CurveIndex, least: float = -2.0) -> DataFrame:
    """(id, near array<struct<d, other>>): nearest other classes of those that ask, d = -cosine.

    ``classes``: (id, vec, ask); all of them are put on every curve. ``least``: less
    similar ones are not wanted.
    """
    projections = fit_projections(classes, index)
    if not projections:
        return classes.sparkSession.createDataFrame([], _NEAR)
    keep = k + index.spare
    rows = classes.select("id", "vec", "ask")
    keys = checkpoint(curve_keys(rows, projections, index))
    lists = _window_lists(rows, curve_ranks(keys, index), index, keep, least)
    if (whole := _long_runs(rows, keys, index, keep)) is not None:
        lists = lists.unionByName(whole)
    return _merge(lists, keep)


def settle(classes: DataFrame, near: DataFrame, k: int, sure: float, most: int = 20_000) -> DataFrame:
    """Search all rows, in blocks, for asking classes whose k-th neighbour is below ``sure``.

    A curve finds near vectors; a vector without near ones has its neighbours
    anywhere. Such classes form a query set that is sent to every block of rows; at
    most ``most`` are sent at a time, more go in further passes.
    """
    kth = F.try_element_at("near", F.lit(k))["d"]
    open_ids = checkpoint(classes.where("ask").join(near, "id", "left").where(kth.isNull() | (-kth < sure)).select("id", "vec"))
    count = open_ids.count()
    if not count:
        return near
    passes = -(-count // most)
    best = None
    for part in range(passes):
        chosen = open_ids if passes == 1 else open_ids.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == part)
        rows = chosen.toArrow()
        own_ids, own = rows["id"].to_numpy(), floats(rows["vec"])

        def run(batches: Iterator[pa.RecordBatch], own_ids: np.ndarray = own_ids, own: np.ndarray = own) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, block = batch["id"].to_numpy(), floats(batch["vec"])
                unit = _unit(block)
                for s in range(0, len(own), 1024):
                    part = own[s : s + 1024]
                    yield _best(own_ids[s : s + 1024], part, _unit(part), ids, block, unit, k)

        found = _merge(classes.select("id", "vec").mapInArrow(run, _NEAR), k)
        best = found if best is None else best.unionByName(found)
    return near.join(open_ids.select("id"), "id", "left_anti").unionByName(best)


def _pools(classes: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """(cid, pool): the k + 1 best members for each class, its own among them."""
    others = (
        near.select(F.col("id").alias("cid"), F.explode("near").alias("x"))
        .select("cid", F.col("x.other").alias("id"), F.col("x.d").alias("d"))
        .join(classes.select("id", "members"), "id")
        .select("cid", F.explode("members").alias("other"), "d")
    )
    own = classes.where("ask and size(members) > 1").select(F.col("id").alias("cid"), F.explode("members").alias("other"), F.lit(-1.0).alias("d"))
    best = F.array_sort(F.collect_list(F.struct("d", "other")))
    return others.unionByName(own).groupBy("cid").agg(F.slice(best, 1, k + 1).alias("pool"))


def nearest_neighbours(vectors: DataFrame, k: int = 10, index: CurveIndex = CurveIndex(), every: int = 1, sure: float | None = None, least: float = -2.0) -> DataFrame:
    """(id, rank, other, sim): the k most similar other ids of every id divisible by ``every``.

    ``vectors``: (id, vec) of unit length, as :func:`usable_vectors` gives; all of them
    are searched. Order is by cosine, equal ones by smaller id. ``sure``: asking ids
    whose k-th neighbour on the curves is less similar are searched among all rows in
    blocks; without it the curves' answer stands. ``least``: of the k only those at
    least that similar are listed. Fewer than k + 1 vectors give shorter lists, an
    empty table none.
    """
    vectors = checkpoint(pack_vectors(vectors))
    listed = vector_classes(vectors, k + 1)
    asks = F.exists("members", lambda m: F.pmod(m, F.lit(every)) == 0) | (F.size("members") > k)
    classes = checkpoint(listed.withColumn("ask", asks))
    near = nearest_classes(classes, k, index, least)
    if sure is not None:
        near = settle(classes, checkpoint(near), k, sure)
    # a class of one is its own; copies find their class by the vector
    single = classes.where("ask and size(members) = 1").select("id", F.col("id").alias("cid"))
    shared = classes.where("ask and size(members) > 1").select(F.col("id").alias("cid"), F.xxhash64("vec").alias("h"), "vec")
    copies = vectors.withColumn("h", F.xxhash64("vec")).join(shared, ["h", "vec"]).select("id", "cid")
    ranked = single.unionByName(copies).where(F.pmod("id", F.lit(every)) == 0).join(_pools(classes, near, k), "cid")
    kept = F.slice(F.filter("pool", lambda x: (x["other"] != F.col("id")) & (-x["d"] >= least)), 1, k)
    return ranked.select("id", F.posexplode(kept).alias("rank", "x")).select(
        "id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.other").alias("other"), (-F.col("x.d")).alias("sim")
    )
