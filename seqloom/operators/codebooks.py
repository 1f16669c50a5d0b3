"""Residual codebooks: training, updates, usage, and vocabulary."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.vectors import nearest_codes


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    flat = batch[name].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 0))


def _added_up(rows: DataFrame, parts: int, fan_in: int = 16) -> list:
    """At most ``fan_in`` rows (part, binary and double columns) that add up to those of all parts, level by level."""
    names = [(c, t) for c, t in rows.dtypes if c != "part"]

    def add(group: pa.Table) -> pa.Table:
        out = {"part": pa.array([group["part"][0].as_py() // fan_in], pa.int32())}
        for c, t in names:
            if t == "binary":
                total = np.frombuffer(group[c][0].as_py()).copy()
                for x in group[c][1:]:
                    total += np.frombuffer(x.as_py())
                out[c] = pa.array([total.tobytes()], pa.binary())
            else:
                out[c] = pa.array([float(np.sum(group[c].to_numpy()))])
        return pa.table(out)

    while parts > fan_in:
        rows = rows.groupBy(F.floor(F.col("part") / fan_in).alias("g")).applyInArrow(add, rows.schema)
        parts = -(-parts // fan_in)
    return rows.collect()


def _part() -> pa.Array:
    from pyspark import TaskContext

    return pa.array([TaskContext.get().partitionId()], pa.int32())


def code_sums(vectors: DataFrame, column: str, books: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
    """(counts, sums, squared error) by code of the last of ``books`` on what the earlier ones left.

    Sums are made in every Arrow batch, added up per partition and then sixteen
    partitions at a time, so that at most sixteen codebooks reach the driver.
    """
    size, dim = books[-1].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, error = np.zeros(size), np.zeros((size, dim)), 0.0
        for batch in batches:
            left = _matrix(batch, column)
            if not len(left):
                continue
            for book in books[:-1]:
                left = left - book[nearest_codes(left, book)]
            code = nearest_codes(left, books[-1])
            counts += np.bincount(code, minlength=size)
            np.add.at(sums, code, left)
            error += float(((left - books[-1][code]) ** 2).sum())
        yield pa.RecordBatch.from_arrays([_part(), pa.array([counts.tobytes()]), pa.array([sums.tobytes()]), pa.array([error])], names=["part", "c", "s", "e"])

    rows = _added_up(vectors.select(column).mapInArrow(run, "part int, c binary, s binary, e double"), vectors.rdd.getNumPartitions())
    counts = sum((np.frombuffer(r["c"]) for r in rows), np.zeros(size))
    sums = sum((np.frombuffer(r["s"]).reshape(size, dim) for r in rows), np.zeros((size, dim)))
    return counts, sums, float(sum(r["e"] for r in rows))


def train_codebooks(vectors: DataFrame, column: str, levels: int, size: int, rounds: int = 8, order: str = "id", seed: int = 42) -> tuple[list[np.ndarray], list[float]]:
    """Residual k-means: (one codebook per level, mean squared error after each level).

    Starts from a seeded draw of ``size`` rows; every round is one pass over all rows.
    A code without rows is set to a far row of the draw.
    """
    draw = vectors.select(order, column).orderBy(F.xxhash64(F.lit(seed), order), order).limit(size).collect()
    if not draw:
        raise ValueError("no vectors")
    start = np.array([r[column] for r in draw], np.float64)
    n = vectors.count()
    books: list[np.ndarray] = []
    errors: list[float] = []
    for _ in range(levels):
        book = np.resize(start, (size, start.shape[1])).copy()
        for _ in range(rounds):
            counts, sums, _ = code_sums(vectors, column, [*books, book])
            filled = counts > 0
            book[filled] = sums[filled] / counts[filled, None]
            empty = np.flatnonzero(~filled)
            if len(empty):
                gap = start - book[nearest_codes(start, book)]
                far = np.argsort(-(gap * gap).sum(1))
                book[empty] = start[far[np.arange(len(empty)) % len(far)]]
        _, _, error = code_sums(vectors, column, [*books, book])
        books.append(book)
        errors.append(error / max(1, n))
        start = start - book[nearest_codes(start, book)]
    return books, errors


def ema_update(book: np.ndarray, cluster_size: np.ndarray, sums: np.ndarray, counts: np.ndarray, batch_sums: np.ndarray, decay: float = 0.99, eps: float = 1e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moving averages of counts and sums, and the codebook with smoothed counts."""
    cluster_size = cluster_size * decay + counts * (1 - decay)
    sums = sums * decay + batch_sums * (1 - decay)
    total = cluster_size.sum()
    smooth = (cluster_size + eps) / (total + len(book) * eps) * total
    return sums / smooth[:, None], cluster_size, sums


def code_usage(codes: DataFrame, column: str, size: int) -> DataFrame:
    """One row: codes used, their share of the codebook in percent, and the perplexity (0 of none)."""
    counts = codes.select(F.explode(column).alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    p = F.col("n") / F.col("total")
    joined = counts.crossJoin(total)  # the total is one row
    return joined.agg(F.count("*").alias("used"), (F.count("*") * 100.0 / size).alias("used_pct"), F.coalesce(F.exp(-F.sum(p * F.log(p))), F.lit(0.0)).alias("perplexity"))


def code_histogram(codes: DataFrame, column: str) -> DataFrame:
    """(code, n) over all levels."""
    return codes.select(F.explode(column).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def vocabulary(spark: SparkSession, levels: int, size: int, special: Sequence[str]) -> DataFrame:
    """(token_id, token, kind): special tokens, each once, then the tokens of every level."""
    names = list(dict.fromkeys(t.strip() for t in special if t.strip()))
    first = spark.createDataFrame([(i, t, "special") for i, t in enumerate(names)], "token_id long, token string, kind string")
    n = F.col("id")
    level = F.concat(F.lit("<L"), (F.floor(n / size) + 1).cast("string"), F.lit("_"), (n % size).cast("string"), F.lit(">"))
    return first.unionByName(spark.range(levels * size).select((n + len(names)).alias("token_id"), level.alias("token"), F.lit("level").alias("kind")))


def token_counts(rows: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(token, n) of the tokens in use."""
    return rows.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def mean_rows(codes: DataFrame, key: str, column: str, book: DataFrame) -> DataFrame:
    """(key, mean): mean of the codebook rows (code, vector) that an item's codes name."""
    parts = codes.select(key, F.explode(column).alias("code")).join(book, "code").select(key, F.posexplode("vector").alias("i", "v"))
    means = parts.groupBy(key, "i").agg(F.avg("v").alias("v"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("mean"))


def ridge_fit(pairs: DataFrame, x: str, y: str, penalty: float = 1e-3, least: int = 32) -> tuple[np.ndarray, int, float]:
    """(weights, rows, mean squared error) of the ridge regression of ``y`` on ``x``, both arrays.

    Gram matrices are summed per partition and then sixteen at a time; the driver
    solves one small system.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch, x), _matrix(batch, y)
                own = [a.T @ a, a.T @ b, (b * b).sum(), float(len(a))]
                total = own if total is None else [s + t for s, t in zip(total, own, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([_part(), pa.array([total[0].tobytes()]), pa.array([total[1].tobytes()]), pa.array([total[2]]), pa.array([total[3]])], names=["part", "xx", "xy", "yy", "n"])

    rows = _added_up(pairs.select(x, y).mapInArrow(run, "part int, xx binary, xy binary, yy double, n double"), pairs.rdd.getNumPartitions())
    n = int(sum(r["n"] for r in rows))
    if n < least:
        raise ValueError(f"{n} rows are too few for a fit")
    d = math.isqrt(len(rows[0]["xx"]) // 8)
    xx = sum(np.frombuffer(r["xx"]).reshape(d, d) for r in rows)
    xy = sum(np.frombuffer(r["xy"]).reshape(d, -1) for r in rows)
    yy = sum(r["yy"] for r in rows)
    w = np.linalg.solve(xx + penalty * np.eye(d), xy)
    error = (yy - 2 * (w * xy).sum() + (w * (xx @ w)).sum()) / (n * xy.shape[1])
    return w, n, float(error)


def weighted_means(batches: DataFrame, weight: str, values: Sequence[str]) -> DataFrame:
    """Means of the values weighted by batch size; an error if there is nothing or a value is not finite."""
    bad = F.exists(F.array(*[F.col(v).cast("double") for v in values]), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    total = F.sum(weight)
    checked = F.when(F.coalesce(F.bool_or(bad), F.lit(True)), F.raise_error(F.lit("a batch value is not finite, or there is no batch"))).otherwise(total)
    return batches.agg(checked.cast("double").alias("weight"), *[(F.sum(F.col(v) * F.col(weight)) / total).alias(v) for v in values])
