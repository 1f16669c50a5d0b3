"""Incremental ingest: page files as a stream, merged batch by batch.

The checkpoint keeps the offsets, so a run resumes where the last one ended; each
batch is merged by key, so a batch that is delivered twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seqloom.operators.merge import upsert


def page_stream(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """Files of a folder as a stream, in the order in which they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(path)


class TableStore:
    """A parquet table under one path that batches are merged into by key.

    A batch is written as a delta of its own rows, so its cost does not grow with the
    table; after ``most_deltas`` of them base and deltas are merged into a new base. A
    reader sees the newest complete base and the complete deltas after it, the highest
    version of each key winning; a batch that fails leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), version: Sequence[Column] = (), most_deltas: int = 8) -> None:
        self.spark, self.path, self.keys, self.order, self.most_deltas = spark, path.rstrip("/"), list(keys), list(version), most_deltas

    def _file(self, name: str = ""):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _complete(self, kind: str) -> list[int]:
        fs, p = self._file()
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        found = [n for n in names if n[:1] == kind and n[1:].isdigit()]
        return sorted(int(n[1:]) for n in found if fs.exists(self._file(f"{n}/_SUCCESS")[1]))

    def version(self) -> int:
        """Number of the newest base or delta, -1 of an empty store."""
        return max([*self._complete("v"), *self._complete("d")], default=-1)

    def _parts(self) -> list[str]:
        base = max(self._complete("v"), default=-1)
        return ([f"v{base}"] if base >= 0 else []) + [f"d{n}" for n in self._complete("d") if n > base]

    def read(self) -> DataFrame | None:
        parts = self._parts()
        if not parts:
            return None
        if len(parts) > 1 and not self.keys:
            raise ValueError("a store with deltas is read by its keys")
        rows = self.spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{n}" for n in parts])
        return rows if len(parts) == 1 else upsert(None, rows, self.keys, self.order)

    def merge(self, incoming: DataFrame) -> None:
        """Adds the rows of a batch; the same batch again changes nothing."""
        n = self.version() + 1
        upsert(None, incoming, self.keys, self.order).write.mode("overwrite").parquet(f"{self.path}/d{n}")
        if len(self._parts()) > self.most_deltas:
            self.replace(self.read())

    def replace(self, df: DataFrame, keep: int = 2) -> None:
        """A new base; of the bases before it the last ``keep`` - 1 stay, with the deltas after them."""
        n = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{n}")
        bases = self._complete("v")
        if len(bases) > keep:
            fs, _ = self._file()
            oldest = bases[-keep]
            for name in [f"v{b}" for b in bases if b < oldest] + [f"d{d}" for d in self._complete("d") if d < oldest]:
                fs.delete(self._file(name)[1], True)


def upsert_stream(stream: DataFrame, store: TableStore, keys: Sequence[str], version: Sequence[Column], checkpoint_dir: str, rows: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge all that is there into the store, the highest version of each key winning, and stop."""
    store.keys, store.order = list(keys), list(version)

    def merge(batch: DataFrame, _: int) -> None:
        store.merge(batch if rows is None else rows(batch))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First row of each key among those at most ``delay`` apart."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, event_time: str, key: str, window: str, delay: str) -> DataFrame:
    """Rows per key and tumbling window, closed once the watermark has passed."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def page_progress(pages: DataFrame, key: str) -> DataFrame:
    """(key, last_page, completed, updated_at) from page rows (key, page, has_next, status, fetched_at).

    A key is complete after a page without a next one, or a final refusal (400, 403, 404);
    other refusals leave it open to be tried again.
    """
    ok = F.col("status") == 200
    last = F.max(F.when(ok, F.col("page")))
    done = F.bool_or((ok & ~F.coalesce("has_next", F.lit(False))) | F.col("status").isin(400, 403, 404))
    return pages.groupBy(key).agg(F.coalesce(last, F.lit(0)).cast("int").alias("last_page"), F.coalesce(done, F.lit(False)).cast("int").alias("completed"), F.max("fetched_at").alias("updated_at"))
