"""Import of a folder of CSV files, with first-writer-wins per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.merge import first_writer
from seqloom.sources.readers import CATALOGUE_FILES, LIST_FILES, derived_users, find_file, imported_catalogue, imported_list, ranked_union, read_csv

_ORDER = ("source_rank", "source_row")


def bootstrap(spark: SparkSession, folder: str, at: str) -> dict[str, DataFrame]:
    """Tables anime, user_anime, users and user_animelist_progress of an import folder.

    Files rank in a fixed order; the first row of a key wins whole, also where a
    later file knows more columns. Files that are absent or lack their key columns
    are passed over; without any, the table is missing from the result.
    """
    out: dict[str, DataFrame] = {}
    order = [F.col(c) for c in _ORDER]
    catalogue = [imported_catalogue(read_csv(spark, p), at) for n in CATALOGUE_FILES if (p := find_file(folder, n))]
    if (rows := ranked_union([x for x in catalogue if x is not None])) is not None:
        out["anime"] = first_writer(rows, ["anime_id"], order).drop(*_ORDER)
    lists = [imported_list(read_csv(spark, p), status, at) for n, status in LIST_FILES if (p := find_file(folder, n))]
    if (rows := ranked_union([x for x in lists if x is not None])) is not None:
        out["user_anime"] = first_writer(rows, ["user_id", "anime_id"], order).drop(*_ORDER)
        out["users"], out["user_animelist_progress"] = derived_users(out["user_anime"], at)
    return out
