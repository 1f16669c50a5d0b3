import pytest
from pyspark.sql import functions as F

from seqloom.operators.packed_fields import explode_packed, known_names, split_packed

NAMES = ["Gods, Ghosts and Guests", "Rivals, Rematches", "Magic / Alchemy", "Myth & Folklore", 'Studio "Nine"', "O'Dell Animation", "Pine, Oak and Ash", "Pine, Oak", "A|R Pictures", "青い塔、映像", "Nimbus; Gate"]

CASES = [
    ("Action, Drama", ["Action", "Drama"]),
    ("  Action ; Drama|Space/日常、School・Music · Heist & Mecha and Sports ", ["Action", "Drama", "Space", "日常", "School", "Music", "Heist", "Mecha", "Sports"]),
    ("Gods, Ghosts and Guests, Drama", ["Gods, Ghosts and Guests", "Drama"]),
    ("gods, ghosts AND guests, drama", ["gods, ghosts AND guests", "drama"]),
    ("Rivals\\, Rematches, Heist", ["Rivals, Rematches", "Heist"]),
    ("['Vampire', 'Myth & Folklore']", ["Vampire", "Myth & Folklore"]),
    ('["Studio \\"Nine\\"", "Northlight"]', ['Studio "Nine"', "Northlight"]),
    ('"Studio ""Nine""", Tallow', ['Studio "Nine"', "Tallow"]),
    ('Tallow and Studio "Nine"', ["Tallow", 'Studio "Nine"']),
    ('{"Little Comet","O\'Dell Animation"}', ["Little Comet", "O'Dell Animation"]),
    ("“Pine, Oak and Ash”; Pine, Oak", ["Pine, Oak and Ash", "Pine, Oak"]),
    ("Thriller, Humor, and 日常", ["Thriller", "Humor", "日常"]),
    ("A, , B,", ["A", "B"]),
    ("A, A", ["A", "A"]),
    ("A|R Pictures|青い塔、映像|Nimbus; Gate", ["A|R Pictures", "青い塔、映像", "Nimbus; Gate"]),
    ('"Unlisted, Name and Co" / X', ["Unlisted, Name and Co", "X"]),
    ("Sandra, Band", ["Sandra", "Band"]),
    *[(x, []) for x in (None, "", "   ", "Unknown", "NONE", "n/a", " - ", "NaN", "None Listed")],
]


def test_cases(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "i int, v string")
    got = {r[0]: r[1] for r in df.select("i", split_packed(F.col("v"), NAMES).alias("x")).collect()}
    assert [got[i] for i in range(len(CASES))] == [x for _, x in CASES]


def test_rows_positions_and_clashing_columns(spark, rows):
    df = spark.createDataFrame([(1, "A, B", None, "x"), (None, "C", "D", "y"), (1, "A, B", None, "x")], "id bigint, genres string, studios string, pos string")
    got = rows(explode_packed(df, "id", ["genres", "studios"]))
    assert got == sorted([(1, "genres", 0, "A"), (1, "genres", 1, "B")] * 2 + [(None, "genres", 0, "C"), (None, "studios", 0, "D")], key=repr)


def test_long_and_empty(spark):
    long = ", ".join(f"n{i}" for i in range(20_000))
    df = spark.createDataFrame([(1, long)], "id bigint, genres string")
    assert explode_packed(df, "id", ["genres"]).count() == 20_000
    assert explode_packed(df.limit(0), "id", ["genres"]).count() == 0


def test_names_table_is_bounded(spark):
    names = spark.createDataFrame([("genres", "A"), ("genres", "A"), (None, "B"), ("studios", None)], "field_name string, full_name string")
    assert known_names(names) == {"genres": ["A"]}
    with pytest.raises(ValueError):
        known_names(spark.range(3).selectExpr("'f' field_name", "cast(id as string) full_name"), most=2)
