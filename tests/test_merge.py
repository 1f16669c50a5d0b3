from pyspark.sql import functions as F

from seqloom.operators import merge


def test_first_writer_wins_per_row(spark, rows):
    df = spark.createDataFrame([(1, 0, "a", None), (1, 1, "b", "x"), (2, 2, None, "y"), (None, 3, "z", "z")], "k bigint, seq int, v string, w string")
    assert rows(merge.first_writer(df, ["k"], [F.col("seq")])) == sorted([(1, 0, "a", None), (2, 2, None, "y")], key=repr)


def test_insert_or_ignore_counts_new_rows(spark, rows):
    have = spark.createDataFrame([(1, "old")], "k bigint, v string")
    come = spark.createDataFrame([(1, "new", 0), (2, "b", 2), (2, "a", 1)], "k bigint, v string, seq int")
    table, fresh = merge.insert_or_ignore(have, come, ["k"], [F.col("seq")])
    assert rows(table) == [(1, "old"), (2, "a")]
    assert fresh.count() == 1


def test_two_unique_keys(spark, rows):
    have = spark.createDataFrame([(1, "ann", 0)], "user_id bigint, username string, seq int")
    come = spark.createDataFrame([(1, "bob", 1), (2, "ann", 2), (3, "cid", 3), (4, "cid", 4), (4, "dan", 5), (5, "eve", 6)], have.schema)
    got = merge.insert_or_ignore_two_keys(have, come, "user_id", "username", [F.col("seq")])
    assert rows(got.select("user_id", "username")) == [(1, "ann"), (3, "cid"), (4, "dan"), (5, "eve")]


def test_upsert_takes_the_last_version(spark, rows):
    have = spark.createDataFrame([(1, 5, "old"), (2, 5, "kept")], "k bigint, ver int, v string")
    come = spark.createDataFrame([(1, 6, "new"), (2, 4, "late"), (3, 1, None)], have.schema)
    assert rows(merge.upsert(have, come, ["k"], [F.col("ver")])) == sorted([(1, 6, "new"), (2, 5, "kept"), (3, 1, None)], key=repr)
    again = merge.upsert(merge.upsert(have, come, ["k"], [F.col("ver")]), come, ["k"], [F.col("ver")])
    assert again.count() == 3


def test_progress_and_state(spark, rows):
    df = spark.createDataFrame([(1, -3, True, "t"), (2, 4, None, "t")], "k bigint, page int, done boolean, at string")
    assert rows(merge.progress_rows(df, "k", "page", "done", "at")) == [(1, 0, 1, "t"), (2, 4, 0, "t")]
    state = spark.createDataFrame([("a", "7"), ("b", "x")], "key string, value string")
    assert merge.state_value(state, "a").first()[0] == 7
    assert merge.state_value(state, "b", 3).first()[0] == 3
    assert merge.state_value(state, "none").first()[0] == 0
    assert rows(merge.drop_state(state, ["a"])) == [("b", "x")]
    scans = spark.createDataFrame([(9, "t")], "club_id bigint, scanned_at string")
    assert rows(merge.completed_scans(scans)) == [(9, 0, 1, "t")]


def test_missing_items_and_pending(spark, rows):
    seen = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "anime_id bigint")
    have = spark.createDataFrame([(1,)], "anime_id bigint")
    done = spark.createDataFrame([(3, 1), (2, 0)], "anime_id bigint, completed int")
    assert rows(merge.missing_items(seen, have, done)) == [(2,)]
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    progress = spark.createDataFrame([(1, 2, 1), (2, 5, 0)], "user_id bigint, last_page int, completed int")
    assert rows(merge.pending(users, progress, "user_id")) == [(2, 5, 0), (3, 0, 0)]
    assert rows(merge.pending(users, progress, "user_id", 1)) == [(2, 5, 0)]
    assert merge.total_members(spark.createDataFrame([], "club_id bigint, members bigint")).first()[0] == 0


def test_chains_of_clashes_are_settled_to_the_end(spark, rows):
    pairs = [(k // 2 + 1, chr(65 + (k + 1) // 2)) for k in range(21)]  # (1,A), (1,B), (2,B), (2,C), ...
    come = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "seq int, user_id bigint, username string")
    got = merge.insert_or_ignore_two_keys(None, come, "user_id", "username", [F.col("seq")])
    assert rows(got) == sorted([(i, a, b) for i, (a, b) in enumerate(pairs) if i % 2 == 0], key=repr)
