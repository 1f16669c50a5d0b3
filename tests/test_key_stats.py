import random
from collections import defaultdict

from pyspark.sql import functions as F

from seqloom.operators.key_stats import heavy_keys, key_stats


def brute(data):
    out = {}
    for name, k, o in (("a", 0, 1), ("b", 1, 0)):
        n, others, values = defaultdict(int), defaultdict(set), defaultdict(list)
        for r in data:
            if r[k] is not None:
                n[r[k]] += 1
                others[r[k]] |= {r[o]} - {None}
                values[r[k]] += [r[2]] if r[2] is not None else []
        out |= {(name, x): (n[x], len(others[x]), sum(values[x]) / len(values[x]) if values[x] else None) for x in n}
    return out


def test_against_brute_force_with_a_hot_key(spark):
    random.seed(1)
    keys = [None, 0, -1, 5, 4095, 4096, 2**40, -(2**50)] + list(range(100, 160))
    data = [(random.choice(keys), random.choice(keys), random.choice([None, 1, 7, 10])) for _ in range(3000)] + [(7, i % 40, 3) for i in range(2500)]
    df = spark.createDataFrame(data, "a bigint, b bigint, s int").withColumn("n_rows", F.lit("clash"))
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in key_stats(df.repartition(5), "a", "b", F.col("s")).collect()}
    want = brute(data)
    assert got.keys() == want.keys()
    for k, (n, d, m) in want.items():
        assert got[k][:2] == (n, d)
        assert (got[k][2] is None) == (m is None) and (m is None or abs(got[k][2] - m) < 1e-9)
    heavy = {tuple(r) for r in heavy_keys(key_stats(df, "a", "b"), len(data), 0.3).select("key_field", "key_value").collect()}
    assert heavy == {k for k, v in want.items() if v[0] >= 0.3 * len(data)}


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert key_stats(empty, "a", "b").count() == 0
    assert heavy_keys(key_stats(empty, "a", "b"), 0, 0.02).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, 3)], "a bigint, b bigint")
    assert [tuple(r) for r in key_stats(nulls, "a", "b").collect()] == [("b", 3, 1, 0, None)]
