import pytest
from pyspark.sql import functions as F

from seqloom.functions import text as t
from seqloom.functions.instants import instant_micros
from seqloom.functions.vectors import has_non_finite, level_tokens, norm, parse_level_token, unit, vector_from_bytes, vector_to_bytes


@pytest.fixture
def one(spark):
    def run(value, fn, kind="string"):
        return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("x")).first()[0]

    return run


@pytest.mark.parametrize(("value", "want"), [
    ("  Name;With ; Delimiters  ", "Name,With , Delimiters"), (" \tEnglish\nName ", "English Name"), ("Action;\nComedy", "Action, Comedy"), (" nan ", None), (" none ", None), ("NULL", None),
    ("", None), (None, None), ("a 　b\x1cc\x85d", "a b c d"), ("Unknown", "Unknown"),
])
def test_catalogue_text(one, value, want):
    assert one(value, t.catalogue_text) == want


def test_unknown_is_null_where_asked(one):
    assert one(" UNKNOWN ", lambda v: t.catalogue_text(v, True)) is None
    assert one("n/a", lambda v: t.catalogue_text(v, True)) is None


@pytest.mark.parametrize(("value", "whole", "strict", "score"), [
    ("20.8", 20, None, None), ("-7", None, None, None), ("-0.5", 0, None, None), ("not-a-number", None, None, None), ("8.75", 8, None, 8.75), ("11.5", 11, None, None), ("1d", None, None, None),
    ("1_000", None, None, None), (" 12 ", 12, 12, None), ("1e999", None, None, None), ("NaN", None, None, None), ("0", 0, 0, 0.0), ("10", 10, 10, 10.0), (None, None, None, None), ("7.", 7, None, 7.0),
])
def test_numbers(one, value, whole, strict, score):
    assert one(value, t.nonnegative_int) == whole
    assert one(value, t.strict_nonnegative_int) == strict
    assert one(value, t.score) == score


@pytest.mark.parametrize(("value", "want"), [("on-hold", 3), (" Plan_To watch ", 6), ("COMPLETED", 2), ("4", 4), ("-1", 9), ("?", 9), (None, 9)])
def test_status(one, value, want):
    assert one(value, lambda v: t.status_code(v, 9)) == want


@pytest.mark.parametrize(("value", "want"), [(None, "Unknown"), (8.75, "8.75"), (10.0, "10"), (0.0, "0"), (0.5, "0.5"), (100.0, "100")])
def test_format(one, value, want):
    assert one(value, lambda v: t.format_value(v, "double"), "double") == want


@pytest.mark.parametrize(("value", "want"), [([], ""), (["a"], "a"), (["a", "b"], "a and b"), (["a", "b", "c"], "a, b, and c")])
def test_phrases(one, value, want):
    assert one(value, t.join_phrases, "array<string>") == want


def test_lists(one):
    assert one(" A; b ,,A, c", t.split_list) == ["A", "b", "c"]
    assert one("A, a ,B", t.genre_set) == ["a", "b"]
    assert one(None, t.split_list) == []
    assert one("w, x, y, z", t.leading_themes) == "w, x, y"
    assert one("/a", lambda v: t.join_url("http://h/", v)) == "http://h/a"


@pytest.mark.parametrize(("value", "want"), [
    ("1970-01-01T00:00:01+00:00", 10**6), ("1970-01-01T00:00:01Z", 10**6), ("1970-01-01 00:00:01", 10**6), ("1970-01-01T09:00:01+09:00", 10**6), ("1970-01-01T00:00:01.5-00:00", 1_500_000),
    ("1970-01-02", 86_400 * 10**6), ("soon", None), (None, None), ("", None),
])
def test_instants(one, value, want):
    assert one(value, instant_micros) == want


def test_vectors(one, spark):
    assert one([3.0, 4.0], norm, "array<float>") == 5.0
    assert one([3.0, 4.0], unit, "array<float>") == pytest.approx([0.6, 0.8])
    assert one([0.0], unit, "array<float>") == [0.0]
    assert one([1.0, float("nan")], has_non_finite, "array<float>") and one(None, has_non_finite, "array<float>") and not one([1.0], has_non_finite, "array<float>")
    df = spark.createDataFrame([([1.0, 1.5],), (None,)], "v array<float>")
    assert [r[0] for r in df.select(vector_from_bytes(vector_to_bytes("v"))).collect()] == [[1.0, 1.5], None]
    assert one([4, 0], level_tokens, "array<int>") == ["<L1_4>", "<L2_0>"]
    assert tuple(one("<L3_17>", parse_level_token)) == (3, 17)
    assert one("<L3_>", parse_level_token) is None
