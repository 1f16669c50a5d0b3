import json

import pytest

from seqloom.plans.ingest import bootstrap
from seqloom.schemas import TABLES, conform
from seqloom.sources import readers, writers

AT = "2024-01-01T00:00:00+00:00"


def test_bootstrap_of_a_folder(spark, tmp_path, rows):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "Anime_With_Synopsis.csv").write_text("MAL_ID,Name,Score,Genres,sypnopsis\n1,One,8.5,\"Action, Drama\",text\n0,Bad,1,x,y\n")
    (tmp_path / "anime.csv").write_text("MAL_ID,Name,Score,Episodes,Studios,Members\n1,Other,1.0,12,House,nan\n2, Two ,bad,12.9,nan,5\n")
    (tmp_path / "animelist.csv").write_text("user_id,anime_id,rating,watching_status,watched_episodes\n1,1,9,2,12\n1,1,3,1,1\n2,1,-4,on-hold,x\n-1,1,5,2,1\n")
    (tmp_path / "rating_complete.csv").write_text("user_id,anime_id,rating\n1,2,7\n1,1,10\n")
    got = bootstrap(spark, str(tmp_path), AT)
    anime = {r["anime_id"]: r for r in got["anime"].collect()}
    assert set(anime) == {1, 2}
    assert (anime[1]["name"], anime[1]["studios"], anime[1]["episodes"]) == ("One", None, None)  # the first file wins whole
    assert (anime[2]["name"], anime[2]["score"], anime[2]["episodes"], anime[2]["studios"], anime[2]["members"]) == ("Two", None, 12, None, 5)
    assert rows(got["user_anime"].drop("scraped_at")) == [(1, 1, 9, 2, 12), (1, 2, 7, 2, 0), (2, 1, 0, 3, 0)]
    assert rows(got["users"].select("user_id", "username")) == [(1, "kaggle_user_1"), (2, "kaggle_user_2")]
    assert bootstrap(spark, str(tmp_path / "sub"), AT).keys() == {"anime"}


def test_pages(spark, rows):
    page = {"data": [{"anime": {"mal_id": 5}, "score": 8, "status": "Completed", "episodes_watched": 3}, {"mal_id": 6, "score": "x", "status": None, "watched_episodes": 2}, {"score": 1}], "pagination": {"has_next_page": False}}
    df = spark.createDataFrame([(1, "t", json.dumps(page)), (2, "t", "{}"), (3, "t", None)], "user_id bigint, scraped_at string, body string")
    assert rows(readers.list_page_rows(df, "body")) == [(1, 5, 8, 2, 3, "t"), (1, 6, 0, 0, 2, "t")]
    members = {"data": [{"username": " ann "}, {"user": {"username": "bob"}}, {"username": ""}]}
    df = spark.createDataFrame([(7, "t", json.dumps(members))], "club_id bigint, discovered_at string, body string")
    assert rows(readers.member_page_rows(df, "body")) == [("ann", 7, "t"), ("bob", 7, "t")]
    clubs = {"data": [{"mal_id": 3, "members": 40}, {"members": 2}]}
    assert rows(readers.club_page_rows(spark.createDataFrame([("t", json.dumps(clubs))], "discovered_at string, body string"), "body")) == [(3, 40, "t")]


def test_payloads(spark):
    body = {"data": {"mal_id": 4, "title": " T ", "episodes": 0, "season": "fall", "year": 0, "members": 3, "genres": [{"name": "A"}, {"name": " "}, {"name": "A"}], "demographics": [{"name": "B"}], "studios": []}}
    df = spark.createDataFrame([(json.dumps(body),), ('{"data": {"mal_id": 0}}',), ("broken",)], "body string")
    (r,) = readers.payload_rows(df, "body", AT).collect()
    assert (r["anime_id"], r["name"], r["episodes"], r["premiered"], r["members"], r["genres"], r["studios"]) == (4, "T", None, "fall", 3, "A, B", None)


def test_json_lines_round_trip(spark, tmp_path):
    rows = [{"anime_id": 1, "semantic_id": "a", "tokens": ["<L1_1>"], "codes": [1]}, {"anime_id": 1, "semantic_id": " b ", "name": "N"}]
    (tmp_path / "s.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    (r,) = readers.semantic_rows(spark, str(tmp_path / "s.jsonl")).collect()
    assert (r["semantic_id"], r["name"]) == ("b", "N")
    (tmp_path / "bad.jsonl").write_text('{"anime_id": 1, "semantic_id": " "}\n')
    with pytest.raises(Exception, match="empty semantic id"):
        readers.semantic_rows(spark, str(tmp_path / "bad.jsonl")).collect()
    writers.write_json_lines(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "out"))
    assert [json.loads(x) for p in (tmp_path / "out").glob("*.json") for x in p.read_text().splitlines()] == [{"a": 1}]


def test_exports_and_codebooks(spark, tmp_path):
    import numpy as np

    users = conform(spark.createDataFrame([(1, "u")], "user_id bigint, username string"), TABLES["users"])
    writers.export_tables({"users": users}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "users.parquet")).columns == TABLES["users"].fieldNames()
    books = [np.array([[1.0, 2.0], [3.0, 4.0]]), np.array([[0.5, 0.5], [0.0, 1.0]])]
    writers.write_codebooks(spark, books, str(tmp_path / "books"))
    assert all((a == b).all() for a, b in zip(books, writers.read_codebooks(spark, str(tmp_path / "books")), strict=True))
    writers.write_document({"a": 1}, str(tmp_path / "d" / "x.json"))
    assert json.loads((tmp_path / "d" / "x.json").read_text()) == {"a": 1}
    (tmp_path / "v.json").write_text('{"tokens": ["<a>", "<L1_0>"]}')
    assert [tuple(r) for r in readers.vocabulary_file(spark, str(tmp_path / "v.json")).collect()] == [(0, "<a>"), (1, "<L1_0>")]
