import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom import cli
from seqloom.operators import codebooks, neighbours
from seqloom.operators.validation import require_vectors
from seqloom.plans import artefacts

AT = "2024-01-01T00:00:00+00:00"


@pytest.fixture
def items(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f"Name {i}", None if i % 5 == 0 else f"E {i}", "Action, Drama" if i % 2 else "drama", [float(x) for x in rng.normal(size=6)]) for i in range(1, 41)]
    return spark.createDataFrame(rows, "anime_id bigint, name string, english_name string, genres string, embedding array<double>")


def documents(folder):
    return {n: json.load(open(f"{folder}/{n}")) for n in os.listdir(folder) if n.endswith(".json")}


def test_a_tokenisation_leaves_its_artefacts(spark, items, tmp_path):
    books, _ = codebooks.train_codebooks(items, "embedding", 3, 4, 3, order="anime_id")
    log = spark.createDataFrame([(u, i, 9, 2) for u in range(12) for i in range(1, 9)], "user_id bigint, anime_id bigint, score int, watching_status int")
    settings = artefacts.TokeniseSettings(rebuild=True, cluster_min_bucket=3, recall_min_support=5, recall_k=4)
    os.makedirs(f"{tmp_path}/semantic_ids.jsonl")
    (tmp_path / "semantic_ids.jsonl" / "old").write_text("x")
    (tmp_path / "notes.txt").write_text("kept")
    summary = artefacts.tokenise_run(items, books, str(tmp_path), AT, log, settings)
    assert (tmp_path / "notes.txt").read_text() == "kept" and not (tmp_path / "semantic_ids.jsonl" / "old").exists()
    assert {n for n in os.listdir(tmp_path) if not n.startswith(".")} == {*artefacts.MANAGED, "notes.txt"}
    docs = documents(tmp_path)
    vocab = docs["semantic_vocab.json"]
    assert vocab["vocab_size"] == 6 + 12 == len(vocab["token_to_id"]) and vocab["tokens"][vocab["token_to_id"]["<L2_3>"]] == "<L2_3>"
    assert docs["token_stats.json"]["observed_token_total"] == 120 and docs["special_tokens.json"]["special_tokens"] == vocab["special_tokens"]
    assert summary["row_count"] == 40 and docs["tokenize_run_summary.json"]["cluster_summary"] == docs["cluster_summary.json"]
    assert docs["recall_report.json"]["status"] == "ok" and docs["recall_report.json"]["evaluated_queries"] == 8
    assert spark.read.json(f"{tmp_path}/semantic_ids.jsonl").count() == 40
    inspected = [json.loads(r[0]) for r in spark.read.text(f"{tmp_path}/cluster_inspection.jsonl").collect()]
    assert inspected and all(len(r["samples"]) == min(10, r["bucket_size"]) for r in inspected)
    few = artefacts.tokenise_run(items, books, f"{tmp_path}/few", AT, None, artefacts.TokeniseSettings(limit=5))
    assert few["row_count"] == 5 and few["recall_summary"]["status"] == "skipped" and few["cluster_summary"]["global_avg_genre_jaccard"] is None


def test_recall_is_skipped_for_three_reasons(spark):
    codes = spark.createDataFrame([(i, [i % 3, i % 2]) for i in range(1, 7)], "anime_id bigint, codes array<int>")
    schema = "user_id bigint, anime_id bigint, score int, watching_status int"
    settings = artefacts.TokeniseSettings(recall_min_support=2)
    few = spark.createDataFrame([(1, 1, 9, 2)], schema)
    alone = spark.createDataFrame([(u, 1, 9, 2) for u in range(3)], schema)  # no other item shares a user
    got = [artefacts.recall_document(log, codes, settings) for log in (None, few, alone)]
    assert [g["status"] for g in got] == ["skipped"] * 3 and len({g["reason"] for g in got}) == 3
    assert got[1]["total_positive_users"] == 1 and got[2]["eligible_queries"] == 1


def test_faulty_vectors_are_named(spark):
    df = spark.createDataFrame([(3, [1.0, 2.0]), (2, [1.0]), (1, None), (9, [float("nan"), 0.0])], "id bigint, v array<double>")
    with pytest.raises(ValueError, match="1, 2, 9$"):
        require_vectors(df, "id", "v")
    with pytest.raises(ValueError, match="no vectors"):
        require_vectors(df.limit(0), "id", "v")
    assert require_vectors(df.where("id = 3"), "id", "v").count() == 1


def test_sums_are_alike_for_many_partitions(spark, items):
    book = np.random.default_rng(2).normal(size=(4, 6))
    few, many = (codebooks.code_sums(items.repartition(n), "embedding", [book]) for n in (2, 37))
    assert np.array_equal(few[0], many[0]) and np.allclose(few[1], many[1]) and few[2] == pytest.approx(many[2])


def test_global_purity_leaves_out_buckets_without(spark):
    purity = spark.createDataFrame([("a", 3, 0.5), ("b", 3, None), ("c", 4, 0.25)], "first_token string, bucket_size bigint, avg_genre_jaccard double")
    assert tuple(neighbours.global_purity(purity).first()) == (3, 0.375)
    assert tuple(neighbours.global_purity(purity.limit(0)).first()) == (0, None)


def test_steps_of_the_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "local_session", lambda *a, **k: spark)
    data = tmp_path / "in"
    rows = [(i, f"Name {i}", f"E {i}", "Action, Drama", f"Plot {i}", "House", 2000 + i, "spring", "TV", "Original", f"text of title {i} word{i % 4}") for i in range(1, 31)]
    prep = spark.createDataFrame(rows, "anime_id bigint, name string, english_name string, genres string, synopsis string, studios string, year bigint, premiered string, type string, source string, anime_text string")
    prep.write.parquet(f"{data}/anime_prep.parquet")
    log = spark.createDataFrame([(u, i, 9, 2, 12, AT) for u in range(1, 8) for i in range(1, 7)], "user_id bigint, anime_id bigint, score int, watching_status int, watched_episodes int, scraped_at string")
    log.write.parquet(f"{data}/user_anime.parquet")
    assert cli.main(["embed", "--in", str(data), "--out", str(data), "--dim", "16"]) == 0
    assert cli.main(["codebooks", "--in", str(data), "--out", str(data), "--levels", "2", "--codes", "4"]) == 0
    assert cli.main(["tokenise", "--in", str(data), "--out", str(tmp_path / "ids"), "--codebooks", f"{data}/codebooks.parquet", "--rebuild"]) == 0
    assert documents(tmp_path / "ids")["tokenize_run_summary.json"]["row_count"] == 30
    ids = spark.read.json(f"{tmp_path}/ids/semantic_ids.jsonl").select("anime_id", "semantic_id", F.lit(AT).alias("tokenized_at"))
    summary = artefacts.training_run(spark.read.parquet(f"{data}/user_anime.parquet"), ids, prep, str(tmp_path / "set"), AT, artefacts.PrepSettings(target_examples=40))
    assert summary["counts"] == summary["quotas"] == {"task_a": 20, "task_b": 10, "task_c": 10} and summary["pool_sizes"]["task_b_pool"] == 14
    assert summary["task_c_stats"] == {"single": 7, "triple": 7} and summary["stream_stats"]["users_scanned"] == 7
    assert documents(tmp_path / "set")["prep_manifest.json"]["config"]["target_examples"] == 40
