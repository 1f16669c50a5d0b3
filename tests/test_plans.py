import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom import config
from seqloom.operators import codebooks, instructions, neighbours, sampling, sequences
from seqloom.operators.validation import checked_vectors, invalid_vectors, require_rows
from seqloom.plans.catalogue import prepare_catalogue
from seqloom.plans import runs
from seqloom.plans.embed import HashingBackend, embed_texts
from seqloom.plans.tokenise import evaluate_recall
from seqloom.plans.training_set import PrepSettings, pools, training_set
from seqloom.streaming.pages import TableStore, deduplicated, page_stream, upsert_stream, windowed_counts

AT = "2024-01-01T00:00:00+00:00"


@pytest.fixture
def small(spark):
    """Six items, seven users with five rows each."""
    sem = spark.createDataFrame([(i, "".join(f"<L{n}_{i}>" for n in range(1, 9))) for i in range(1, 7)], "anime_id bigint, semantic_id string")
    cat = spark.createDataFrame(
        [(i, f"Name {i}", f"English {i}", "Action, Sci-Fi, Drama" if i % 2 else "Sci-Fi; Comedy", f"Plot {i}", "House", 2000 + i, "spring", "TV", "Original") for i in range(1, 7)],
        "anime_id bigint, name string, english_name string, genres string, synopsis string, studios string, year bigint, premiered string, type string, source string",
    )
    log = spark.createDataFrame([(u, i, s, st, w, AT) for u in range(1, 8) for i, s, st, w in ((1, 9, 2, 26), (2, 8, 2, 24), (3, 8, 2, 22), (4, 7, 2, 12), (5, 6, 1, 5))], "user_id bigint, anime_id bigint, score int, watching_status int, watched_episodes int, scraped_at string")
    return log, sem, cat


def test_catalogue_rows(spark):
    dirty = {"anime_id": "2", "name": "  Name;With ; Delimiters  ", "score": "11.5", "genres": "Action;\nComedy", "type": " TV ", "episodes": "-1", "rating": "null", "members": "not-a-number", "scored_by": "20.8", "score2": "x"}
    bare = {"anime_id": "3", "score": "6.5"}
    df = spark.createDataFrame([tuple(r.get(c) for c in dirty) for r in (dirty, bare)], ", ".join(f"{c} string" for c in dirty))
    a, b = prepare_catalogue(df, AT).orderBy("anime_id").collect()
    assert (a["name"], a["score"], a["genres"], a["episodes"], a["rating"], a["members"], a["scored_by"]) == ("Name,With , Delimiters", None, "Action, Comedy", None, None, None, 20)
    assert (b["name"], b["flag_missing_core"], b["flag_missing_synopsis"]) == ("Unknown", 1, 1)
    assert b["anime_text"].startswith("Anime ID: 3; Name: Unknown; English Name: Unknown; ") and "Score: 6.5; " in b["anime_text"] and b["anime_text"].endswith("Popularity: Unknown.")
    with pytest.raises(Exception, match="no valid id"):
        prepare_catalogue(spark.createDataFrame([("x",)], "anime_id string"), AT).collect()


def test_prompts(small):
    log, sem, cat = small
    p = pools(log, sem, cat)
    last = p["B"].where("meta.mask_mode = 'last' and user_id = 1").first()
    sid = lambda i: "".join(f"<L{n}_{i}>" for n in range(1, 9))
    assert last["input"] == (
        f"A user watched <anime_start>{sid(5)}<anime_end> <watch> then watched <anime_start>{sid(1)}<anime_end> <liked> then watched <anime_start>{sid(2)}<anime_end> <liked> "
        f"then watched <anime_start>{sid(3)}<anime_end> <liked> then watched <anime_start>[MASK]<anime_end>"
    )
    assert (last["output"], last["anime_ids"], last["meta"]["history_len"]) == (sid(4), [5, 1, 2, 3, 4], 5)
    assert (p["A"].count(), p["B"].count(), p["C"].count()) == (60, 14, 14)
    c = {r["meta"]["kind"]: r for r in p["C"].where("user_id = 1").collect()}
    assert c["single"]["output"] == "Action, Sci-Fi, and Drama, tv storytelling, and original-inspired worldbuilding"
    assert c["triple"]["output"] == "Sci-Fi themes, production style from House, closely aligned 2001-2003 era pacing, and tv storytelling rhythms"


def test_training_set_is_alike_for_any_partitioning(small, rows):
    log, sem, cat = small
    made = [rows(training_set(x, sem, cat, PrepSettings(target_examples=40, seed=123)).drop("meta")) for x in (log, log.repartition(3))]
    assert made[0] == made[1] and len(made[0]) == 40
    assert [sum(r[1] == t for r in made[0]) for t in "ABC"] == [20, 10, 10]
    assert len({r[0] for r in made[0]}) == 40
    with pytest.raises(ValueError):
        training_set(log.limit(0), sem, cat, PrepSettings(target_examples=40))


@pytest.mark.parametrize(("score", "status", "want"), [(9, 4, "<dropped>"), (7, 2, "<liked>"), (3, 2, "<disliked>"), (4, 2, "<watch>"), (0, 6, "<watch>"), (None, 1, "<watch>"), (8, None, "<liked>")])
def test_sentiment(spark, score, status, want):
    df = spark.createDataFrame([(score, status)], "s int, t int")
    assert df.select(sequences.sentiment(F.col("s"), F.col("t")).alias("x")).first()[0] == want


def test_short_history_still_gives_seeds(spark, small, rows):
    _, sem, _ = small
    log = spark.createDataFrame([(1, 1, 9, 2, 1, AT), (1, 2, 8, 2, 1, AT)], "user_id bigint, anime_id bigint, score int, watching_status int, watched_episodes int, scraped_at string")
    history = sequences.histories(log)
    assert history.where("valid").count() == 0
    assert rows(sequences.seeds(sequences.liked_items(history, log))) == [(1, "single", [1])]


def test_neighbours(spark, rows):
    pairs = {1: (1, 2, 3), 2: (1, 2, 4), 3: (1, 3, 5), 9: (6, 7, 8)}
    log = spark.createDataFrame([(u, i, 8, 2) for u, x in pairs.items() for i in x] + [(1, 4, 6, 2), (2, 5, 9, 1)], "user_id bigint, anime_id bigint, score int, watching_status int")
    edges = neighbours.positive_edges(log, None)
    near = neighbours.jaccard_neighbours(edges, edges.select("anime_id").distinct(), 20)
    got = {(r[0], r[1]): round(r[2], 6) for r in near.collect()}
    assert [got[1, x] for x in (2, 3, 4, 5)] == [round(2 / 3, 6), round(2 / 3, 6), round(1 / 3, 6), round(1 / 3, 6)]
    assert (got[2, 1], got[2, 4], got[2, 3], got[6, 7]) == (round(2 / 3, 6), 0.5, round(1 / 3, 6), 1.0)
    codes = spark.createDataFrame([(i, [i] * 8) for i in range(1, 9)] + [(20, [1] * 7 + [9])], "anime_id bigint, codes array<int>")
    top = rows(neighbours.code_neighbours(codes, codes.where("anime_id = 1"), 3))
    assert top == [(1, 2, 1.0, 0, 2), (1, 20, 0.125, 7, 1), (1, 3, 1.0, 0, 3)]
    recall, report = evaluate_recall(log, codes, 3, 1)
    assert report.first()["evaluated_queries"] == recall.count() == 8
    assert evaluate_recall(log.limit(0), codes)[1].first()["status"] == "skipped"


def test_codebooks(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(4, 6))
    data = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=6) * 0.05]) for i in range(200)]
    v = spark.createDataFrame(data, "id bigint, v array<double>").repartition(3)
    books, errors = codebooks.train_codebooks(v, "v", 3, 4, 5)
    assert errors[0] < 0.2 and errors[0] >= errors[1] >= errors[2]
    vocab = codebooks.vocabulary(spark, 2, 3, ["<a>", " <a> ", "", "<b>"])
    assert [r["token"] for r in vocab.orderBy("token_id").collect()] == ["<a>", "<b>", "<L1_0>", "<L1_1>", "<L1_2>", "<L2_0>", "<L2_1>", "<L2_2>"]
    assert codebooks.code_usage(spark.createDataFrame([], "c array<int>"), "c", 8).first()["perplexity"] == 0.0
    book, size, _ = codebooks.ema_update(np.ones((2, 1)), np.ones(2), np.ones((2, 1)), np.array([2.0, 0.0]), np.array([[4.0], [0.0]]), 0.5)
    assert size.tolist() == [1.5, 0.5] and book[0, 0] == pytest.approx(2.5 / 1.5, rel=1e-4)
    w, n, error = codebooks.ridge_fit(spark.range(50).selectExpr("array(1d, cast(id as double)) x", "array(3d + 2 * id) y"), "x", "y", 1e-9)
    assert n == 50 and w[:, 0] == pytest.approx([3, 2], rel=1e-5) and error < 1e-6
    with pytest.raises(ValueError):
        codebooks.ridge_fit(spark.range(3).selectExpr("array(1d) x", "array(1d) y"), "x", "y")
    with pytest.raises(Exception, match="not finite"):
        codebooks.weighted_means(spark.sql("select 1d w, double('nan') loss"), "w", ["loss"]).collect()


def test_sampling(spark, rows):
    pool = spark.range(7).withColumnRenamed("id", "k")
    got = sorted(r[1] for r in sampling.sample_to_quota(pool, 20, ["k"]).groupBy("k").count().collect())
    assert got == [2, 3, 3, 3, 3, 3, 3]
    assert rows(sampling.sample_to_quota(pool, 3, ["k"])) == rows(sampling.sample_to_quota(pool.repartition(5), 3, ["k"]))
    assert sampling.sample_to_quota(pool, 0, ["k"]).count() == 0
    with pytest.raises(ValueError):
        sampling.sample_to_quota(pool.limit(0), 1, ["k"])
    assert sampling.quotas(10, 0.5, 0.25) == {"A": 5, "B": 2, "C": 3}
    assert [sampling.split_sizes(n, 0.1) for n in (1, 4, 25)] == [1, 1, 2]
    assert sampling.validation_size(2, 0.9) == 1
    held = sampling.held_out(spark.range(50), 0.1, ["id"])
    assert rows(held.groupBy("part").count()) == [("eval", 5), ("train", 45)]
    totals = sampling.running_totals(spark.range(1, 101).withColumn("v", F.col("id")), "id", ("v",)).orderBy("id").collect()
    assert [r["v_before"] for r in totals] == [i * (i - 1) // 2 for i in range(1, 101)] and [r["place"] for r in totals] == list(range(100))


def test_instructions(spark):
    df = spark.createDataFrame([("  Do\n it ", "now ", " done ", None, None), (None, None, "x", "Why? ", "Because"), ("", "", "", "", "")], "instruction string, input string, output string, prompt string, response string")
    assert [tuple(r) for r in instructions.general_rows(df, "s").collect()] == [("GEN", "Do it\nnow", "done", "s"), ("GEN", "Why?", "Because", "s")]
    talk = spark.createDataFrame([([("system", "s"), ("human", " "), ("human", "hi  there"), ("gpt", "yo"), ("gpt", "no")],), ([("gpt", "x")],), (None,)], "conversations array<struct<from: string, value: string>>")
    assert [tuple(r)[1:3] for r in instructions.general_rows(talk, "s").collect()] == [("hi there", "yo")]
    said = spark.createDataFrame([([("user", "a"), ("assistant", "b")],)], "messages array<struct<role: string, content: string>>")
    assert [tuple(r)[1:3] for r in instructions.general_rows(said, "s").collect()] == [("a", "b")]
    with pytest.raises(Exception, match="unknown task"):
        instructions.domain_rows(spark.createDataFrame([("Z", "a", "b")], "task string, input string, output string")).collect()


def test_vectors_are_checked(spark, rows):
    df = spark.createDataFrame([(1, [1.0, 2.0], 2), (2, [1.0, float("nan")], 2), (3, None, 2), (4, [1.0], 2)], "k bigint, v array<float>, d int")
    assert rows(invalid_vectors(df, "k", "v", "d")) == [(2, "not finite"), (3, "missing"), (4, "length")]
    with pytest.raises(Exception, match="faulty vector of 2"):
        checked_vectors(df.where("k < 3"), "k", "v", 2).collect()
    with pytest.raises(ValueError):
        require_rows(df, 5)


def test_embedding(spark):
    class Broken:  # local, so that workers need not import this file
        def __init__(self, vectors):
            self.vectors = vectors

        def embed_texts(self, texts):
            return self.vectors

    df = spark.createDataFrame([(1, "a b", "p"), (2, None, None)], "id bigint, t string, prepared_at string").coalesce(1)
    a, b = embed_texts(df, "id", "t", HashingBackend(16), "m", AT).orderBy("anime_id").collect()
    assert (len(a["embedding"]), a["embedding_dim"], a["source_prepared_at"]) == (16, 16, "p") and set(b["embedding"]) == {0.0}
    for vectors, message in (([[1.0]], "1 vectors for 2"), ([[1.0], [float("nan")]], "not finite"), ([[1.0], [1.0, 2.0]], "several lengths")):
        with pytest.raises(Exception, match=message):
            embed_texts(df, "id", "t", Broken(vectors), "m", AT).collect()


def test_streams(spark, tmp_path, rows):
    schema = "k bigint, ver int, v string"
    store = TableStore(spark, str(tmp_path / "table"))
    for batch in ([(1, 1, "a"), (2, 1, "b")], [(1, 3, "c"), (1, 2, "late"), (3, 1, None)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        upsert_stream(page_stream(spark, str(tmp_path / "in"), schema), store, ["k"], [F.col("ver")], str(tmp_path / "offsets")).awaitTermination()
    assert rows(store.read()) == sorted([(1, 3, "c"), (2, 1, "b"), (3, 1, None)], key=repr)
    events = spark.createDataFrame([("2024-01-01 00:00:01", 1), ("2024-01-01 00:00:02", 1), ("2024-01-01 00:20:00", 2)], "t string, k int").selectExpr("cast(t as timestamp) t", "k")
    events.coalesce(1).write.parquet(str(tmp_path / "ev"))
    for frame, name in ((deduplicated(page_stream(spark, str(tmp_path / "ev"), events.schema), ["k"], "t", "1 minute"), "d"), (windowed_counts(page_stream(spark, str(tmp_path / "ev"), events.schema), "t", "k", "10 minutes", "1 minute"), "w")):
        frame.writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
    assert spark.sql("select k from d order by k").count() == 2
    assert [(r["k"], r["n"]) for r in spark.sql("select * from w").collect()] == [(1, 2)]


def test_batches_are_deltas_until_they_are_merged(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "t"), ["k"], [F.col("ver")], most_deltas=2)
    assert store.read() is None
    want = {}
    for n in range(7):
        batch = [(k, n if k % 2 else -n, f"{n}") for k in range(n, n + 3)]
        want |= {k: (k, v, x) for k, v, x in batch if k not in want or v > want[k][1]}
        for _ in range(1 + (n == 3)):  # one batch comes twice
            store.merge(spark.createDataFrame(batch, "k bigint, ver int, v string"))
        assert rows(store.read()) == sorted(want.values(), key=repr) and len(store._parts()) <= 3
    assert len(store._complete("v")) == 2 and min(store._complete("d")) > min(store._complete("v"))
    (tmp_path / "t" / "d99").mkdir()  # a batch that did not end
    assert rows(store.read()) == sorted(want.values(), key=repr)
    twice = TableStore(spark, str(tmp_path / "u"), ["k"], [F.col("ver")])
    for _ in range(2):
        twice.merge(spark.createDataFrame([(1, 1, "")], "k bigint, ver int, v string"))
    with pytest.raises(ValueError, match="keys"):
        TableStore(spark, str(tmp_path / "u")).read()


def test_config(tmp_path):
    file = tmp_path / "c.toml"
    file.write_text('[prep]\nsplit_task_a = 0.5\nsplit_task_b = 0.3\nsplit_task_c = 0.2\ntask_b_mask_modes = ["last"]\n[train.phase1]\nweight_task_a = 0.9\n[tokenize]\nrecall_k = 5\n[rqvae]\nrq_levels = 4\n')
    assert config.prep_settings(file).mask_modes == ("last",)
    assert config.tokenise_settings(file).recall_k == 5 and config.quantiser_settings(file).levels == 4
    with pytest.raises(config.ConfigError):
        config.stage_settings(file, "phase1")
    with pytest.raises(config.ConfigError, match="missing section"):
        config.stage_settings(file, "phase2")
    file.write_text('[prep]\nsplit_task_a = 0.9\n')
    with pytest.raises(config.ConfigError):
        config.prep_settings(file)
    (tmp_path / ".env").write_text("# x\nexport TOKEN='abc'\n")
    assert config.secret("", "TOKEN", tmp_path / ".env") == "abc" and config.secret(" d ", "TOKEN") == "d"
    assert config.resolve(file, "../x") == (tmp_path.parent / "x").resolve()


def test_runs(spark, tmp_path):
    path, made = str(tmp_path / "t"), []

    def build(n):
        made.append(n)
        return spark.range(n)

    assert runs.built(spark, path, lambda: build(0), False).count() == 0
    assert runs.built(spark, path, lambda: build(3), False).count() == 3  # an empty table is built again
    assert runs.built(spark, path, lambda: build(5), False).count() == 3
    assert runs.built(spark, path, lambda: build(4), True).count() == 4 and made == [0, 3, 4]
    assert runs.dry_stage(config.StageSettings(max_domain_rows=0), 50).max_domain_rows == 50
    assert runs.dry_stage(config.StageSettings(max_domain_rows=9), 50).max_domain_rows == 9
    assert [runs.dry_limit(*x) for x in ((0, 1), (5, 10), (0, 10))] == [2, 5, 10]
    assert instructions.evaluation_texts(runs.evaluation_defaults(spark), 10).count() == 4


@pytest.mark.parametrize("name", ["training_pools", "training_set", "named_embeddings", "cooccurrence", "proxy_neighbors"])
def test_whole_tables_equal_sql(spark, rows, name):
    import os

    import __spark_entry__ as entry
    import duckdb

    d = "/root/testdata/sf0.01" if name.startswith(("cooc", "proxy")) else "/root/testdata/sf0.001"  # where titles have support
    if not os.path.isdir(d):
        pytest.skip("no test data")
    con = duckdb.connect()
    for f in os.listdir(d):
        path = f"{d}/{f}" + ("/*.parquet" if os.path.isdir(f"{d}/{f}") else "")
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    assert rows(entry.queries()[name](spark, d)) == sorted(con.execute(entry.oracle_sql()[name]).fetchall(), key=repr)
