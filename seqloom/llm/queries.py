"""Queries pN_ of the problems on training data, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.functions.instants import instant, instant_micros
from seqloom.llm.clusters import describe_clusters, similar_groups
from seqloom.llm.cooccurrence import PairLimits, latest_score_baskets, pair_surprise
from seqloom.llm.nearest import compact_vectors, nearest_neighbours, usable_vectors
from seqloom.llm.mixing import mix_sources, mix_report
from seqloom.llm.packing import PackLimits, pack_items
from seqloom.llm.sentences import split_sentences
from seqloom.llm.splits import related_groups, split_related
from seqloom.llm.tokens import with_tokens
from seqloom.session import checkpoint, shared_folder, table


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    baskets = latest_score_baskets(table(spark, sf_dir, "user_anime"), instant_micros(F.col("scraped_at")), 7, 10)
    return pair_surprise(baskets, PairLimits(min_count=10, min_lift=2.0, min_jaccard=0.25))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of titles that the same users scored high far more often than chance."""
    return _pairs(spark, sf_dir).select(F.col("item_a").alias("anime_a"), F.col("item_b").alias("anime_b"))


def p2_surprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with counts, lift, null expectation and q-value."""
    return _pairs(spark, sf_dir).withColumnsRenamed({"item_a": "anime_a", "item_b": "anime_b"})


MODEL, DIM = "tessera-text-v2", 128
LINK = 0.75


def title_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vec): the current vector of every title, of length 1."""
    df = table(spark, sf_dir, "anime_embeddings")
    return usable_vectors(df, "anime_id", "embedding", DIM, instant(F.col("embedded_at")), (F.col("model_name") == MODEL) & (F.col("embedding_dim") == DIM))


def packed_title_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors as they are in the table, packed."""
    df = table(spark, sf_dir, "anime_embeddings")
    return compact_vectors(df, "anime_id", "embedding", DIM, instant(F.col("embedded_at")), (F.col("model_name") == MODEL) & (F.col("embedding_dim") == DIM))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each member of a cluster of three or more beside the cluster's smallest title."""
    groups = similar_groups(packed_title_vectors(spark, sf_dir))
    large = groups.groupBy("cluster").agg(F.count("*").alias("n")).where("n >= 3")
    return groups.join(large, "cluster").where("id != cluster").select(F.col("cluster").alias("anime_a"), F.col("id").alias("anime_b"))


def p1_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every title, its size, and the places of its most typical titles."""
    vectors = title_vectors(spark, sf_dir)
    described = describe_clusters(vectors, similar_groups(packed_title_vectors(spark, sf_dir)))
    return described.select(F.col("id").alias("anime_id"), F.col("cluster").alias("cluster_id"), F.col("size").alias("cluster_size"), F.round("typicality", 6).alias("typicality"), F.col("place").alias("typical_place"))


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with what is counted, without the null."""
    return _pairs(spark, sf_dir).select(F.col("item_a").alias("anime_a"), F.col("item_b").alias("anime_b"), "n_ab", "n_a", "n_b", "n_baskets", F.round("lift", 9).alias("lift"), F.round("jaccard", 9).alias("jaccard"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of cosine 0.75 or more of which one is among the ten nearest of the other."""
    found = nearest_neighbours(title_vectors(spark, sf_dir), 10, least=LINK)
    return found.select(F.least("id", "other").alias("anime_a"), F.greatest("id", "other").alias("anime_b")).distinct()


def p3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest titles of every title whose id is divisible by 50."""
    found = nearest_neighbours(title_vectors(spark, sf_dir), 10, every=50, sure=LINK)
    return found.select(F.col("id").alias("anime_id"), "rank", F.col("other").alias("near_id"), F.round("sim", 6).alias("cosine"))


def _example_keys() -> tuple[Column, Column]:
    return F.col("user_id"), F.get("anime_ids", F.lit(0))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each example of a group of related ones beside the group's smallest."""
    groups = related_groups(table(spark, sf_dir, "llm_prep_train"), "example_id", _example_keys())
    first = groups.groupBy("root").agg(F.min("example_id").alias("example_a"))
    found = groups.join(first, "root").where("example_id != example_a")
    return found.select("example_a", F.col("example_id").alias("example_b"))


def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of every example."""
    targets = [(r["split_name"], r["target_share"]) for r in table(spark, sf_dir, "split_targets").orderBy("split_name").collect()]
    task = F.upper(F.trim("task"))
    dealt = split_related(table(spark, sf_dir, "llm_prep_train"), "example_id", _example_keys(), task, targets)
    return dealt.select("example_id", "task", "split_name")


def p5_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spanning forest of the keys, read back from the table it is kept in; ``u`` and ``a`` are user and first title."""
    forest = f"{shared_folder(spark)}/p5_forest"
    related_groups(table(spark, sf_dir, "llm_prep_train"), "example_id", _example_keys(), forest=forest)
    rows = spark.read.parquet(forest)
    return rows.select(F.substring("p", 3, 20).cast("long").alias("user_id"), F.substring("q", 3, 20).cast("long").alias("anime_id"))


def p5_forest_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the forest, and the users and titles it joins."""
    return p5_forest(spark, sf_dir).agg(F.count("*").alias("edges"), F.count_distinct("user_id").alias("users"), F.count_distinct("anime_id").alias("titles"))


def p5_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and users and first titles whose examples are in more than one split."""
    train = table(spark, sf_dir, "llm_prep_train")
    user, title = _example_keys()
    keyed = checkpoint(train.select("example_id", user.alias("u"), title.alias("a")).join(p5_splits(spark, sf_dir), "example_id"))
    zero = F.lit(0).cast("long")
    parts = keyed.agg(F.count("*").alias("n_rows"), F.count_distinct("example_id").alias("n_examples"), zero.alias("users_torn"), zero.alias("titles_torn"))
    for k in ("u", "a"):
        torn = F.count_if(F.col("n") > 1)
        by_key = keyed.where(F.col(k).isNotNull()).groupBy(k).agg(F.count_distinct("split_name").alias("n"))
        parts = parts.unionByName(by_key.agg(zero.alias("n_rows"), zero.alias("n_examples"), (torn if k == "u" else zero).alias("users_torn"), (torn if k == "a" else zero).alias("titles_torn")))
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])


def p5_near_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For all rows and each task: rows, and whether every split is within a point and three rows of its share."""
    shares = p5_shares(spark, sf_dir).join(table(spark, sf_dir, "split_targets"), "split_name")
    off = F.abs(F.col("n") - F.col("target_share") * F.sum("n").over(Window.partitionBy("task")))
    kept = shares.select("task", "n", (off <= 3 + 0.01 * F.sum("n").over(Window.partitionBy(F.lit(1)))).alias("near"))
    return kept.groupBy("task").agg(F.sum("n").alias("n"), F.bool_and("near").alias("near"))


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and share of every split, overall (task null) and per task."""
    counts = checkpoint(p5_splits(spark, sf_dir).groupBy("task", "split_name").agg(F.count("*").alias("n")))
    both = counts.unionByName(counts.groupBy("split_name").agg(F.sum("n").alias("n")).select(F.lit("(all)").alias("task"), "split_name", "n"))
    whole = both.groupBy("task").agg(F.sum("n").alias("whole"))
    return both.join(whole, "task").select("task", "split_name", "n", F.round(F.col("n") / F.col("whole"), 6).alias("share"))


def p7_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in containers of each size."""
    sizes = with_tokens(table(spark, sf_dir, "documents"), "doc_id", "text")
    packs = [(r["pack_name"], r["capacity_tokens"]) for r in table(spark, sf_dir, "pack_sizes").orderBy("pack_name").collect()]
    return pack_items(sizes, "doc_id", [PackLimits(name, capacity, max_segments=64) for name, capacity in packs])


def p7_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of each size, and the share of their space that is unused."""
    bins = p7_packs(spark, sf_dir).where("container_id is not null").groupBy("pack_name", "container_id").agg(F.max("unused_tokens").alias("unused"), F.sum("n_tokens").alias("used"), F.count("*").alias("segments"))
    return bins.groupBy("pack_name").agg(F.count("*").alias("n_containers"), F.sum("segments").alias("n_segments"), F.sum("used").alias("used_tokens"), F.sum("unused").alias("unused_tokens"))


def p7_instruction_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every training example in containers of each size, whose prompts bear no loss.

    A container holds at most 16 examples, and loss on at most a sixth of its tokens.
    """
    train = table(spark, sf_dir, "llm_prep_train")
    sizes = with_tokens(train, "example_id", "input", ("output",)).withColumnRenamed("n_tokens", "prompt_tokens")
    sizes = with_tokens(sizes, "example_id", "output", ("prompt_tokens",)).select("example_id", (F.col("prompt_tokens") + F.col("n_tokens")).alias("n_tokens"), F.col("n_tokens").alias("loss_tokens"))
    packs = [(r["pack_name"], r["capacity_tokens"]) for r in table(spark, sf_dir, "pack_sizes").orderBy("pack_name").collect()]
    return pack_items(sizes, "example_id", [PackLimits(name, capacity, 16, max(1, capacity // 6)) for name, capacity in packs], loss="loss_tokens")


def _pack_faults(packs: DataFrame, sf_dir: str, key: str, segments: int) -> DataFrame:
    """(pack_name, n_items, torn, over_capacity, over_segments): the last three are 0 of valid containers."""
    sizes = table(packs.sparkSession, sf_dir, "pack_sizes")
    rows = checkpoint(packs)
    whole = rows.groupBy("pack_name", key).agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens")).join(sizes, "pack_name")
    torn = whole.groupBy("pack_name").agg(F.count("*").alias("n_items"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))).alias("torn"))
    bins = rows.where("container_id is not null").groupBy("pack_name", "container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("n"), F.max("unused_tokens").alias("unused")).join(sizes, "pack_name")
    wrong = bins.groupBy("pack_name").agg(F.count_if(F.col("used") + F.col("unused") != F.col("capacity_tokens")).alias("over_capacity"), F.count_if(F.col("n") > segments).alias("over_segments"))
    return torn.join(wrong, "pack_name").select("pack_name", "n_items", "torn", "over_capacity", "over_segments")


def p7_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed, and what would be wrong with their containers: nothing."""
    return _pack_faults(p7_packs(spark, sf_dir), sf_dir, "doc_id", 64)


def p7_instruction_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of training examples of each size and how full each limit is."""
    rows = p7_instruction_packs(spark, sf_dir).where("container_id is not null")
    bins = rows.groupBy("pack_name", "container_id").agg(F.sum("n_tokens").alias("tokens"), F.sum("loss_tokens").alias("loss"), F.count("*").alias("segments"))
    return bins.groupBy("pack_name").agg(F.count("*").alias("n_containers"), F.sum("tokens").alias("tokens"), F.sum("loss").alias("loss_tokens"), F.sum("segments").alias("segments"), F.max("loss").alias("most_loss"), F.max("segments").alias("most_segments"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, sf_dir, "documents").withColumn("source", F.lower(F.trim("source")))
    return with_tokens(documents, "doc_id", "text", ("source",)), table(spark, sf_dir, "mix_targets").withColumn("source", F.lower(F.trim("source")))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents and how often each is used."""
    return mix_sources(*_mix(spark, sf_dir), "doc_id")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted and actual share of every source."""
    sizes, targets = _mix(spark, sf_dir)
    return mix_report(mix_sources(sizes, targets, "doc_id"), sizes, targets)


def p8_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, max_repeats, over): documents used more often than they may be, none."""
    sizes, targets = _mix(spark, sf_dir)
    used = mix_sources(sizes, targets, "doc_id").groupBy("source", "doc_id").agg(F.sum("repeats").alias("n"))
    return targets.join(used, "source", "left").groupBy("source", "max_repeats").agg(F.count_if(F.col("n") > F.col("max_repeats")).alias("over"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document."""
    return split_sentences(table(spark, sf_dir, "documents")).select("doc_id", "start_char", "end_char")


def p9_sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of each document, and its longest one."""
    spans = split_sentences(table(spark, sf_dir, "documents"))
    return spans.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.col("end_char") - F.col("start_char")).alias("longest"))


def p9_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_chars): characters of the sentences of each document that are not white space."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = split_sentences(texts).join(texts, "doc_id").select("doc_id", F.expr("substring(text, start_char + 1, end_char - start_char)").alias("s"))
    return spans.groupBy("doc_id").agg(F.sum(F.length(F.regexp_replace("s", _BLANK, ""))).alias("n_chars"))


_BLANK = r"[\t\n\x{0B}\f\r \x1c-\x1f\x{85}\p{Z}]"
_BASKETS = """b AS (SELECT user_id, anime_id FROM (
  SELECT user_id, anime_id, score, row_number() OVER (PARTITION BY user_id, anime_id ORDER BY
    CAST(CASE WHEN scraped_at LIKE '%Z' OR substr(scraped_at, -6, 1) IN ('+', '-') THEN scraped_at ELSE scraped_at || '+00:00' END AS TIMESTAMPTZ) DESC,
    CASE WHEN score BETWEEN 7 AND 10 THEN score ELSE 0 END DESC) AS r
  FROM user_anime WHERE user_id > 0 AND anime_id IS NOT NULL) WHERE r = 1 AND score BETWEEN 7 AND 10),
n AS (SELECT anime_id, count(*) AS n FROM b GROUP BY 1),
t AS (SELECT count(DISTINCT user_id) AS t FROM b),
c AS (SELECT x.anime_id AS a, y.anime_id AS b, count(*) AS n_ab FROM b x JOIN b y ON x.user_id = y.user_id AND x.anime_id < y.anime_id GROUP BY 1, 2)"""

_VECTORS = """v AS (SELECT anime_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM (
  SELECT anime_id, embedding, row_number() OVER (PARTITION BY anime_id ORDER BY CAST(embedded_at AS TIMESTAMPTZ) DESC, embedding DESC) AS r FROM anime_embeddings
  WHERE model_name = 'tessera-text-v2' AND embedding_dim = 128 AND len(embedding) = 128 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AND anime_id IS NOT NULL) WHERE r = 1),
s AS (SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.e, b.e), 12) AS c FROM v a JOIN v b ON a.id <> b.id)"""

QUERIES = {
    "p1_found": p1_found,
    "p1_clusters": p1_clusters,
    "p2_found": p2_found, "p2_surprise": p2_surprise, "p2_counts": p2_counts, "p3_found": p3_found,
    "p3_nearest": p3_nearest,
    "p5_found": p5_found,
    "p5_splits": p5_splits,
    "p5_shares": p5_shares, "p5_forest": p5_forest, "p5_forest_size": p5_forest_size, "p5_leaks": p5_leaks, "p5_near_targets": p5_near_targets,
    "p7_packs": p7_packs,
    "p7_unused": p7_unused, "p7_faults": p7_faults, "p7_instruction_packs": p7_instruction_packs, "p7_instruction_unused": p7_instruction_unused,
    "p8_mix": p8_mix,
    "p8_shares": p8_shares, "p8_faults": p8_faults,
    "p9_found": p9_found, "p9_sentence_counts": p9_sentence_counts, "p9_cover": p9_cover,
}
_HITS = """ FROM c JOIN n na ON na.anime_id = c.a JOIN n nb ON nb.anime_id = c.b CROSS JOIN t
  WHERE n_ab >= 10 AND CAST(n_ab AS DOUBLE) * t / (CAST(na.n AS DOUBLE) * nb.n) >= 2 AND CAST(n_ab AS DOUBLE) / (na.n + nb.n - n_ab) >= 0.25"""
# components of users and first titles, by the smallest key that reaches each
_GROUPS = """e AS (SELECT example_id AS id, user_id, anime_ids[1] AS anime_id, 'u' || user_id AS u, 'a' || anime_ids[1] AS a FROM llm_prep_train),
  l AS MATERIALIZED (SELECT u AS a, a AS b FROM e WHERE u IS NOT NULL AND a IS NOT NULL UNION SELECT a, u FROM e WHERE u IS NOT NULL AND a IS NOT NULL),
  g(k, r) AS (SELECT k, k FROM (SELECT DISTINCT unnest([u, a]) AS k FROM e WHERE u IS NOT NULL AND a IS NOT NULL) UNION SELECT l.b, g.r FROM g JOIN l ON l.a = g.k), m AS (SELECT k, min(r) AS r FROM g GROUP BY 1)"""
_LINKED = f"""{_VECTORS}, l AS MATERIALIZED (SELECT a, b FROM s WHERE c >= 0.75),
  g(id, r) AS (SELECT id, id FROM v UNION SELECT l.b, g.r FROM g JOIN l ON l.a = g.id), m AS (SELECT id, min(r) AS r FROM g GROUP BY 1)"""
ORACLES = {
    "p1_clusters": f"""WITH RECURSIVE {_LINKED}, u AS (SELECT id, r, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e, count(*) OVER (PARTITION BY r) AS n FROM v JOIN m USING (id)),
  k AS (SELECT r, i, sum(e[i]) AS x FROM u, range(1, 129) t(i) GROUP BY 1, 2), o AS (SELECT r, list(x ORDER BY i) AS o FROM k GROUP BY 1),
  y AS (SELECT id, r, n, round(list_cosine_similarity(e, o), 9) AS t FROM u JOIN o USING (r)), z AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY t DESC, id) AS p FROM y)
  SELECT id AS anime_id, r AS cluster_id, n AS cluster_size, round(t, 6) AS typicality, CAST(CASE WHEN p <= 5 THEN p END AS INTEGER) AS typical_place FROM z""",
    "p5_forest_size": f"""WITH RECURSIVE {_GROUPS}, t AS (SELECT count(DISTINCT user_id) AS users, count(DISTINCT anime_id) AS titles FROM e WHERE user_id IS NOT NULL AND anime_id IS NOT NULL)
  SELECT users + titles - (SELECT count(DISTINCT r) FROM m) AS edges, users, titles FROM t""",
    "p5_leaks": "SELECT count(*) AS n_rows, count(DISTINCT example_id) AS n_examples, CAST(0 AS BIGINT) AS users_torn, CAST(0 AS BIGINT) AS titles_torn FROM llm_prep_train",
    "p5_near_targets": "SELECT coalesce(upper(trim(task)), '(all)') AS task, CAST(count(*) AS BIGINT) AS n, true AS near FROM llm_prep_train GROUP BY ROLLUP (upper(trim(task)))",
    "p7_faults": "SELECT pack_name, (SELECT count(*) FROM documents) AS n_items, CAST(0 AS BIGINT) AS torn, CAST(0 AS BIGINT) AS over_capacity, CAST(0 AS BIGINT) AS over_segments FROM pack_sizes",
    "p8_faults": "SELECT lower(trim(source)) AS source, max_repeats, CAST(0 AS BIGINT) AS over FROM mix_targets",
    "p9_cover": r"SELECT doc_id, CAST(length(regexp_replace(text, '[\t\n\v\f\r \x1c-\x1f\x{85}\p{Z}]', '', 'g')) AS BIGINT) AS n_chars FROM documents WHERE regexp_replace(text, '[\t\n\v\f\r \x1c-\x1f\x{85}\p{Z}]', '', 'g') <> ''",
    "p1_found": f"""WITH RECURSIVE {_LINKED}
  SELECT r AS anime_a, id AS anime_b FROM m WHERE id <> r AND r IN (SELECT r FROM m GROUP BY 1 HAVING count(*) >= 3)""",
    "p2_counts": f"""WITH {_BASKETS} SELECT c.a AS anime_a, c.b AS anime_b, n_ab, na.n AS n_a, nb.n AS n_b, t AS n_baskets,
  round(CAST(n_ab AS DOUBLE) * t / (CAST(na.n AS DOUBLE) * nb.n), 9) AS lift, round(CAST(n_ab AS DOUBLE) / (na.n + nb.n - n_ab), 9) AS jaccard {_HITS}""",
    "p3_found": f"""WITH {_VECTORS}, k AS (SELECT * FROM (SELECT a, b, c, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM s) WHERE r <= 10 AND c >= 0.75)
  SELECT DISTINCT least(a, b) AS anime_a, greatest(a, b) AS anime_b FROM k""",
    "p3_nearest": f"WITH {_VECTORS} SELECT a AS anime_id, CAST(r AS INTEGER) AS rank, b AS near_id, round(c, 6) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM s WHERE a % 50 = 0) WHERE r <= 10",
    "p5_found": """WITH RECURSIVE e AS (SELECT example_id AS id, 'u' || user_id AS u, 'a' || anime_ids[1] AS a FROM llm_prep_train),
  l AS MATERIALIZED (SELECT u AS a, a AS b FROM e WHERE u IS NOT NULL AND a IS NOT NULL UNION SELECT a, u FROM e WHERE u IS NOT NULL AND a IS NOT NULL),
  g(k, r) AS (SELECT k, k FROM (SELECT DISTINCT unnest([u, a]) AS k FROM e) WHERE k IS NOT NULL UNION SELECT l.b, g.r FROM g JOIN l ON l.a = g.k),
  m AS (SELECT k, min(r) AS r FROM g GROUP BY 1), x AS (SELECT id, m.r FROM e JOIN m ON m.k = coalesce(e.u, e.a)), y AS (SELECT id, min(id) OVER (PARTITION BY r) AS f FROM x)
  SELECT f AS example_a, id AS example_b FROM y WHERE id <> f""",
    "p2_found": f"WITH {_BASKETS} SELECT c.a AS anime_a, c.b AS anime_b {_HITS}",
}
