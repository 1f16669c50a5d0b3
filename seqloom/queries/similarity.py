"""Queries on neighbours, codes and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import genre_set
from seqloom.functions.vectors import level_tokens, norm, parse_level_token, prefix_depth, hamming_ratio, reconstruct, semantic_id
from seqloom.operators.codebooks import code_histogram, code_usage, mean_rows, ridge_fit, token_counts, train_codebooks, vocabulary
from seqloom.operators.neighbours import bucket_purity, code_buckets, code_neighbours, global_purity, item_support, jaccard_neighbours, positive_edges, query_items, recall_at_k, recall_examples, recall_report, shared_users
from seqloom.operators.validation import dimension_range, invalid_vectors
from seqloom.plans.embed import HashingBackend, embed_texts
from seqloom.plans.tokenise import semantic_ids
from seqloom.queries.common import CODES, PREP, SEM, UA, codes, interactions, one_prep, semantic
from seqloom.session import checkpoint, table
from seqloom.sources.readers import embeddings_with_names, metadata_rows
from seqloom.sources.writers import inverse_lookup

STATUS, SCORE, SUPPORT, K, QUERY_MOST = 2, 7, 5, 20, 500
SPECIAL = ("<anime_start>", "<anime_end>", "<watch>", "<liked>", "<disliked>", "<dropped>", " <liked> ")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges, written once: every use of them would merge the log again."""
    return checkpoint(positive_edges(interactions(spark, d), codes(spark, d), STATUS, SCORE))


def _queries(edges: DataFrame, most: int) -> DataFrame:
    return checkpoint(query_items(edges, SUPPORT, most))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return positive_edges(interactions(spark, d), codes(spark, d), STATUS, SCORE)


def support(spark: SparkSession, d: str) -> DataFrame:
    return item_support(edges(spark, d))


def cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    """Shared users of every title with enough support."""
    e = _edges(spark, d)
    return shared_users(e, _queries(e, 0))


def proxy(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours of every title with enough support."""
    e = _edges(spark, d)
    return jaccard_neighbours(e, _queries(e, 0), K)


def hamming(spark: SparkSession, d: str) -> DataFrame:
    c = checkpoint(codes(spark, d))
    return code_neighbours(c, c.where("anime_id % 50 = 0"), K)


def _recall(spark: SparkSession, d: str) -> DataFrame:
    e, c = _edges(spark, d), checkpoint(codes(spark, d))
    queries = _queries(e, QUERY_MOST)
    return checkpoint(recall_at_k(jaccard_neighbours(e, queries, K), code_neighbours(c, queries, K), K))


def recall(spark: SparkSession, d: str) -> DataFrame:
    return _recall(spark, d).select("anime_id", "hits", "wanted", F.round("recall", 9).alias("recall"))


def report(spark: SparkSession, d: str) -> DataFrame:
    return recall_report(_recall(spark, d), K, SUPPORT)


def examples(spark: SparkSession, d: str) -> DataFrame:
    return recall_examples(_recall(spark, d).withColumn("recall", F.round("recall", 9)))


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return codes(spark, d).select("anime_id", "codes", level_tokens(F.col("codes")).alias("tokens"))


def made_ids(spark: SparkSession, d: str) -> DataFrame:
    t = _tokens(spark, d)
    return t.select("anime_id", semantic_id(F.col("tokens")).alias("semantic_id"), semantic_id(F.col("tokens"), False, "-").alias("separated"))


def counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(_tokens(spark, d))


def vocab(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary(spark, 8, 2048, SPECIAL)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    rows = semantic(spark, d).select("anime_id", F.explode(F.from_json("level_tokens_json", "array<string>")).alias("token"))
    return rows.select("anime_id", "token", parse_level_token(F.col("token")).alias("p")).select("anime_id", "token", "p.level", "p.code")


def prefixes(spark: SparkSession, d: str) -> DataFrame:
    """Each title beside the next id."""
    c = codes(spark, d)
    b = c.select((F.col("anime_id") - 1).alias("anime_id"), F.col("codes").alias("other"))
    return c.join(b, "anime_id").select("anime_id", hamming_ratio(F.col("codes"), F.col("other")).alias("distance"), prefix_depth(F.col("codes"), F.col("other")).alias("prefix"))


def _genred(spark: SparkSession, d: str) -> DataFrame:
    genres = one_prep(spark, d).select("anime_id", genre_set(F.col("genres")).alias("genres"))
    return _tokens(spark, d).join(genres, "anime_id")


def buckets(spark: SparkSession, d: str) -> DataFrame:
    return code_buckets(_tokens(spark, d)).where("bucket_size >= 3")


def purity(spark: SparkSession, d: str) -> DataFrame:
    return bucket_purity(_genred(spark, d), 5, 20, 10)


def purity_total(spark: SparkSession, d: str) -> DataFrame:
    return global_purity(purity(spark, d))


def usage(spark: SparkSession, d: str) -> DataFrame:
    return code_usage(codes(spark, d), "codes", 2048).select("used", F.round("used_pct", 6).alias("used_pct"), F.round("perplexity", 6).alias("perplexity"))


def histogram(spark: SparkSession, d: str) -> DataFrame:
    return code_histogram(codes(spark, d), "codes")


def vector_norm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(norm(F.col("embedding")), 5).alias("norm"))


def faulty_vectors(spark: SparkSession, d: str) -> DataFrame:
    return invalid_vectors(table(spark, d, "anime_embeddings"), "anime_id", "embedding", "embedding_dim").groupBy("reason").agg(F.count("*").alias("n"))


def dimensions(spark: SparkSession, d: str) -> DataFrame:
    return dimension_range(table(spark, d, "embeddings"), "embedding")


def named_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """Every embedding of every model with the names of its title, counted by model."""
    rows = embeddings_with_names(table(spark, d, "anime_embeddings"), one_prep(spark, d))
    return rows.groupBy("anime_id", "model_name", "name", "english_name", "genres").agg(F.count("*").alias("n"))


def metadata(spark: SparkSession, d: str) -> DataFrame:
    return metadata_rows(one_prep(spark, d), codes(spark, d)).select("anime_id", "name", "type", "source")


def shared_ids(spark: SparkSession, d: str) -> DataFrame:
    return inverse_lookup(semantic(spark, d)).groupBy("semantic_id").agg(F.count("*").alias("n"), F.min("anime_id").alias("first_id"))


def code_means(spark: SparkSession, d: str) -> DataFrame:
    """Mean of two-entry code vectors by the codes of each title."""
    book = spark.range(2048).select(F.col("id").cast("int").alias("code"), F.array(F.col("id") / 2048.0, (F.col("id") % 7).cast("double")).alias("vector"))
    return mean_rows(codes(spark, d), "anime_id", "codes", book).select("anime_id", F.round(F.element_at("mean", 1), 9).alias("m1"), F.round(F.element_at("mean", 2), 9).alias("m2"))


def residual_training(spark: SparkSession, d: str) -> DataFrame:
    """Codebooks trained on all vectors; ids of every vector and its error after decoding."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    books, _ = train_codebooks(v, "embedding", 3, 32, 4)
    made = semantic_ids(v, "embedding", books).join(v, "id")
    gap = F.zip_with("embedding", reconstruct(F.col("codes"), books), lambda a, b: (a - b) * (a - b))
    return made.select("id", "semantic_id", F.round(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x), 6).alias("error"))


def embedded_texts(spark: SparkSession, d: str) -> DataFrame:
    rows = embed_texts(one_prep(spark, d), "anime_id", "anime_text", HashingBackend(32), "hashed-words", "2024-01-01T00:00:00+00:00")
    return rows.select("anime_id", "embedding_dim", F.round(norm(F.col("embedding")), 5).alias("norm"))


def ridge(spark: SparkSession, d: str) -> DataFrame:
    """Price from quantity, discount and tax by ridge regression: rows, error, weights."""
    rows = table(spark, d, "lineitem").select(F.array(F.lit(1.0), F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")).alias("x"), F.array(F.col("l_extendedprice") / 1000).alias("y"))
    w, n, error = ridge_fit(rows, "x", "y", 1e-3)
    return spark.createDataFrame([(n, round(error, 4), *[round(float(v), 4) for v in w[:, 0]])], "n long, mse double, w0 double, w1 double, w2 double, w3 double")


_ED = f"{UA}, {CODES}, ed AS (SELECT DISTINCT user_id, anime_id FROM ua WHERE watching_status = {STATUS} AND score >= {SCORE} AND anime_id IN (SELECT anime_id FROM codes))"
_SU = _ED + ", su AS (SELECT anime_id, count(*) AS support FROM ed GROUP BY 1)"
_Q = _SU + f", q AS (SELECT anime_id FROM su WHERE support >= {SUPPORT} ORDER BY md5('42:' || anime_id), anime_id LIMIT {QUERY_MOST})"
_QA = _SU + f", q AS (SELECT anime_id FROM su WHERE support >= {SUPPORT})"
_CO = _Q + ", co AS (SELECT a.anime_id, b.anime_id AS other_id, count(*) AS shared FROM ed a JOIN ed b ON a.user_id = b.user_id AND a.anime_id <> b.anime_id WHERE a.anime_id IN (SELECT anime_id FROM q) GROUP BY 1, 2)"
_PX = _CO + f""", px AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anime_id ORDER BY jaccard DESC, other_id) AS rank FROM (
  SELECT co.anime_id, other_id, CAST(shared AS DOUBLE) / (a.support + b.support - shared) AS jaccard FROM co JOIN su a ON a.anime_id = co.anime_id JOIN su b ON b.anime_id = other_id)) WHERE rank <= {K})"""
_COA, _PXA = _CO.replace(_Q, _QA, 1), _PX.replace(_Q, _QA, 1)
_HM = """hm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anime_id ORDER BY distance, prefix DESC, other_id) AS rank FROM (
  SELECT a.anime_id, b.anime_id AS other_id, len(list_filter(a.codes, lambda x, i: x <> b.codes[i])) / 8.0::DOUBLE AS distance,
    coalesce(list_position(list_transform(a.codes, lambda x, i: x = b.codes[i]), false) - 1, 8) AS prefix
  FROM codes a JOIN codes b ON a.anime_id <> b.anime_id WHERE {where})) WHERE rank <= 20)"""
_RC = _PX + ", " + _HM.format(where="a.anime_id IN (SELECT anime_id FROM q)") + f""", rc AS (SELECT px.anime_id, count(hm.other_id) AS hits, least({K}, count(*)) AS wanted,
  round(CAST(count(hm.other_id) AS DOUBLE) / greatest(1, least({K}, count(*))), 9) AS recall FROM px LEFT JOIN hm ON hm.anime_id = px.anime_id AND hm.other_id = px.other_id GROUP BY 1)"""
_TK = CODES + ", tk AS (SELECT anime_id, codes, list_transform(codes, lambda c, i: '<L' || i || '_' || c || '>') AS tokens FROM codes)"
_GS = "list_distinct(list_filter(list_transform(string_split(coalesce(genres, ''), ','), lambda x: lower(trim(x))), lambda x: x <> ''))"

QUERIES = {
    "positive_edges": edges, "item_support": support, "cooccurrence": cooccurrence, "proxy_neighbors": proxy, "hamming_topk": hamming, "recall_at_k": recall, "recall_report": report,
    "recall_examples": examples, "semantic_ids": made_ids, "token_counts": counts, "vocab": vocab, "parsed_tokens": parsed, "prefix_depth": prefixes, "cluster_buckets": buckets,
    "bucket_purity": purity, "global_purity": purity_total, "code_usage_perplexity": usage, "code_histogram": histogram, "vector_norm": vector_norm, "faulty_vectors": faulty_vectors, "dimension_range": dimensions,
    "named_embeddings": named_embeddings, "metadata": metadata, "shared_semantic_ids": shared_ids, "code_means": code_means, "residual_training": residual_training, "embedded_texts": embedded_texts, "ridge_fit": ridge,
}
ORACLES = {
    "positive_edges": f"WITH {_ED} SELECT user_id, anime_id FROM ed",
    "item_support": f"WITH {_SU} SELECT anime_id, CAST(support AS BIGINT) AS support FROM su",
    "cooccurrence": f"WITH {_COA} SELECT anime_id, other_id, CAST(shared AS BIGINT) AS shared FROM co",
    "proxy_neighbors": f"WITH {_PXA} SELECT anime_id, other_id, jaccard, CAST(rank AS INTEGER) AS rank FROM px",
    "hamming_topk": f"WITH {CODES}, {_HM.format(where='a.anime_id % 50 = 0')} SELECT anime_id, other_id, distance, CAST(prefix AS INTEGER) AS prefix, CAST(rank AS INTEGER) AS rank FROM hm",
    "recall_at_k": f"WITH {_RC} SELECT anime_id, hits, CAST(wanted AS BIGINT) AS wanted, recall FROM rc",
    "recall_report": f"WITH {_RC} SELECT 'ok' AS status, {K} AS recall_k, {SUPPORT} AS min_support, count(*) AS evaluated_queries, round(avg(recall), 9) AS mean_recall, round(median(recall), 9) AS median_recall FROM rc",
    "recall_examples": f"WITH {_RC} SELECT * FROM (SELECT 'worst' AS kind, anime_id, recall FROM rc ORDER BY recall, anime_id LIMIT 5) UNION ALL SELECT * FROM (SELECT 'best' AS kind, anime_id, recall FROM rc ORDER BY recall DESC, anime_id DESC LIMIT 5)",
    "semantic_ids": f"WITH {_TK} SELECT anime_id, array_to_string(tokens, '') AS semantic_id, array_to_string(tokens, '-') AS separated FROM tk",
    "token_counts": f"WITH {_TK} SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(tokens) AS token FROM tk) GROUP BY 1",
    "vocab": "SELECT CAST(i AS BIGINT) AS token_id, CASE WHEN i < 6 THEN ['<anime_start>', '<anime_end>', '<watch>', '<liked>', '<disliked>', '<dropped>'][i + 1] ELSE '<L' || ((i - 6) // 2048 + 1) || '_' || ((i - 6) % 2048) || '>' END AS token, CASE WHEN i < 6 THEN 'special' ELSE 'level' END AS kind FROM range(6 + 8 * 2048) t(i)",
    "parsed_tokens": f"WITH {SEM} SELECT anime_id, token, CASE WHEN regexp_full_match(token, '<L\\d+_\\d+>') THEN CAST(regexp_extract(token, '<L(\\d+)_(\\d+)>', 1) AS INTEGER) END AS level, CASE WHEN regexp_full_match(token, '<L\\d+_\\d+>') THEN CAST(regexp_extract(token, '<L(\\d+)_(\\d+)>', 2) AS INTEGER) END AS code FROM (SELECT anime_id, unnest(CAST(CAST(level_tokens_json AS JSON) AS VARCHAR[])) AS token FROM sem)",
    "prefix_depth": f"WITH {CODES} SELECT a.anime_id, len(list_filter(a.codes, lambda x, i: x <> b.codes[i])) / 8.0::DOUBLE AS distance, CAST(coalesce(list_position(list_transform(a.codes, lambda x, i: x = b.codes[i]), false) - 1, 8) AS INTEGER) AS prefix FROM codes a JOIN codes b ON b.anime_id = a.anime_id + 1",
    "cluster_buckets": f"WITH {_TK} SELECT tokens[1] AS first_token, CAST(count(*) AS BIGINT) AS bucket_size, min(anime_id) AS first_id FROM tk GROUP BY 1 HAVING count(*) >= 3",
    "bucket_purity": f"""WITH {_TK}, {PREP}, g AS (SELECT tk.anime_id, tokens[1] AS t, {_GS} AS g FROM tk JOIN prep ON prep.anime_id = tk.anime_id),
      b AS (SELECT t, count(*) AS n, min(anime_id) AS f FROM g GROUP BY 1 HAVING count(*) >= 5 ORDER BY 2 DESC, 3 LIMIT 20),
      s AS (SELECT * FROM (SELECT g.t, g.g, row_number() OVER (PARTITION BY g.t ORDER BY md5('42:' || anime_id), anime_id) AS r FROM g JOIN b ON b.t = g.t) WHERE r <= 10 AND len(g) > 0),
      p AS (SELECT x.t, avg(len(list_intersect(x.g, y.g)) / CAST(len(list_distinct(list_concat(x.g, y.g))) AS DOUBLE)) AS j FROM s x JOIN s y ON x.t = y.t AND x.r < y.r GROUP BY 1)
      SELECT b.t AS first_token, CAST(b.n AS BIGINT) AS bucket_size, round(p.j, 9) AS avg_genre_jaccard FROM b LEFT JOIN p ON p.t = b.t""",
    "code_usage_perplexity": f"WITH {CODES}, h AS (SELECT c, count(*) AS n FROM (SELECT unnest(codes) AS c FROM codes) GROUP BY 1) SELECT count(*) AS used, round(count(*) * 100.0 / 2048, 6) AS used_pct, round(exp(-sum(n / t * ln(n / t))), 6) AS perplexity FROM h, (SELECT CAST(sum(n) AS DOUBLE) AS t FROM h)",
    "code_histogram": f"WITH {CODES} SELECT c AS code, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(codes) AS c FROM codes) GROUP BY 1",
    "vector_norm": "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 5) AS norm FROM embeddings",
    "faulty_vectors": "SELECT reason, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> embedding_dim THEN 'length' WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'not finite' END AS reason FROM anime_embeddings) WHERE reason IS NOT NULL GROUP BY 1",
    "dimension_range": "SELECT CAST(min(len(embedding)) AS INTEGER) AS least, CAST(max(len(embedding)) AS INTEGER) AS most FROM embeddings",
    "named_embeddings": f"WITH {PREP} SELECT e.anime_id, model_name, coalesce(name, '') AS name, coalesce(english_name, '') AS english_name, coalesce(genres, '') AS genres, CAST(count(*) AS BIGINT) AS n FROM anime_embeddings e JOIN prep ON prep.anime_id = e.anime_id GROUP BY ALL",
    "metadata": f"WITH {PREP}, {CODES} SELECT anime_id, name, type, source FROM prep WHERE anime_id IN (SELECT anime_id FROM codes)",
    "shared_semantic_ids": f"WITH {SEM} SELECT semantic_id, CAST(count(*) AS BIGINT) AS n, min(anime_id) AS first_id FROM sem GROUP BY 1",
    "code_means": f"WITH {CODES} SELECT anime_id, round(avg(c / 2048.0::DOUBLE), 9) AS m1, round(avg(CAST(c % 7 AS DOUBLE)), 9) AS m2 FROM (SELECT anime_id, unnest(codes) AS c FROM codes) WHERE c BETWEEN 0 AND 2047 GROUP BY 1",
}
ORACLES["global_purity"] = f"SELECT count(*) AS inspected_buckets, round(avg(avg_genre_jaccard), 9) AS global_avg_genre_jaccard FROM ({ORACLES['bucket_purity']})"
