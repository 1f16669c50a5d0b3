"""Queries on histories, prompts, tasks, sampling and instruction data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.codebooks import weighted_means
from seqloom.operators.instructions import domain_rows, general_rows, instruction_text, perplexity
from seqloom.operators.sampling import held_out, numbered, quotas, running_totals, sample_groups, sample_to_quota, stage_mix
from seqloom.operators.sequences import histories, known_interactions, liked_items, mask_positions, masked_rows, scan_statistics, seeds, sentiment, user_sequences, users_until_full
from seqloom.operators.tasks import fact_rows, item_facts, liked_rows, template_counts, year_spread
from seqloom.plans.runs import training_summary
from seqloom.plans.training_set import PrepSettings, pools, training_set
from seqloom.queries.common import PREP, SEM, UA, collapse, interactions, names, one_prep, semantic
from seqloom.session import checkpoint, table


def _known(spark: SparkSession, d: str) -> DataFrame:
    """Known interactions, written once: histories and likes would each merge the log again."""
    return checkpoint(known_interactions(interactions(spark, d), semantic(spark, d)))


def _history(spark: SparkSession, d: str) -> DataFrame:
    return histories(_known(spark, d))


def user_history(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d).where("valid").select("user_id", "pos", "anime_id", "history_len")


def sentiments(spark: SparkSession, d: str) -> DataFrame:
    return interactions(spark, d).groupBy(sentiment(F.col("score"), F.col("watching_status")).alias("mark"), "watching_status").agg(F.count("*").alias("n"))


def _prompts(spark: SparkSession, d: str, mode: str) -> DataFrame:
    rows = masked_rows(user_sequences(_history(spark, d), semantic(spark, d)), (mode,))
    return rows.select("user_id", "input", "output", "meta.mask_index", "meta.history_len")


def mask_last(spark: SparkSession, d: str) -> DataFrame:
    return _prompts(spark, d, "last")


def mask_random(spark: SparkSession, d: str) -> DataFrame:
    return _prompts(spark, d, "random").select("user_id", "mask_index", "history_len", F.length("input").alias("chars"), "output")


def mask_both(spark: SparkSession, d: str) -> DataFrame:
    """Distinct masked positions of every length of history."""
    lengths = spark.range(0, 40).select(F.col("id").alias("user_id"), F.col("id").cast("int").alias("n"))
    masks = lengths.select("user_id", F.explode(mask_positions(F.col("user_id"), F.col("n"), ("last", "random", "last"), 7)).alias("m"))
    return masks.select("user_id", "m.mode", F.col("m.index").alias("position"))


def liked_top3(spark: SparkSession, d: str) -> DataFrame:
    known = _known(spark, d)
    return liked_items(histories(known), known).select("user_id", F.array_join(F.transform("liked", lambda x: x.cast("string")), ",").alias("liked"))


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    known = _known(spark, d)
    return checkpoint(seeds(liked_items(histories(known), known)))


def seed_kinds(spark: SparkSession, d: str) -> DataFrame:
    return _seeds(spark, d).groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.element_at("anime_ids", 1)).alias("id_sum"))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return checkpoint(item_facts(semantic(spark, d), one_prep(spark, d)))


def task_c_single(spark: SparkSession, d: str) -> DataFrame:
    return liked_rows(_seeds(spark, d).where("kind = 'single'"), _facts(spark, d)).select("user_id", "input", "output")


def task_c_triple(spark: SparkSession, d: str) -> DataFrame:
    return liked_rows(_seeds(spark, d).where("kind = 'triple'"), _facts(spark, d)).select("user_id", "input", "output")


def spread(spark: SparkSession, d: str) -> DataFrame:
    return year_spread(_seeds(spark, d).where("kind = 'triple'"), _facts(spark, d))


def task_a(spark: SparkSession, d: str) -> DataFrame:
    return fact_rows(_facts(spark, d)).select(F.element_at("anime_ids", 1).alias("anime_id"), "meta.template_id", "input", "output")


def task_a_counts(spark: SparkSession, d: str) -> DataFrame:
    return template_counts(fact_rows(_facts(spark, d), 7))


def scan_stats(spark: SparkSession, d: str) -> DataFrame:
    return scan_statistics(interactions(spark, d), semantic(spark, d))


def _per_user(spark: SparkSession, d: str) -> DataFrame:
    n = interactions(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return n.select("user_id", F.when(F.col("n") >= 4, 2).otherwise(0).cast("bigint").alias("masks"), F.when(F.col("n") >= 3, 2).otherwise(1).cast("bigint").alias("seeds"))


def early_stop(spark: SparkSession, d: str) -> DataFrame:
    return users_until_full(_per_user(spark, d), 400, 600)


def running(spark: SparkSession, d: str) -> DataFrame:
    return running_totals(table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price")), "o_orderkey", ("price",)).select("o_orderkey", F.col("place").cast("bigint").alias("place"), F.col("price_before").cast("double").alias("before"))


def quota_sample(spark: SparkSession, d: str) -> DataFrame:
    return sample_to_quota(table(spark, d, "orders").select("o_orderkey"), 500, ["o_orderkey"], 7)


def oversample(spark: SparkSession, d: str) -> DataFrame:
    """Seven rows for a quota of twenty: two whole cycles and six more."""
    pool = table(spark, d, "nation").where("n_nationkey < 7").select("n_nationkey")
    return sample_to_quota(pool, 20, ["n_nationkey"], 7).groupBy("n_nationkey").agg(F.count("*").alias("n"))


def train_eval(spark: SparkSession, d: str) -> DataFrame:
    return held_out(table(spark, d, "orders").select("o_orderkey"), 0.1, ["o_orderkey"], 7)


def example_ids(spark: SparkSession, d: str) -> DataFrame:
    return numbered(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], 7)


def _domain(spark: SparkSession, d: str) -> DataFrame:
    return domain_rows(table(spark, d, "llm_prep_train").withColumn("task", F.upper("task")))


def domain_counts(spark: SparkSession, d: str) -> DataFrame:
    return _domain(spark, d).groupBy("task").agg(F.count("*").alias("n"), F.sum(F.length("input")).alias("chars"))


def mixed_stage(spark: SparkSession, d: str) -> DataFrame:
    general = general_rows(table(spark, d, "documents").select(F.col("source").alias("instruction"), F.col("text").alias("output")), "documents")
    mixed = stage_mix(_domain(spark, d), general, {"A": 0.85, "B": 0.10, "C": 0.05}, 0.15, ["task", "input", "output"])
    return mixed.groupBy("task").agg(F.count("*").alias("n"))


def group_quotas(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("p"))
    return sample_groups(rows, "p", {"1-URGENT": 100, "2-HIGH": 50}, ["o_orderkey"], 3)


def question_answers(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "llm_prep_train").select("example_id", F.col("input").alias("prompt"), F.col("output").alias("response"))
    return general_rows(rows, "examples").groupBy("task", "source").agg(F.count("*").alias("n"), F.sum(F.length("input")).alias("chars_in"), F.sum(F.length("output")).alias("chars_out"))


def instruction_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "llm_prep_train").where("input is not null and output is not null").select("example_id", instruction_text(F.col("input"), F.col("output")).alias("text"))


def quota_table(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of several targets, halves rounded to the even number."""
    rows = [(t, *quotas(t, 0.5, 0.25).values()) for t in (1, 2, 3, 5, 6, 10, 11, 399_999, 400_000)]
    return spark.createDataFrame(rows, "target long, a long, b long, c long")


def assembled(spark: SparkSession, d: str) -> DataFrame:
    """A whole training set of 4,000 rows: rows, distinct ids and distinct users of each task."""
    rows = training_set(interactions(spark, d), semantic(spark, d), one_prep(spark, d), PrepSettings(target_examples=4000, stop_early=True))
    return rows.groupBy("task").agg(F.count("*").alias("n"), F.count_distinct("example_id").alias("ids"))


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.sum(F.length("input")).alias("chars_in"), F.sum(F.length("output")).alias("chars_out")]


def pool_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Rows, users and characters of each task over all users, before any draw."""
    made = pools(interactions(spark, d), semantic(spark, d), one_prep(spark, d)).values()
    a, b, c = (p.select("task", "user_id", "input", "output") for p in made)
    rows = a.unionByName(b).unionByName(c)
    return rows.groupBy("task").agg(*_sums())


def assembled_full(spark: SparkSession, d: str) -> DataFrame:
    """The training set of a full run, drawn from all users: rows, ids, users and characters of each task."""
    rows = training_set(interactions(spark, d), semantic(spark, d), one_prep(spark, d))
    return rows.groupBy("task").agg(*_sums(), F.count_distinct("example_id").alias("ids"))


def example_summary(spark: SparkSession, d: str) -> DataFrame:
    return training_summary(table(spark, d, "llm_prep_train"))


def epoch_means(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_quantity").alias("w"), F.col("l_discount").alias("loss"), F.col("l_tax").alias("commit"))
    return weighted_means(rows, "w", ["loss", "commit"]).select("weight", F.round("loss", 9).alias("loss"), F.round("commit", 9).alias("commit"))


def loss_perplexity(spark: SparkSession, d: str) -> DataFrame:
    return perplexity(table(spark, d, "lineitem").select((F.col("l_discount") * 10).alias("loss"))).select(F.round("perplexity", 6).alias("perplexity"))


_KN = f"{UA}, {SEM}, kn AS (SELECT ua.* FROM ua WHERE watching_status IN (1, 2, 3, 4, 6) AND anime_id IN (SELECT anime_id FROM sem))"
_HI = _KN + """, hi AS (SELECT *, CAST(least(total, 30) AS INTEGER) AS history_len, CAST(least(total, 30) - r AS INTEGER) AS pos FROM (
  SELECT *, count(*) OVER (PARTITION BY user_id) AS total, row_number() OVER (PARTITION BY user_id ORDER BY scraped_at DESC NULLS LAST, watching_status DESC, score ASC, watched_episodes ASC NULLS FIRST, anime_id DESC) AS r FROM kn) WHERE r <= 30)"""
_MARK = "CASE WHEN watching_status = 4 THEN '<dropped>' WHEN score >= 7 THEN '<liked>' WHEN score > 0 AND score <= 3 THEN '<disliked>' ELSE '<watch>' END"
_RAND = "CAST(CAST('0x' || substr(md5('{seed}:' || user_id), 1, 8) AS BIGINT) % greatest(1, {n} - 1) AS INTEGER)"
_PR = _HI + """, pr AS (SELECT user_id, history_len, {mask} AS mask_index, string_agg(CASE WHEN pos = 0 THEN 'A user watched ' ELSE 'then watched ' END || '<anime_start>' || CASE WHEN pos = {mask} THEN '[MASK]' ELSE semantic_id END || '<anime_end>' || CASE WHEN pos = {mask} THEN '' ELSE ' ' || {mark} END, ' ' ORDER BY pos) AS input,
  max(CASE WHEN pos = {mask} THEN semantic_id END) AS output FROM hi JOIN sem ON sem.anime_id = hi.anime_id WHERE total >= 4 GROUP BY 1, 2)"""
_LAST = _PR.format(mask="history_len - 1", mark=_MARK)
_RND = _PR.format(mask=_RAND.format(seed=42, n="history_len"), mark=_MARK)
_LK = _HI + """, lr AS (SELECT user_id, anime_id, score FROM hi WHERE total >= 4 UNION ALL SELECT user_id, anime_id, score FROM kn WHERE user_id NOT IN (SELECT user_id FROM hi WHERE total >= 4)),
  lk AS (SELECT * FROM (SELECT user_id, anime_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, anime_id) AS r FROM lr WHERE score >= 7) WHERE r <= 3)"""
_FACT = PREP + ", fa AS (SELECT prep.anime_id, " + ", ".join(f"coalesce({collapse(c)}, '') AS {c}" for c in ("name", "english_name", "genres", "synopsis", "studios", "premiered", "type", "source")) + ", CASE WHEN year >= 0 THEN year END AS year FROM prep)"
_GEN, _STU = f"({names('genres')})", f"({names('studios')})"


def _join(x: str) -> str:
    return f"CASE len({x}) WHEN 0 THEN '' WHEN 1 THEN {x}[1] WHEN 2 THEN {x}[1] || ' and ' || {x}[2] ELSE array_to_string({x}[1:len({x}) - 1], ', ') || ', and ' || {x}[len({x})] END"


_G3 = f"{_GEN}[1:3]"
_CL = f"list_filter([{_join('g3')}, CASE WHEN type <> '' THEN lower(type) || ' storytelling' ELSE '' END, CASE WHEN source <> '' THEN lower(source) || '-inspired worldbuilding' ELSE '' END], lambda x: x <> '')"
_SINGLE = f"""WITH {_LK}, {_FACT}, g AS (SELECT *, {_G3} AS g3 FROM fa), cl AS (SELECT anime_id, {_CL} AS c FROM g)
  SELECT lk.user_id, sem.semantic_id || ' is interesting to fans of' AS input, CASE len(c) WHEN 0 THEN 'character-focused stories, strong atmosphere, and thematic depth' WHEN 1 THEN c[1] ELSE array_to_string(c[1:len(c) - 1], ', ') || ', and ' || c[len(c)] END AS output
  FROM lk JOIN sem ON sem.anime_id = lk.anime_id JOIN cl ON cl.anime_id = lk.anime_id WHERE r = 1"""
_TRIPLE = f"""WITH {_LK}, {_FACT}, t AS (SELECT lk.user_id, lk.r, sem.semantic_id, {_GEN} AS gl, {_STU} AS sl, studios, year, type FROM lk JOIN sem ON sem.anime_id = lk.anime_id JOIN fa ON fa.anime_id = lk.anime_id),
  u AS (SELECT user_id, 'A user who liked ' || string_agg(semantic_id, ' and ' ORDER BY r) || ' would enjoy these anime because they share' AS input, count_if(len(gl) > 0) AS ng, count_if(studios <> '') AS ns, min(year) AS y0, max(year) AS y1,
    count(DISTINCT nullif(type, '')) AS nt, max(type) AS ty FROM t GROUP BY 1 HAVING count(*) = 3),
  gx AS (SELECT user_id, r, x.g AS g, x.i AS i FROM (SELECT user_id, r, unnest(list_transform(gl, lambda g, i: {{'g': g, 'i': i}})) AS x FROM t)),
  gc AS (SELECT user_id, g, count(*) AS c, min(r * 1000 + i) AS f FROM gx GROUP BY 1, 2),
  sh AS (SELECT gc.user_id, list(g ORDER BY encode(g)) FILTER (WHERE c = ng) AS both_g, (list(g ORDER BY c DESC, f))[1:3] AS top FROM gc JOIN u ON u.user_id = gc.user_id GROUP BY 1),
  sc AS (SELECT user_id, s, count(*) AS c FROM (SELECT user_id, unnest(sl) AS s FROM t) GROUP BY 1, 2), ss AS (SELECT sc.user_id, list(s ORDER BY encode(s)) FILTER (WHERE c = ns) AS both_s FROM sc JOIN u ON u.user_id = sc.user_id GROUP BY 1),
  cl AS (SELECT u.user_id, input, coalesce(both_g[1:3], []) AS a, coalesce(top, []) AS b, coalesce(both_s[1:2], []) AS h, y0, y1, nt, ty FROM u LEFT JOIN sh ON sh.user_id = u.user_id LEFT JOIN ss ON ss.user_id = u.user_id),
  cc AS (SELECT user_id, input, list_filter([CASE WHEN len(a) > 0 THEN {_join('a')} || ' themes' WHEN len(b) > 0 THEN {_join('b')} || ' elements' END, CASE WHEN len(h) > 0 THEN 'production style from ' || {_join('h')} END,
    CASE WHEN y0 = y1 THEN 'a similar ' || y0 || ' era tone' WHEN y1 - y0 <= 6 THEN 'closely aligned ' || y0 || '-' || y1 || ' era pacing' END, CASE WHEN nt = 1 THEN lower(ty) || ' storytelling rhythms' END], lambda x: x IS NOT NULL) AS c FROM cl)
  SELECT user_id, input, CASE WHEN len(c) = 0 THEN 'overlapping tone, pacing, and character-driven conflicts' ELSE {_join('c')} END AS output FROM cc"""
_A = f"""ta AS (SELECT fa.*, semantic_id AS s, coalesce(nullif(english_name, ''), nullif(name, ''), 'Unknown') AS t, coalesce(CAST(year AS VARCHAR), premiered, '') AS y, array_to_string({_G3}, ', ') AS th FROM fa JOIN sem ON sem.anime_id = fa.anime_id),
  tb AS (SELECT anime_id, unnest(list_filter([{{'t': 'sid_to_title', 'ok': true, 'i': 'The anime ' || s || ' has the title', 'o': t}}, {{'t': 'title_to_sid', 'ok': true, 'i': 'The anime titled ''' || t || ''' has semantic id', 'o': s}},
  {{'t': 'sid_to_genres', 'ok': genres <> '', 'i': 'The anime ' || s || ' belongs to genres', 'o': genres}}, {{'t': 'title_to_genres', 'ok': genres <> '', 'i': 'The anime titled ''' || t || ''' belongs to genres', 'o': genres}},
  {{'t': 'sid_to_studio', 'ok': studios <> '', 'i': 'The anime ' || s || ' is produced by studio', 'o': studios}}, {{'t': 'title_studio_to_sid', 'ok': studios <> '', 'i': 'The anime titled ''' || t || ''' by studio ' || studios || ' has semantic id', 'o': s}},
  {{'t': 'sid_to_year', 'ok': y <> '', 'i': 'The anime ' || s || ' released in year', 'o': y}}, {{'t': 'title_year_to_sid', 'ok': y <> '', 'i': 'The anime titled ''' || t || ''' released in ' || y || ' has semantic id', 'o': s}},
  {{'t': 'sid_to_synopsis', 'ok': synopsis <> '', 'i': 'The anime ' || s || ' synopsis:', 'o': synopsis}}, {{'t': 'sid_to_themes', 'ok': th <> '', 'i': 'The anime ' || s || ' has notable themes', 'o': th}}], lambda x: x.ok)[1:{{most}}]) AS x FROM ta)"""
_PU = f"{UA}, pu AS (SELECT user_id, CASE WHEN count(*) >= 4 THEN 2 ELSE 0 END AS masks, CASE WHEN count(*) >= 3 THEN 2 ELSE 1 END AS seeds FROM ua GROUP BY 1)"
_MD = "md5('{seed}' || chr(31) || {k})"

_PO = f"""po AS (SELECT 'A' AS task, CAST(NULL AS BIGINT) AS user_id, {collapse('x.i')} AS input, {collapse('x.o')} AS output FROM (WITH {SEM}, {_FACT}, {_A.replace("{most}", "12")} SELECT x FROM tb)
  UNION ALL SELECT 'B', user_id, input, output FROM (WITH {_LAST} SELECT user_id, input, output FROM pr) UNION ALL SELECT 'B', user_id, input, output FROM (WITH {_RND} SELECT user_id, input, output FROM pr)
  UNION ALL SELECT 'C', user_id, input, output FROM ({_SINGLE}) UNION ALL SELECT 'C', user_id, input, output FROM ({_TRIPLE}))"""
# whole cycles of a pool that is too small, and a seeded draw of the rest
_DRAWN = _PO + """, si AS (SELECT task, count(*) AS m, CASE task WHEN 'A' THEN 200000 ELSE 100000 END AS q FROM po GROUP BY 1),
  us AS (SELECT *, q // m + CASE WHEN row_number() OVER (PARTITION BY task ORDER BY md5(CAST(42 + q // m AS VARCHAR) || chr(31) || task || chr(31) || input || chr(31) || output || chr(31) || coalesce(CAST(user_id AS VARCHAR), ''))) <= q % m THEN 1 ELSE 0 END AS uses
    FROM po JOIN si USING (task))"""

QUERIES = {
    "user_history_topn": user_history, "sentiment_label": sentiments, "mask_last": mask_last, "mask_random_hash": mask_random, "mask_positions": mask_both, "liked_top3": liked_top3,
    "task_c_seeds": seed_kinds, "task_c_single": task_c_single, "task_c_triple": task_c_triple, "year_spread": spread, "task_a_templates": task_a, "template_counts": task_a_counts,
    "scan_stats": scan_stats, "early_stop_users": early_stop, "running_totals": running, "quota_sample": quota_sample, "oversample_cycles": oversample, "train_eval_split": train_eval,
    "example_ids": example_ids, "domain_rows": domain_counts, "stage_mix": mixed_stage, "group_quotas": group_quotas, "prompt_response": question_answers, "instruction_format": instruction_format,
    "quota_table": quota_table, "training_set": assembled_full, "training_pools": pool_sizes, "training_set_early_stop": assembled, "example_summary": example_summary, "epoch_means": epoch_means, "perplexity": loss_perplexity,
}
ORACLES = {
    "user_history_topn": f"WITH {_HI} SELECT user_id, pos, anime_id, history_len FROM hi WHERE total >= 4",
    "sentiment_label": f"WITH {UA} SELECT {_MARK} AS mark, watching_status, CAST(count(*) AS BIGINT) AS n FROM ua GROUP BY 1, 2",
    "mask_last": f"WITH {_LAST} SELECT user_id, input, output, CAST(mask_index AS INTEGER) AS mask_index, history_len FROM pr",
    "mask_random_hash": f"WITH {_RND} SELECT user_id, mask_index, history_len, CAST(length(input) AS INTEGER) AS chars, output FROM pr",
    "mask_positions": f"SELECT user_id, mode, CAST(p AS INTEGER) AS position FROM (SELECT user_id, 'last' AS mode, user_id - 1 AS p FROM range(2, 40) t(user_id) UNION ALL SELECT user_id, 'random', {_RAND.format(seed=7, n='user_id')} FROM range(2, 40) t(user_id))",
    "liked_top3": f"WITH {_LK} SELECT user_id, string_agg(anime_id, ',' ORDER BY r) AS liked FROM lk GROUP BY 1",
    "task_c_seeds": f"WITH {_LK}, s AS (SELECT user_id, count(*) AS c, min_by(anime_id, r) AS f FROM lk GROUP BY 1) SELECT 'single' AS kind, CAST(count(*) AS BIGINT) AS n, CAST(sum(f) AS BIGINT) AS id_sum FROM s UNION ALL SELECT 'triple', count(*), CAST(sum(f) AS BIGINT) FROM s WHERE c = 3",
    "task_c_single": _SINGLE,
    "task_c_triple": _TRIPLE,
    "year_spread": f"WITH {_LK}, {_FACT} SELECT user_id, 'triple' AS kind, min(year) AS first_year, max(year) AS last_year, CAST(count(DISTINCT nullif(type, '')) AS BIGINT) AS n_types FROM lk JOIN fa ON fa.anime_id = lk.anime_id WHERE user_id IN (SELECT user_id FROM lk WHERE r = 3) GROUP BY 1",
    "task_a_templates": f"WITH {SEM}, {_FACT}, " + _A.replace("{most}", "12") + f" SELECT anime_id, x.t AS template_id, {collapse('x.i')} AS input, {collapse('x.o')} AS output FROM tb",
    "template_counts": f"WITH {SEM}, {_FACT}, " + _A.replace("{most}", "7") + " SELECT x.t AS template_id, CAST(count(*) AS BIGINT) AS n FROM tb GROUP BY 1",
    "scan_stats": f"WITH {UA}, {SEM}, a AS (SELECT user_id, count(*) AS n, count(sem.anime_id) AS m FROM ua LEFT JOIN sem ON sem.anime_id = ua.anime_id WHERE watching_status IN (1, 2, 3, 4, 6) GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS rows_scanned, count(*) AS users_scanned, CAST(count_if(m >= 4) AS BIGINT) AS users_with_valid_history, CAST(sum(n - m) AS BIGINT) AS dropped_unknown_items, CAST(count_if(m < 4) AS BIGINT) AS dropped_short_history_users FROM a",
    "early_stop_users": f"WITH {_PU}, r AS (SELECT user_id, coalesce(sum(masks) OVER w, 0) AS b, coalesce(sum(seeds) OVER w, 0) AS c FROM pu WINDOW w AS (ORDER BY user_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT user_id FROM r WHERE NOT (b >= 400 AND c >= 600)",
    "running_totals": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS place, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before FROM orders",
    "quota_sample": f"SELECT o_orderkey FROM orders ORDER BY {_MD.format(seed=7, k='o_orderkey')} LIMIT 500",
    "oversample_cycles": f"SELECT n_nationkey, CAST(CASE WHEN row_number() OVER (ORDER BY {_MD.format(seed=9, k='n_nationkey')}) <= 6 THEN 3 ELSE 2 END AS BIGINT) AS n FROM nation WHERE n_nationkey < 7",
    "train_eval_split": f"SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_MD.format(seed=7, k='o_orderkey')}, o_orderkey) <= greatest(1, round_even((SELECT count(*) FROM orders) * 0.1, 0)) THEN 'eval' ELSE 'train' END AS part FROM orders",
    "example_ids": f"SELECT 'prep_' || lpad(CAST(row_number() OVER (ORDER BY {_MD.format(seed=7, k='c_custkey')}, c_custkey) AS VARCHAR), 9, '0') AS example_id, c_custkey FROM customer",
    "domain_rows": "SELECT upper(task) AS task, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(trim(input))) AS BIGINT) AS chars FROM llm_prep_train WHERE trim(input) <> '' AND trim(output) <> '' GROUP BY 1",
    "stage_mix": """WITH t AS (SELECT count(*) AS n FROM llm_prep_train WHERE trim(input) <> '' AND trim(output) <> ''), w AS (SELECT CAST(round_even(n * 0.85, 0) AS BIGINT) AS a, CAST(round_even(n * 0.10, 0) AS BIGINT) AS b, CAST(round_even(n * 0.05, 0) AS BIGINT) AS c FROM t)
      SELECT * FROM (SELECT 'A' AS task, a AS n FROM w UNION ALL SELECT 'B', b FROM w UNION ALL SELECT 'C', c FROM w UNION ALL SELECT 'GEN', CAST(round_even((a + b + c) * 0.15 / 0.85, 0) AS BIGINT) FROM w) WHERE n > 0""",
    "group_quotas": " UNION ALL ".join(f"SELECT * FROM (SELECT o_orderkey, o_orderpriority AS p FROM orders WHERE o_orderpriority = '{p}' ORDER BY {_MD.format(seed=3, k='o_orderkey')} LIMIT {n})" for p, n in (("1-URGENT", 100), ("2-HIGH", 50))),
    "prompt_response": f"SELECT 'GEN' AS task, 'examples' AS source, CAST(count(*) AS BIGINT) AS n, CAST(sum(length({collapse('input')})) AS BIGINT) AS chars_in, CAST(sum(length({collapse('output')})) AS BIGINT) AS chars_out FROM llm_prep_train WHERE {collapse('input')} <> '' AND {collapse('output')} <> ''",
    "instruction_format": "SELECT example_id, '<|system|>' || chr(10) || 'You are a helpful assistant.' || chr(10) || '<|user|>' || chr(10) || input || chr(10) || '<|assistant|>' || chr(10) || output AS text FROM llm_prep_train WHERE input IS NOT NULL AND output IS NOT NULL",
    "quota_table": "SELECT CAST(t AS BIGINT) AS target, CAST(round_even(t * 0.5, 0) AS BIGINT) AS a, CAST(round_even(t * 0.25, 0) AS BIGINT) AS b, CAST(t - round_even(t * 0.5, 0) - round_even(t * 0.25, 0) AS BIGINT) AS c FROM (VALUES (1), (2), (3), (5), (6), (10), (11), (399999), (400000)) v(t)",
    "training_set_early_stop": "SELECT * FROM (VALUES ('A', CAST(2000 AS BIGINT), CAST(2000 AS BIGINT)), ('B', 1000, 1000), ('C', 1000, 1000)) v(task, n, ids)",
    "training_pools": f"WITH {_PO} SELECT task, count(*) AS n, count(DISTINCT user_id) AS users, CAST(sum(length(input)) AS BIGINT) AS chars_in, CAST(sum(length(output)) AS BIGINT) AS chars_out FROM po GROUP BY 1",
    "training_set": f"WITH {_DRAWN} SELECT task, CAST(sum(uses) AS BIGINT) AS n, count(DISTINCT user_id) AS users, CAST(sum(uses * length(input)) AS BIGINT) AS chars_in, CAST(sum(uses * length(output)) AS BIGINT) AS chars_out, CAST(sum(uses) AS BIGINT) AS ids FROM us WHERE uses > 0 GROUP BY 1",
    "example_summary": """SELECT count(*) AS examples, CAST(count_if(task = 'A') AS BIGINT) AS task_a, CAST(count_if(task = 'B') AS BIGINT) AS task_b, CAST(count_if(task = 'C') AS BIGINT) AS task_c,
      count(DISTINCT user_id) AS users, CAST(count_if(len(anime_ids) > 1) AS BIGINT) AS with_several_titles, round(avg(length(input)), 6) AS mean_input, round(avg(length(output)), 6) AS mean_output FROM llm_prep_train""",
    "epoch_means": "SELECT CAST(sum(l_quantity) AS DOUBLE) AS weight, round(sum(l_discount * l_quantity) / sum(l_quantity), 9) AS loss, round(sum(l_tax * l_quantity) / sum(l_quantity), 9) AS commit FROM lineitem",
    "perplexity": "SELECT round(exp(least(avg(l_discount * 10), 20)), 6) AS perplexity FROM lineitem",
}
