"""Prompt and completion rows from catalogue data and liked items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.text import join_phrases, leading_themes, let, preferred_title, prompt_text, split_list, strict_nonnegative_int, year_text

_META = ("template_id", "mask_mode", "mask_index", "history_len", "kind")


def _meta(template: Column, kind: Column | None = None) -> Column:
    return F.struct(
        template.alias("template_id"), F.lit(None).cast("string").alias("mask_mode"), F.lit(None).cast("int").alias("mask_index"),
        F.lit(None).cast("int").alias("history_len"), (F.lit(None).cast("string") if kind is None else kind).alias("kind"),
    )


def item_facts(semantic: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per item with a semantic id and a catalogue row, with its cleaned facts.

    ``catalogue`` may have other columns; only the ten named ones are read, once per
    distinct row.
    """
    text = ("name", "english_name", "genres", "synopsis", "studios", "premiered", "type", "source")
    facts = catalogue.select(F.col("anime_id").cast("long").alias("anime_id"), *[prompt_text(F.col(c)).alias(c) for c in text], strict_nonnegative_int(F.col("year")).alias("year"))
    one = facts.groupBy("anime_id").agg(F.min(F.struct(*text, "year")).alias("m")).select("anime_id", "m.*")
    sem = semantic.select("anime_id", "semantic_id", *([F.col("genres").alias("sem_genres")] if "genres" in semantic.columns else [F.lit("").alias("sem_genres")]))
    return sem.join(one, "anime_id").withColumn("title", preferred_title(F.col("english_name"), F.col("name")))


def fact_rows(facts: DataFrame, most: int = 12) -> DataFrame:
    """Task A rows: up to ten templates an item, in fixed order, the first ``most`` of them."""
    sid, title = F.col("semantic_id"), F.col("title")
    genres = F.coalesce(F.nullif("genres", F.lit("")), prompt_text(F.col("sem_genres")))
    year = year_text(F.col("year"), F.col("premiered"))
    studios, synopsis, themes = F.col("studios"), F.col("synopsis"), leading_themes(genres)
    always = F.lit(True)

    def say(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    # The wording of each template.
    templates = [
        ("sid_to_title", always, say("The anime ", sid, " has the title"), title),
        ("title_to_sid", always, say("The anime titled '", title, "' has semantic id"), sid),
        ("sid_to_genres", genres != "", say("The anime ", sid, " belongs to genres"), genres),
        ("title_to_genres", genres != "", say("The anime titled '", title, "' belongs to genres"), genres),
        ("sid_to_studio", studios != "", say("The anime ", sid, " is produced by studio"), studios),
        ("title_studio_to_sid", studios != "", say("The anime titled '", title, "' by studio ", studios, " has semantic id"), sid),
        ("sid_to_year", year != "", say("The anime ", sid, " released in year"), year),
        ("title_year_to_sid", year != "", say("The anime titled '", title, "' released in ", year, " has semantic id"), sid),
        ("sid_to_synopsis", synopsis != "", say("The anime ", sid, " synopsis:"), synopsis),
        ("sid_to_themes", themes != "", say("The anime ", sid, " has notable themes"), themes),
    ]
    every = F.array(*[F.struct(F.lit(t).alias("t"), ok.alias("ok"), prompt_text(i).alias("i"), prompt_text(o).alias("o")) for t, ok, i, o in templates])
    rows = facts.select("anime_id", F.explode(F.slice(F.filter(every, lambda x: x["ok"]), 1, max(1, most))).alias("x"))
    return rows.select(
        F.lit("A").alias("task"), F.col("x.i").alias("input"), F.col("x.o").alias("output"), F.array("anime_id").alias("anime_ids"),
        F.lit(None).cast("long").alias("user_id"), _meta(F.col("x.t")).alias("meta"),
    )


def template_counts(rows: DataFrame) -> DataFrame:
    """Rows of each template."""
    return rows.groupBy(F.col("meta.template_id").alias("template_id")).agg(F.count("*").alias("n"))


def anchor_reasoning(genres: Column, kind: Column, source: Column) -> Column:
    """What one item offers, from its list of genres, type and source."""
    clauses = F.filter(
        F.array(
            join_phrases(F.slice(genres, 1, 3)),
            F.when(kind != "", F.concat(F.lower(kind), F.lit(" storytelling"))).otherwise(""),
            F.when(source != "", F.concat(F.lower(source), F.lit("-inspired worldbuilding"))).otherwise(""),
        ),
        lambda x: x != "",
    )
    return let(
        clauses,
        lambda c: F.when(F.size(c) == 0, "character-focused stories, strong atmosphere, and thematic depth")
        .when(F.size(c) == 1, F.get(c, F.lit(0)))
        .otherwise(F.concat(F.array_join(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), ", "), F.lit(", and "), F.try_element_at(c, F.lit(-1)))),
    )


def _shared(filled: Column) -> Column:
    """Names in every one of the lists, sorted; none of no lists."""
    none = F.array().cast("array<string>")
    return let(filled, lambda x: F.when(F.size(x) > 0, F.array_sort(F.aggregate(x, F.get(x, F.lit(0)), lambda s, y: F.array_intersect(s, y)))).otherwise(none))


def _commonest(lists: Column, most: int = 3) -> Column:
    """The most frequent names, equal ones by first appearance."""

    def ranked(every: Column) -> Column:
        counted = F.transform(F.array_distinct(every), lambda n, i: F.struct((-F.size(F.filter(every, lambda x: x == n))).alias("c"), i.alias("i"), n.alias("n")))
        return F.transform(F.slice(F.array_sort(counted), 1, most), lambda x: x["n"])

    return let(F.flatten(lists), ranked)


def shared_reasoning(facts: Column) -> Column:
    """What several items share; ``facts``: array of (genres, studios, type, year) with lists of names."""
    genres = F.filter(F.transform(facts, lambda x: x["genres"]), lambda g: F.size(g) > 0)
    studios = F.filter(F.transform(facts, lambda x: x["studios"]), lambda s: s.isNotNull())
    years = F.filter(F.transform(facts, lambda x: x["year"]), lambda y: y.isNotNull())
    kinds = F.array_distinct(F.filter(F.transform(facts, lambda x: x["type"]), lambda t: t != ""))
    themes = let(
        _shared(genres),
        lambda both: F.when(F.size(both) > 0, F.concat(join_phrases(F.slice(both, 1, 3)), F.lit(" themes"))).otherwise(
            let(_commonest(genres), lambda top: F.when(F.size(top) > 0, F.concat(join_phrases(top), F.lit(" elements"))))
        ),
    )
    houses = let(_shared(studios), lambda h: F.when(F.size(h) > 0, F.concat(F.lit("production style from "), join_phrases(F.slice(h, 1, 2)))))
    era = let(
        F.struct(F.array_min(years).alias("low"), F.array_max(years).alias("high")),
        lambda y: F.when(y["low"] == y["high"], F.concat(F.lit("a similar "), y["low"].cast("string"), F.lit(" era tone"))).when(
            y["high"] - y["low"] <= 6, F.concat(F.lit("closely aligned "), y["low"].cast("string"), F.lit("-"), y["high"].cast("string"), F.lit(" era pacing"))
        ),
    )
    rhythm = let(kinds, lambda k: F.when(F.size(k) == 1, F.concat(F.lower(F.get(k, F.lit(0))), F.lit(" storytelling rhythms"))))
    clauses = F.filter(F.array(themes, houses, era, rhythm), lambda x: x.isNotNull())
    return let(clauses, lambda c: F.when(F.size(c) == 0, "overlapping tone, pacing, and character-driven conflicts").otherwise(join_phrases(c)))


def liked_rows(seeds: DataFrame, facts: DataFrame) -> DataFrame:
    """Task C rows: a prompt and a reason for every seed (user_id, kind, anime_ids).

    Seeds with an item that has no semantic id are left out.
    """
    known = facts.select("anime_id", "semantic_id", F.struct(split_list(F.col("genres")).alias("genres"), F.when(F.col("studios") != "", split_list(F.col("studios"))).alias("studios"), "type", "source", "year").alias("f"))
    parts = seeds.select("user_id", "kind", "anime_ids", F.posexplode("anime_ids").alias("pos", "anime_id")).join(known, "anime_id")
    rows = parts.groupBy("user_id", "kind", "anime_ids").agg(F.array_sort(F.collect_list(F.struct("pos", "semantic_id", "f"))).alias("x"))  # at most three a seed
    rows = rows.where(F.size("x") == F.size("anime_ids"))
    sid = lambda i: F.try_element_at("x", F.lit(i))["semantic_id"]
    one = F.try_element_at("x", F.lit(1))["f"]
    triple = F.col("kind") == "triple"
    prompt = F.when(triple, F.concat(F.lit("A user who liked "), sid(1), F.lit(" and "), sid(2), F.lit(" and "), sid(3), F.lit(" would enjoy these anime because they share"))).otherwise(
        F.concat(sid(1), F.lit(" is interesting to fans of"))
    )
    reason = F.when(triple, shared_reasoning(F.transform("x", lambda x: x["f"]))).otherwise(anchor_reasoning(one["genres"], one["type"], one["source"]))
    return rows.select(
        F.lit("C").alias("task"), prompt.alias("input"), reason.alias("output"), "anime_ids", "user_id",
        _meta(F.concat(F.lit("reasoning_"), F.col("kind")), F.col("kind")).alias("meta"),
    )


def year_spread(seeds: DataFrame, facts: DataFrame) -> DataFrame:
    """(user_id, kind, first_year, last_year, n_types) over the items of a seed."""
    parts = seeds.select("user_id", "kind", F.explode("anime_ids").alias("anime_id")).join(facts.select("anime_id", "year", "type"), "anime_id")
    return parts.groupBy("user_id", "kind").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_distinct(F.nullif("type", F.lit(""))).alias("n_types"))


def current_semantic_ids(df: DataFrame) -> DataFrame:
    """One row per title, the latest tokenised; ids that are null or blank are left out."""
    from seqloom.functions.instants import instant_micros

    rows = df.where("anime_id is not null and trim(semantic_id) <> ''").withColumn("at", instant_micros(F.col("tokenized_at")))
    rank = F.row_number().over(Window.partitionBy("anime_id").orderBy(F.desc_nulls_last("at"), F.desc("semantic_id")))
    return rows.withColumn("r", rank).where("r = 1").select("anime_id", F.trim("semantic_id").alias("semantic_id"), "level_tokens_json", "codes_json", "name", "english_name")
