"""Instruction pairs from rows of several layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions.text import collapse, strip


def instruction_text(question: Column, answer: Column) -> Column:
    """One text of system, user and assistant turns."""
    return F.concat(F.lit("<|system|>\nYou are a helpful assistant.\n<|user|>\n"), question, F.lit("\n<|assistant|>\n"), answer)


def _clean(value: Column) -> Column:
    return F.coalesce(collapse(value.cast("string")), F.lit(""))


def _turns(df: DataFrame, name: str, role_names: tuple[str, ...], text_names: tuple[str, ...]) -> tuple[Column, Column]:
    """First non-empty user and assistant turns of an array of structs."""
    inner = df.schema[name].dataType.elementType.fieldNames()

    def pick(x: Column, names: tuple[str, ...]) -> Column:
        there = [F.nullif(x[n].cast("string"), F.lit("")) for n in names if n in inner]
        return F.coalesce(*there, F.lit(""))

    turns = F.transform(F.filter(F.col(name), lambda x: x.isNotNull()), lambda x: F.struct(F.lower(strip(pick(x, role_names))).alias("r"), _clean(pick(x, text_names)).alias("t")))

    def first(roles: tuple[str, ...]) -> Column:
        return F.coalesce(F.get(F.filter(turns, lambda x: x["r"].isin(*roles) & (x["t"] != "")), F.lit(0))["t"], F.lit(""))

    return first(("human", "user")), first(("gpt", "assistant"))


def question_answer(df: DataFrame) -> Column:
    """(question, answer) struct by the first layout that gives both: instruction/output,
    prompt/response, conversations, messages; null if none does."""
    found = []

    def both(q: Column, a: Column) -> Column:
        return F.when((q != "") & (a != ""), F.struct(q.alias("question"), a.alias("answer")))

    kinds = {f.name: f.dataType for f in df.schema}
    if "instruction" in kinds and "output" in kinds:
        extra = _clean(F.col("input")) if "input" in kinds else F.lit("")
        q = _clean(F.col("instruction"))
        found.append(both(F.when(extra != "", strip(F.concat(q, F.lit("\n"), extra))).otherwise(q), _clean(F.col("output"))))
    if "prompt" in kinds and "response" in kinds:
        found.append(both(_clean(F.col("prompt")), _clean(F.col("response"))))
    for name, roles, texts in (("conversations", ("from", "role"), ("value", "content")), ("messages", ("role",), ("content",))):
        if isinstance(kinds.get(name), T.ArrayType) and isinstance(kinds[name].elementType, T.StructType):
            found.append(both(*_turns(df, name, roles, texts)))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<question: string, answer: string>")


def general_rows(df: DataFrame, source: str) -> DataFrame:
    """(task 'GEN', input, output, source) of rows that have a question and an answer."""
    rows = df.select(question_answer(df).alias("x")).where("x is not null")
    return rows.select(F.lit("GEN").alias("task"), F.col("x.question").alias("input"), F.col("x.answer").alias("output"), F.lit(source).alias("source"))


def domain_rows(df: DataFrame, limit: int = 0) -> DataFrame:
    """(task, input, output, source) of usable rows; an unknown task is an error."""
    task = strip(F.col("task"))
    checked = F.when(task.isin("A", "B", "C"), task).otherwise(F.raise_error(F.concat(F.lit("unknown task: "), F.coalesce(task, F.lit("null")))))
    rows = df.select(checked.alias("task"), strip(F.coalesce("input", F.lit(""))).alias("input"), strip(F.coalesce("output", F.lit(""))).alias("output"), F.lit("domain").alias("source"))
    rows = rows.where("input <> '' and output <> ''")
    return rows.limit(limit) if limit > 0 else rows


def capped_sources(df: DataFrame, source: str, most: int, order: Column) -> DataFrame:
    """At most ``most`` rows of each source in the given order (0: all); a sampling step."""
    if most <= 0:
        return df
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(source).orderBy(order))).where(F.col("_r") <= most).drop("_r")


def first_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, question, answer) from rows (conv_id, turn, role, text): first filled turn of each side."""
    text = collapse(F.col("text"))
    first = lambda role: F.min_by(F.when((F.col("role") == role) & (text != ""), text), F.when((F.col("role") == role) & (text != ""), F.col("turn")))
    return turns.groupBy("conv_id").agg(first("user").alias("question"), first("assistant").alias("answer")).where("question is not null and answer is not null")


def evaluation_texts(df: DataFrame, most: int) -> DataFrame:
    """Stripped texts of at least eight characters, the first ``most``."""
    return df.select(strip(F.col("text")).alias("text")).where(F.length("text") >= 8).limit(most)


def perplexity(losses: DataFrame) -> DataFrame:
    """exp of the mean finite loss, the mean being at most 20."""
    finite = F.when(~F.isnan("loss") & (F.abs("loss") < float("inf")), F.col("loss"))
    return losses.agg(F.exp(F.least(F.avg(finite), F.lit(20.0))).alias("perplexity"))


def placeholder_general(df: DataFrame, most: int) -> DataFrame:
    """General rows made of domain rows, for dry runs."""
    return df.select(F.lit("GEN").alias("task"), F.concat(F.lit("Explain in plain English: "), F.col("input")).alias("input"), "output", F.lit("dry_run").alias("source")).limit(most)
