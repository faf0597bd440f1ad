"""Conversations: rows of conv_id, turn, role, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.text import has_only_non_ascii_messages, spaces_word_count


def cleaned(turns: DataFrame, least_turns: int = 2, most_turns: int | None = None, least_chars: int | None = None, most_chars: int | None = None) -> DataFrame:
    """Conversations that start with the user and strictly alternate; leading other roles go first, then the rest is cut.

    A message outside the length bounds drops its conversation. Grouped by conversation, bounded by its turns.
    """
    w = Window.partitionBy("conv_id").orderBy("turn")
    started = F.max((F.col("role") == "user").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    rows = turns.withColumn("_s", started).filter("_s").drop("_s").withColumn("n", F.row_number().over(w))
    if most_turns is not None:
        rows = rows.filter(F.col("n") <= most_turns)
    good = F.col("role") == F.when(F.col("n") % 2 == 1, "user").otherwise("assistant")
    if least_chars is not None:
        good = good & (F.length("text") >= least_chars)
    if most_chars is not None:
        good = good & (F.length("text") <= most_chars)
    whole = Window.partitionBy("conv_id")
    marked = rows.withColumn("_ok", F.min(F.coalesce(good, F.lit(False))).over(whole)).withColumn("_n", F.count("*").over(whole))
    return marked.filter(F.col("_ok") & (F.col("_n") >= least_turns)).drop("_ok", "_n")


def non_ascii_only(turns: DataFrame) -> DataFrame:
    """Conversations in which every message has a non-ASCII character: the observed content filter."""
    ok = turns.groupBy("conv_id").agg(F.collect_list(F.coalesce("text", F.lit(""))).alias("m")).filter(has_only_non_ascii_messages(F.col("m"))).select("conv_id")
    return turns.join(ok, "conv_id", "left_semi")


def stitched(parts: DataFrame) -> DataFrame:
    """conv, n, role, text from parts (id ``conv_k``, pos, role, text): a part's first turn goes if its role is that of the last one before."""
    rows = parts.withColumn("conv", F.split("id", "_")[0]).withColumn("part", F.coalesce(F.split("id", "_")[1].try_cast("int"), F.lit(0)))
    w = Window.partitionBy("conv").orderBy("part", "pos")
    first = F.row_number().over(Window.partitionBy("conv", "part").orderBy("pos")) == 1
    rows = rows.withColumn("_drop", first & F.coalesce(F.lag("role").over(w) == F.col("role"), F.lit(False))).filter("NOT _drop")
    return rows.withColumn("n", F.row_number().over(w)).select("conv", "n", "role", "text")


def statistics(turns: DataFrame) -> DataFrame:
    """conv_id, turns, words and characters per role."""
    words = spaces_word_count(F.col("text"))

    def of(role: str, value):
        return F.sum(F.when(F.col("role") == role, value).otherwise(0))

    return turns.groupBy("conv_id").agg(
        F.count("*").alias("turns"),
        of("user", words).alias("user_words"),
        of("assistant", words).alias("assistant_words"),
        of("user", F.length("text")).alias("user_chars"),
        of("assistant", F.length("text")).alias("assistant_chars"),
    )


def between_turns(turns: DataFrame, time: str, unit: float = 1000.0) -> DataFrame:
    """Adds ``since_last``: time since the previous turn of the conversation, in units of 1000."""
    return turns.withColumn("since_last", (F.col(time) - F.lag(time).over(Window.partitionBy("conv_id").orderBy(time))) / unit)


def prompt_sizes(turns: DataFrame, size=None) -> DataFrame:
    """conv_id, turn, prompt: size of the whole history at every user turn."""
    size = F.length("text") if size is None else size
    running = F.sum(size).over(Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0))
    return turns.withColumn("prompt", running).filter("role = 'user'").select("conv_id", "turn", "prompt")


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by seeded hash: the same rows whenever it runs."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def few_shot_prompts(questions: DataFrame, examples: DataFrame) -> DataFrame:
    """question id, prompt: all examples in order, then the question. The example list is a fixed small prefix."""
    shots = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "question", "answer"))), lambda e: F.concat(F.lit("Question: "), e["question"], F.lit("\nAnswer: "), e["answer"], F.lit("\n\n"))), "")
    prefix = examples.agg(shots.alias("_prefix"))
    return questions.crossJoin(F.broadcast(prefix)).select("id", F.concat("_prefix", F.lit("Question: "), "question", F.lit("\nAnswer:")).alias("prompt"))
