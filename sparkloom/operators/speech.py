"""Speech segments: rows of audio, start, end (seconds), speaker, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions.text import strip
from sparkloom.operators.documents import consecutive_groups, joined_text

UNKNOWN = "UNKNOWN"
RATE = 16_000


def fill_gaps(segments: DataFrame, durations: DataFrame, longest: float = 0.5) -> DataFrame:
    """Adds UNKNOWN rows where a segment starts more than ``longest`` after the previous row's end, and up to the duration."""
    w = Window.partitionBy("audio").orderBy("start", "end")
    before = F.lag("end", 1, 0.0).over(w)
    gaps = segments.withColumn("_b", before).filter(F.col("start") > F.col("_b") + longest).select("audio", F.col("_b").alias("start"), F.col("start").alias("end"), F.lit(UNKNOWN).alias("speaker"))
    ends = segments.groupBy("audio").agg(F.max_by("end", F.struct("start", "end")).alias("start"))
    tail = durations.join(ends, "audio", "left").withColumn("start", F.coalesce("start", F.lit(0.0))).filter(F.col("duration") > F.col("start") + longest)
    return segments.select("audio", "start", "end", "speaker").unionByName(gaps).unionByName(tail.select("audio", "start", F.col("duration").alias("end"), F.lit(UNKNOWN).alias("speaker")))


def split_long(segments: DataFrame, most: float = 15.0) -> DataFrame:
    """Pieces of at most ``most`` seconds."""
    n = F.greatest(F.lit(1), F.ceil((F.col("end") - F.col("start")) / most).cast("int"))
    out = segments.withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("start") + F.col("_i") * most
    return out.withColumn("end", F.least("end", start + most)).withColumn("start", start).drop("_i")


def long_enough(segments: DataFrame, samples: str = "samples", least: int = 1600, rate: int = RATE) -> DataFrame:
    """Segments that start inside the audio and have more than ``least`` samples of it."""
    first, last = F.floor(F.col("start") * rate), F.least(F.floor(F.col("end") * rate), F.col(samples))
    return segments.filter((first < F.col(samples)) & (last - first > least))


def valid_transcripts(segments: DataFrame) -> DataFrame:
    """Stripped texts that are not empty and no special token."""
    return segments.withColumn("text", strip(F.coalesce("text", F.lit("")))).filter((F.col("text") != "") & ~F.col("text").startswith("<|"))


def merge_speakers(segments: DataFrame) -> DataFrame:
    """Consecutive segments of a speaker become one: texts joined by a space, the last end."""
    runs = consecutive_groups(segments, ["audio"], ["start", "end"], "speaker")
    order = F.struct("start", "end")
    spans = runs.groupBy("audio", "island").agg(F.min_by("speaker", order).alias("speaker"), F.min("start").alias("start"), F.max_by("end", order).alias("end"))
    return spans.join(joined_text(runs, ["audio", "island"], ["start", "end"], "text", " "), ["audio", "island"]).select("audio", "start", "end", "speaker", "text")


def without_unknown(segments: DataFrame) -> DataFrame:
    """Drops unknown speakers without text."""
    return segments.filter((F.col("speaker") != UNKNOWN) | (strip(F.coalesce("text", F.lit(""))) != ""))


def full_text(segments: DataFrame) -> DataFrame:
    """audio, text of known speakers in order."""
    return joined_text(segments.filter(F.col("speaker") != UNKNOWN), "audio", ["start", "end"], "text", " ")


def speakers(segments: DataFrame) -> DataFrame:
    """audio, speaker, number from 1 in order of first appearance."""
    first = segments.groupBy("audio", "speaker").agg(F.min(F.struct("start", "end")).alias("_f"))
    return first.withColumn("number", F.row_number().over(Window.partitionBy("audio").orderBy("_f", "speaker"))).drop("_f")


def timeline(segments: DataFrame) -> DataFrame:
    """audio, markdown: one line a segment, with times and speaker."""
    def clock(c):
        return F.format_string("%02d:%02d", F.floor(F.col(c) / 60).cast("int"), F.floor(F.col(c) % 60).cast("int"))

    line = F.concat(F.lit("["), clock("start"), F.lit(" - "), clock("end"), F.lit("] **"), F.col("speaker"), F.lit("**: "), F.col("text"))
    return joined_text(segments.withColumn("_l", line), "audio", ["start", "end"], "_l", "\n\n", "markdown")
