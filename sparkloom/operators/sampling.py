"""Token sampling: rows of req, token_id, logit; masks set a logit to minus infinity.

Every operator is a window over one request's vocabulary, so work is partitioned by request and bounded by the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEVER = float("-inf")


def _req() -> Window:
    return Window.partitionBy("req")


def masked(rows: DataFrame, keep: Column) -> DataFrame:
    return rows.withColumn("logit", F.when(keep, F.col("logit")).otherwise(F.lit(NEVER)))


def log_softmax(logit: Column, over) -> Column:
    """x - log sum exp, shifted by the maximum."""
    top = F.max(logit).over(over)
    return logit - (top + F.log(F.sum(F.exp(logit - top)).over(over)))


def softmax(logit: Column, over) -> Column:
    top = F.max(logit).over(over)
    return F.exp(logit - top) / F.sum(F.exp(logit - top)).over(over)


def with_logprobs(rows: DataFrame) -> DataFrame:
    return rows.withColumn("logprob", log_softmax(F.col("logit"), _req()))


def allowed_only(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Tokens that a request does not list are masked; requests without a list are free."""
    listed = allowed.select("req", "token_id", F.lit(True).alias("_l")).distinct()
    limited = allowed.select("req", F.lit(True).alias("_r")).distinct()
    joined = rows.join(listed, ["req", "token_id"], "left").join(limited, "req", "left")
    return masked(joined, F.col("_r").isNull() | F.col("_l").isNotNull()).drop("_l", "_r")


def biased(rows: DataFrame, bias: DataFrame) -> DataFrame:
    """Adds the listed biases."""
    return rows.join(bias.select("req", "token_id", "bias"), ["req", "token_id"], "left").withColumn("logit", F.col("logit") + F.coalesce("bias", F.lit(0.0))).drop("bias")


def scaled(rows: DataFrame, temperature: Column) -> DataFrame:
    """Divided by the temperature; 0 leaves logits as they are (greedy)."""
    return rows.withColumn("logit", F.when(temperature > 0, F.col("logit") / temperature).otherwise(F.col("logit")))


def token_counts(outputs: DataFrame) -> DataFrame:
    """req, token_id, n of an array column tokens: bin counts; presence is n > 0."""
    return outputs.select("req", F.explode("tokens").alias("token_id")).groupBy("req", "token_id").agg(F.count("*").alias("n"))


def penalised(rows: DataFrame, output_counts: DataFrame, prompt_tokens: DataFrame | None, presence: float, frequency: float, repetition: float) -> DataFrame:
    """Repetition first (positive logits of seen tokens are divided, others multiplied), then frequency and presence of output tokens."""
    out = rows.join(output_counts.select("req", "token_id", "n"), ["req", "token_id"], "left")
    n = F.coalesce("n", F.lit(0))
    seen = n > 0
    if prompt_tokens is not None:
        out = out.join(prompt_tokens.select("req", "token_id", F.lit(True).alias("_p")).distinct(), ["req", "token_id"], "left")
        seen = seen | F.col("_p").isNotNull()
    logit = F.col("logit")
    repeated = F.when(seen, F.when(logit > 0, logit / repetition).otherwise(logit * repetition)).otherwise(logit)
    out = out.withColumn("logit", repeated - frequency * n - presence * (n > 0).cast("int"))
    return out.drop("n", "_p")


def top_k_mask(rows: DataFrame, k: int) -> DataFrame:
    """Keeps logits not below the k-th; equals of the k-th stay."""
    rank = F.rank().over(_req().orderBy(F.col("logit").desc()))
    return masked(rows.withColumn("_r", rank), F.col("_r") <= k).drop("_r")


def top_p_mask(rows: DataFrame, p: float) -> DataFrame:
    """Masks the smallest probabilities whose running sum stays within 1 - p; the largest always stays."""
    probability = softmax(F.col("logit"), _req())
    up = _req().orderBy(F.col("logit").asc(), F.col("token_id").asc())
    down = _req().orderBy(F.col("logit").desc(), F.col("token_id").desc())
    out = rows.withColumn("_p", probability)
    out = out.withColumn("_s", F.sum("_p").over(up.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.row_number().over(down))
    return masked(out, (F.col("_s") > 1 - p) | (F.col("_n") == 1)).drop("_p", "_s", "_n")


def min_p_mask(rows: DataFrame, min_p: float) -> DataFrame:
    """Masks probabilities below a share of the largest."""
    out = rows.withColumn("_p", softmax(F.col("logit"), _req()))
    return masked(out.withColumn("_m", F.max("_p").over(_req())), F.col("_p") >= F.col("_m") * min_p).drop("_p", "_m")


def top_logprobs(rows: DataFrame, k: int) -> DataFrame:
    """The k largest log-probabilities, smaller token first among equals."""
    rank = F.row_number().over(_req().orderBy(F.col("logprob").desc(), "token_id"))
    return with_logprobs(rows).withColumn("rank", rank).filter(F.col("rank") <= k).drop("logit")


def greedy(rows: DataFrame) -> DataFrame:
    """req, token_id of the largest logit, the smaller token of equals."""
    return rows.groupBy("req").agg(F.max_by("token_id", F.struct("logit", -F.col("token_id"))).alias("token_id"))


def sampled_rank(rows: DataFrame, sampled: DataFrame) -> DataFrame:
    """req, token_id, rank: how many logits are not below the sampled one (itself and equals included)."""
    one = rows.join(sampled.select("req", "token_id"), ["req", "token_id"]).select("req", F.col("token_id").alias("_t"), F.col("logit").alias("_l"))
    return rows.join(one, "req").groupBy("req", F.col("_t").alias("token_id")).agg(F.count_if(F.col("logit") >= F.col("_l")).alias("rank"))


def random_tokens(rows: DataFrame, seed: int) -> DataFrame:
    """One token a request, drawn by exponential races. The draw is a hash of seed, request and token, so reruns agree."""
    u = (F.pmod(F.xxhash64(F.lit(seed), "req", "token_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    race = softmax(F.col("logit"), _req()) / -F.log(u)
    return rows.withColumn("_q", race).groupBy("req").agg(F.max_by("token_id", "_q").alias("token_id"))


def accepted_drafts(drafts: DataFrame) -> DataFrame:
    """req, accepted, tokens from req, pos, draft, target, with one more target (draft null) as bonus.

    Drafts count up to the first that differs; there the target stands; the bonus only if all agree.
    """
    first_bad = F.min(F.when(F.col("draft").isNotNull() & (F.col("draft") != F.col("target")), F.col("pos"))).over(_req())
    kept = drafts.withColumn("_b", first_bad).filter(F.col("_b").isNull() | (F.col("pos") <= F.col("_b")))
    accepted = F.count_if(F.col("draft") == F.col("target"))
    tokens = F.transform(F.array_sort(F.collect_list(F.struct("pos", "target"))), lambda t: t["target"])
    return kept.groupBy("req").agg(accepted.alias("accepted"), tokens.alias("tokens"))


def beam_search(step, starts: DataFrame, width: int, steps: int, eos: int, penalty: float = 1.0) -> DataFrame:
    """req, tokens, logprob, score of the best ``width`` beams.

    ``step(beams)`` gives rows of req, beam, token_id, logprob for open beams. Each step keeps the best 2 * width
    candidates of a request and of these the best ``width`` open ones; a beam that takes ``eos`` is
    finished and its end does not count for length. The loop is over steps; beams stay distributed.
    """
    beams = starts.select("req", F.lit(0).alias("beam"), F.array().cast("array<int>").alias("tokens"), F.lit(0.0).alias("logprob"))
    finished = None
    for _ in range(steps):
        grown = beams.join(step(beams).withColumnRenamed("logprob", "_lp"), ["req", "beam"])
        grown = grown.select("req", "beam", "tokens", (F.col("logprob") + F.col("_lp")).alias("logprob"), "token_id")
        rank = F.row_number().over(_req().orderBy(F.col("logprob").desc(), "beam", "token_id"))
        best = grown.withColumn("_r", rank).filter(F.col("_r") <= 2 * width)
        ended = best.filter(F.col("token_id") == eos).select("req", "tokens", "logprob")
        finished = ended if finished is None else finished.unionByName(ended)
        place = F.row_number().over(_req().orderBy("_r"))
        beams = best.filter(F.col("token_id") != eos).withColumn("beam", place - 1).filter(F.col("beam") < width).select("req", "beam", F.concat("tokens", F.array(F.col("token_id").cast("int"))).alias("tokens"), "logprob")
    every = beams.select("req", "tokens", "logprob") if finished is None else finished.unionByName(beams.select("req", "tokens", "logprob"))
    scored = every.withColumn("score", F.col("logprob") / F.pow(F.greatest(F.size("tokens"), F.lit(1)).cast("double"), F.lit(penalty)))
    last = F.row_number().over(_req().orderBy(F.col("score").desc(), "tokens"))
    return scored.withColumn("rank", last).filter(F.col("rank") <= width)
