"""Queries of request metrics, evaluation and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions.geometry import one_two_five
from sparkloom.operators import metrics as M
from sparkloom.plans.base import REQUESTS, TOKENS_SQL, Tables, query, tokens

RQ = f"r AS ({REQUESTS})"


def requests(t: Tables):
    return t.sql(REQUESTS)


@query("ag10_describe", f"""WITH {RQ} SELECT model, count(latency) AS count, round(avg(latency), 6) AS mean, round(stddev_samp(latency), 6) AS std, min(latency) AS min, round(quantile_cont(latency, 0.25), 6) AS p25, round(quantile_cont(latency, 0.5), 6) AS p5, round(quantile_cont(latency, 0.75), 6) AS p75,
round(quantile_cont(latency, 0.9), 6) AS p9, round(quantile_cont(latency, 0.99), 6) AS p99, round(quantile_cont(latency, 0.999), 6) AS p999, round(quantile_cont(latency, 0.9999), 6) AS p9999, max(latency) AS max FROM r GROUP BY model""")
def _(t: Tables):
    out = M.described(requests(t), "latency", ("model",))
    return out.select("model", "count", *[F.round(c, 6).alias(c) for c in out.columns if c not in ("model", "count", "min", "max")], "min", "max")


@query("ag10_sketches", f"WITH {RQ} SELECT model, count(latency) AS n, round(avg(latency), 6) AS mean, true AS within, true AS members FROM r GROUP BY model")
def _(t: Tables):
    """Sketches by model and day, merged by model, against exact ranks: within 1 % of the rows, members within 5 %."""
    rows = requests(t).select("model", F.to_date("ts").alias("day"), "latency", "prompt_len")
    by_day = M.sketched(rows, "latency", ("model", "day"), "prompt_len")
    ranks = (0.25, 0.5, 0.9, 0.99)
    told = M.described_sketches(M.merged_sketches(by_day, ("model",)), ranks)
    q = {r: F.col("p" + str(r)[2:]) for r in ranks}
    shares = [F.count_if(F.col("latency") < c).alias(f"b{i}") for i, c in enumerate(q.values())] + [F.count_if(F.col("latency") <= c).alias(f"a{i}") for i, c in enumerate(q.values())]
    exact = rows.join(told, "model").groupBy("model", "n", "mean", F.col("members").alias("told")).agg(*shares, F.count_distinct("prompt_len").alias("true"))
    near = [(F.col(f"b{i}") <= (r + 0.01) * F.col("n")) & (F.col(f"a{i}") >= (r - 0.01) * F.col("n")) for i, r in enumerate(ranks)]
    within = near[0]
    for x in near[1:]:
        within = within & x
    return exact.select("model", "n", F.round("mean", 6).alias("mean"), within.alias("within"), (F.abs(F.col("told") - F.col("true")) <= 0.05 * F.col("true") + 1).alias("members"))


@query("ag11_latency_summary", f"""WITH {RQ} SELECT model, round(avg(ttft * 1000), 6) AS mean_ms, round(stddev_pop(ttft * 1000), 6) AS std_ms, round(quantile_cont(ttft * 1000, 0.5), 6) AS median_ms, round(quantile_cont(ttft * 1000, 0.5), 6) AS p5_ms, round(quantile_cont(ttft * 1000, 0.99), 6) AS p99_ms FROM r GROUP BY model""")
def _(t: Tables):
    out = M.latency_summary(requests(t), "ttft", ("model",))
    return out.select("model", *[F.round(c, 6).alias(c) for c in out.columns if c != "model"])


@query("ag12_throughput", f"WITH {RQ} SELECT model, count(*) / 100.0::DOUBLE AS requests_s, sum(output_tokens) / 100.0::DOUBLE AS output_s, sum(output_tokens + prompt_len) / 100.0::DOUBLE AS total_s FROM r GROUP BY model")
def _(t: Tables):
    return M.throughput(requests(t), F.lit(100.0), ("model",))


@query("ag13_goodput", f"WITH {RQ} SELECT model, count(*) FILTER (WHERE ttft <= 0.05 AND coalesce(CASE WHEN output_tokens > 1 THEN (latency - ttft) / (output_tokens - 1) END, 0) <= 0.041 AND latency <= 1.5) AS good FROM r GROUP BY model")
def _(t: Tables):
    rows = requests(t).withColumn("tpot", M.tpot(F.col("latency"), F.col("ttft"), F.col("output_tokens")))
    return M.goodput(rows, {"ttft": 0.05, "tpot": 0.041, "latency": 1.5}, F.lit(100.0), ("model",)).select("model", "good")


@query("ag14_tpot", f"WITH {RQ} SELECT req, round(CASE WHEN output_tokens > 1 THEN (latency - ttft) / (output_tokens - 1) END, 6) AS tpot FROM r")
def _(t: Tables):
    return requests(t).select("req", F.round(M.tpot(F.col("latency"), F.col("ttft"), F.col("output_tokens")), 6).alias("tpot"))


@query("ag15_tokens_per_second", f"WITH {RQ}, t AS (SELECT CAST(floor(start_time + ttft + i * 0.125 - 1) AS BIGINT) AS second FROM r, (SELECT unnest(range(0, 4)) AS i)) SELECT second, count(*) AS n FROM t GROUP BY second")
def _(t: Tables):
    rows = requests(t).withColumn("itl", F.array(*[F.lit(0.125)] * 3))
    return M.per_second(M.token_times(rows), F.lit(1.0))


@query("ag16_concurrency", f"WITH {RQ}, s AS (SELECT unnest(range(CAST(floor(start_time) AS BIGINT), CAST(floor(start_time + latency * 2) AS BIGINT) + 1)) AS second FROM r) SELECT second, count(*) AS n FROM s GROUP BY second")
def _(t: Tables):
    rows = requests(t).select(F.col("start_time").alias("start"), (F.col("start_time") + F.col("latency") * 2).alias("end"))
    return M.concurrency(rows, F.lit(0.0))


@query("ag17_bucket_histogram", f"WITH {RQ} SELECT model, le, count(*) FILTER (WHERE output_tokens <= le) AS n FROM r, (SELECT unnest([1.0::DOUBLE, 2, 5, 10, 20, 50, 'Infinity'::DOUBLE]) AS le) GROUP BY model, le")
def _(t: Tables):
    return M.bucket_histogram(requests(t), "output_tokens", one_two_five(50), ("model",))


@query("ag18_bucket_bounds", f"""WITH {RQ}, b AS (SELECT DISTINCT CAST(m * pow(10, e) AS INT) AS bound FROM (VALUES (1), (2), (5)) v(m), range(0, 9) t(e), (SELECT max(prompt_len) AS most FROM r) WHERE m * pow(10, e) <= most)
SELECT bound, count(*) FILTER (WHERE prompt_len <= bound) AS n FROM b, r GROUP BY bound""")
def _(t: Tables):
    """Bounds up to the longest prompt, and the prompts within each."""
    rows = requests(t)
    bounds = one_two_five(rows.agg(F.max("prompt_len")).first()[0] or 0)
    counts = rows.agg(*[F.count_if(F.col("prompt_len") <= b).alias(str(b)) for b in bounds])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(b).alias("bound"), F.col(str(b)).alias("n")) for b in bounds])).alias("r")).select("r.*")


_LIFE = "SELECT o_orderkey AS req, e.name AS event, CAST(o_orderkey * 10 + e.off * (o_orderkey % 5 + 1) AS DOUBLE) AS ts FROM {orders}, (SELECT 'arrived' AS name, 0 AS off UNION ALL SELECT 'queued', 1 UNION ALL SELECT 'scheduled', 3 UNION ALL SELECT 'first_token', 4 UNION ALL SELECT 'finished', 9) e"


@query("ag19_lifecycle", "SELECT o_orderkey AS req, CAST(2 * (o_orderkey % 5 + 1) AS DOUBLE) AS queued_s, CAST(o_orderkey % 5 + 1 AS DOUBLE) AS prefill_s, CAST(5 * (o_orderkey % 5 + 1) AS DOUBLE) AS decode_s, CAST(6 * (o_orderkey % 5 + 1) AS DOUBLE) AS inference_s, CAST(9 * (o_orderkey % 5 + 1) AS DOUBLE) AS e2e_s FROM {orders}")
def _(t: Tables):
    return M.lifecycle(t.sql(_LIFE))


@query("ag20_min_max_mean", f"WITH {RQ} SELECT model, min(latency) AS low, max(latency) AS high, round(avg(latency), 6) AS mean FROM r GROUP BY model")
def _(t: Tables):
    return requests(t).groupBy("model").agg(F.min("latency").alias("low"), F.max("latency").alias("high"), F.round(F.avg("latency"), 6).alias("mean"))


@query("ag22_accuracy", "SELECT round(avg(CASE WHEN doc_id % 7 > 0 AND doc_id % 2 = toxic THEN 1.0 ELSE 0 END), 6) AS accuracy, round(avg(CASE WHEN doc_id % 7 = 0 THEN 1.0 ELSE 0 END), 6) AS invalid FROM {labels}")
def _(t: Tables):
    rows = t("labels").withColumn("p", F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 2))
    return M.accuracy(rows, "p", "toxic").select(F.round("accuracy", 6).alias("accuracy"), F.round("invalid", 6).alias("invalid"))


@query("ag23_character_errors", "WITH p AS (SELECT a.page_id % 5 AS k, levenshtein(a.url, b.url) AS d, length(b.url) AS n FROM {pages} a JOIN {pages} b ON b.page_id = a.page_id + 1) SELECT k, round(avg(d), 6) AS edit_distance, round(avg(d / nullif(n, 0)), 6) AS cer FROM p GROUP BY k")
def _(t: Tables):
    pages = t("pages").select("page_id", "url")
    rows = pages.join(pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("truth")), "page_id").withColumn("k", F.col("page_id") % 5)
    return M.character_errors(rows, "url", "truth", ("k",)).select("k", F.round("edit_distance", 6).alias("edit_distance"), F.round("cer", 6).alias("cer"))


_POINTS = "SELECT CAST(l_orderkey % 20 AS INT) AS sample, l_returnflag AS direction, CAST(l_linenumber AS INT) AS line, l_extendedprice AS across FROM {lineitem}"


@query("ag24_line_straightness", f"SELECT sample, direction, round(avg(d), 6) AS deviation FROM (SELECT sample, direction, line, stddev_pop(across) AS d FROM ({_POINTS}) GROUP BY ALL) GROUP BY ALL")
def _(t: Tables):
    return M.line_straightness(t.sql(_POINTS)).withColumn("deviation", F.round("deviation", 6))


@query("ag25_similarity_distortion", "SELECT sample, round(s, 6) AS ms_ssim, round(ld, 6) AS ld FROM (SELECT l_orderkey AS sample, sum(l_discount * [0.0448, 0.2856, 0.3001, 0.2363, 0.1333][l_linenumber]) AS s FROM {lineitem} WHERE l_linenumber <= 5 GROUP BY 1) JOIN (SELECT l_orderkey AS sample, avg(sqrt(l_quantity * l_quantity + l_tax * l_tax)) AS ld FROM lineitem GROUP BY 1) USING (sample)")
def _(t: Tables):
    rows = t("lineitem").select(F.col("l_orderkey").alias("sample"), F.col("l_linenumber").alias("level"), F.col("l_discount").alias("ssim"), F.col("l_quantity").alias("vx"), F.col("l_tax").alias("vy"))
    out = M.multi_scale_similarity(rows.filter("level <= 5")).join(M.local_distortion(rows), "sample")
    return out.select("sample", F.round("ms_ssim", 6).alias("ms_ssim"), F.round("ld", 6).alias("ld"))


@query("ag25_pixels")
def _(t: Tables):
    """Every image of 8 x 8 against the next one."""
    grid = lambda c: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice(c, r * 8 + 1, F.lit(8)))
    rows = t("embeddings").select("vec_id", "embedding")
    pairs = rows.join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next")), "vec_id")
    out = pairs.select("vec_id", M.pixel_similarity(grid("embedding"), grid("next"), 2.0).alias("s"))
    return out.select("vec_id", F.round("s.ms_ssim", 6).alias("ms_ssim"), F.round(F.col("s.levels")[0], 6).alias("first"))


_STATS = "SELECT CAST(user_id AS BIGINT) AS cache, CAST(event_id AS BIGINT) AS seq, CAST(event_id % 5 + 1 AS INT) AS requests, CAST(event_id % 90 AS INT) AS queries, CAST(event_id % 30 AS INT) AS hits FROM {events}"


@query("ag27_recent_hit_rate", f"""WITH s AS (SELECT *, sum(requests) OVER (PARTITION BY cache ORDER BY seq) AS e FROM ({_STATS}))
SELECT a.cache, a.seq, round(CASE WHEN sum(b.queries) > 0 THEN sum(b.hits) / sum(b.queries) ELSE 0 END, 6) AS hit_rate FROM s a JOIN s b ON a.cache = b.cache AND b.seq <= a.seq AND (b.e - b.requests >= a.e - 10 OR b.seq = a.seq) GROUP BY a.cache, a.seq""")
def _(t: Tables):
    return M.recent_hit_rate(t.sql(_STATS), 10, ("cache",)).withColumn("hit_rate", F.round("hit_rate", 6))


_RUNS = "SELECT o_orderkey AS req, CAST(o_orderkey * 3 % 10007 AS DOUBLE) AS start_ms, CAST(o_custkey % 100 AS DOUBLE) AS latency_ms FROM {orders}"


@query("ag28_warmup_cutoffs", f"""WITH n AS (SELECT *, row_number() OVER (ORDER BY start_ms, req) AS n, count(*) OVER () AS c FROM ({_RUNS})), p AS (SELECT * FROM n, (SELECT unnest([0.0::DOUBLE, 0.1, 0.25]) AS pct) WHERE n > floor(pct * c))
SELECT pct, count(*) AS n, round((max_by(start_ms + latency_ms, n) - min_by(start_ms, n)) / 1000, 6) AS runtime_s, round(avg(latency_ms), 6) AS mean_ms FROM p GROUP BY pct""")
def _(t: Tables):
    out = M.warmup_cutoffs(t.sql(_RUNS), [0.0, 0.1, 0.25])
    return out.select("pct", "n", F.round("runtime_s", 6).alias("runtime_s"), F.round("mean_ms", 6).alias("mean_ms"))


@query("ag29_acceptance", "SELECT round(sum(a) * 100.0 / sum(d), 6) AS rate, round(1 + sum(a) * 1.0 / count(*), 6) AS mean_length, round(count(*) FILTER (WHERE a > 1) * 1.0 / count(*), 6) AS second FROM (SELECT l_linenumber % 4 AS a, 4 AS d FROM {lineitem})")
def _(t: Tables):
    rows = t("lineitem").select((F.col("l_linenumber") % 4).alias("accepted"), F.lit(4).alias("draft_tokens"))
    return M.acceptance(rows, 3).select(F.round("rate", 6).alias("rate"), F.round("mean_length", 6).alias("mean_length"), F.round(F.col("by_position")[1], 6).alias("second"))


@query("ag30_histogram_maps", f"WITH {RQ} SELECT model, count(*) FILTER (WHERE output_tokens <= 10) AS le_10, count(*) AS count FROM r GROUP BY model")
def _(t: Tables):
    samples = M.bucket_histogram(requests(t), "output_tokens", one_two_five(50), ("model",))
    return M.histogram_maps(samples, ["model"]).select("model", F.col("buckets")["10.0"].alias("le_10"), "count")


@query("ag31_positions_vector", "SELECT l_orderkey, array_to_string(list_transform(range(0, max(l_linenumber) * 2 + 1), lambda i: coalesce(map_from_entries(list((l_linenumber * 2, CAST(l_quantity AS INT))))[i], 0)), ',') AS v FROM {lines} GROUP BY l_orderkey")
def _(t: Tables):
    rows = t("lines").select("l_orderkey", (F.col("l_linenumber") * 2).alias("p"), F.col("l_quantity").cast("int").alias("q"))
    return M.positions_vector(rows, ["l_orderkey"], "p", "q").select("l_orderkey", F.array_join(F.transform("values", lambda x: x.cast("string")), ",").alias("v"))


@query("wn10_moving_average", f"WITH {RQ} SELECT req, round(avg(latency) OVER (PARTITION BY model ORDER BY start_time, req ROWS 4 PRECEDING), 6) AS moving FROM r")
def _(t: Tables):
    return M.moving_average(requests(t), "latency", 5, ("model",), ("start_time", "req")).select("req", F.round("moving", 6).alias("moving"))


@query("wn11_inter_token_latency", "SELECT event_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM {events}")
def _(t: Tables):
    return M.gaps(t("events"), "event_id", ("user_id",), ("event_id",)).select("event_id", "gap")


@query("wn15_running_requests", f"""WITH {RQ}, e AS (SELECT model, start_time AS ts, 1 AS d FROM r UNION ALL SELECT model, start_time + 10, -1 FROM r), g AS (SELECT model, ts, sum(d) AS d FROM e GROUP BY ALL)
SELECT model, ts, sum(d) OVER (PARTITION BY model ORDER BY ts) AS running FROM g""")
def _(t: Tables):
    rows = requests(t).select("model", F.col("start_time").alias("start"), (F.col("start_time") + 10).alias("end"))
    return M.running_requests(rows, ("model",))


@query("src27_generators")
def _(t: Tables):
    from sparkloom.sources import generators as G

    k = F.col("o_orderkey")
    rows = t("orders").select(G.uniform(k, 3, 9, 1).alias("u"), G.zipf(k, 1.2, 50, 2).alias("z"), G.poisson(k, 4.0, 40, 3).alias("p"), G.lognormal(k, 1.0, 0.5, 4, 50.0).alias("l"))
    return rows.agg(F.min("u").alias("u_min"), F.max("u").alias("u_max"), F.min("z").alias("z_min"), F.max("z").alias("z_max"), F.round(F.avg("p"), 6).alias("p_mean"), F.round(F.max("l"), 6).alias("l_max"))


@query("src28_arrivals", "SELECT o_orderkey AS req, round(sum(1 + o_orderkey % 3) OVER w * 100.0 / sum(1 + o_orderkey % 3) OVER (PARTITION BY o_orderstatus), 6) AS arrival FROM {orders} WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderkey)")
def _(t: Tables):
    from sparkloom.sources import generators as G

    rows = t("orders").select(F.col("o_orderstatus").alias("stream"), F.col("o_orderkey").alias("req"), (F.col("o_orderkey") % 3 + 1).cast("double").alias("gap"))
    return G.arrivals(rows, 100.0).select("req", F.round("arrival", 6).alias("arrival"))


@query("tk16_offset_order", f"WITH t AS ({TOKENS_SQL}) SELECT doc_id, string_agg(CAST(x AS VARCHAR), '' ORDER BY i DESC) AS reversed FROM (SELECT doc_id, unnest(tokens) AS x, unnest(range(1, len(tokens) + 1)) AS i FROM t) GROUP BY doc_id")
def _(t: Tables):
    from sparkloom.operators.documents import joined_text

    rows = tokens(t).select("doc_id", F.posexplode("tokens").alias("i", "x")).select("doc_id", (-F.col("i")).alias("i"), F.col("x").cast("string").alias("x"))
    return joined_text(rows, "doc_id", ["i"], "x", "", "reversed")
