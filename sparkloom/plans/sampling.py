"""Queries of vectors, logits, token sequences and schedulers."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import tokens as K
from sparkloom.functions import vectors as V
from sparkloom.operators import sampling as P
from sparkloom.operators import scheduling as Q
from sparkloom.plans.base import LOGITS_SQL, TOKENS_SQL, Tables, logits, query, tokens

LG = f"l AS ({LOGITS_SQL})"
TK = f"t AS ({TOKENS_SQL})"
_COS = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: CAST({a}[i] AS DOUBLE) * CAST({b}[i] AS DOUBLE)))"


def _pairs(t: Tables):
    rows = t("embeddings")
    return rows.select("vec_id", "embedding").join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")


@query("mth10_cosine", f"SELECT a.vec_id, round({_COS.format(a='a.embedding', b='b.embedding')} / (greatest(sqrt({_COS.format(a='a.embedding', b='a.embedding')}), 1e-8) * greatest(sqrt({_COS.format(a='b.embedding', b='b.embedding')}), 1e-8)), 6) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def _(t: Tables):
    return _pairs(t).select("vec_id", F.round(V.cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query("mth11_matryoshka", f"WITH s AS (SELECT vec_id, embedding[1:16] AS e FROM embeddings) SELECT vec_id, round(CAST(e[1] AS DOUBLE) / greatest(sqrt({_COS.format(a='e', b='e')}), 1e-12), 6) AS x1, round(CAST(e[16] AS DOUBLE) / greatest(sqrt({_COS.format(a='e', b='e')}), 1e-12), 6) AS x16 FROM s")
def _(t: Tables):
    e = V.truncated(F.col("embedding"), 16)
    return t("embeddings").select("vec_id", e.alias("e")).select("vec_id", F.round(F.col("e")[0], 6).alias("x1"), F.round(F.col("e")[15], 6).alias("x16"))


@query("mth12_softmax", "SELECT vec_id, round(exp(CAST(embedding[1] AS DOUBLE)) / list_sum(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE)))), 6) AS p1, round(1 / (1 + exp(-CAST(embedding[1] AS DOUBLE))), 6) AS s1 FROM embeddings")
def _(t: Tables):
    e = F.col("embedding")
    return t("embeddings").select("vec_id", F.round(V.classified(e, 64)[0], 6).alias("p1"), F.round(V.classified(e, 1)[0], 6).alias("s1"))


@query("mth13_token_pooling", "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first_x, round(CAST(embedding[64] AS DOUBLE), 6) AS last_x FROM embeddings")
def _(t: Tables):
    e = F.col("embedding")
    return t("embeddings").select("vec_id", F.round(V.first_token(e).cast("double"), 6).alias("first_x"), F.round(V.last_token(e).cast("double"), 6).alias("last_x"))


@query("ag26_mean_pooling", "SELECT label, CAST(i AS INT) AS i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i")
def _(t: Tables):
    return V.mean_pooled(t("embeddings"), "label", "embedding").select("label", F.posexplode("embedding").alias("i", "x")).select("label", (F.col("i") + 1).alias("i"), F.round("x", 6).alias("x"))


@query("tk2_rerank", f"WITH s AS (SELECT d.vec_id AS index, d.label AS query, round({_COS.format(a='d.embedding', b='q.embedding')}, 9) AS score FROM embeddings d, (SELECT embedding FROM embeddings WHERE vec_id = 0) q) SELECT query, index, row_number() OVER (PARTITION BY query ORDER BY score DESC, index) AS rank FROM s QUALIFY rank <= 10")
def _(t: Tables):
    rows = t("embeddings")
    q = rows.filter("vec_id = 0").agg(F.min("embedding").alias("q"))
    scores = rows.crossJoin(F.broadcast(q)).select(F.col("label").alias("query"), F.col("vec_id").alias("index"), F.round(V.dot(F.col("embedding"), F.col("q")), 9).alias("score"))
    return Q.reranked(scores, 10).select("query", "index", F.col("rank").cast("long").alias("rank"))


@query("jn8_query_document_scores", f"SELECT d.vec_id AS pos, round({_COS.format(a='d.embedding', b='q.embedding')} / (sqrt({_COS.format(a='d.embedding', b='d.embedding')}) * sqrt({_COS.format(a='q.embedding', b='q.embedding')})), 6) AS score FROM embeddings d, (SELECT embedding FROM embeddings WHERE vec_id = 3) q")
def _(t: Tables):
    rows = t("embeddings").select(F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
    return Q.scored_pairs(rows.filter("pos = 3"), rows, shared=True).withColumn("score", F.round("score", 6))


@query("jn7_prompt_params", "SELECT p.item_id AS pos, length(p.text) AS n, p.item_id * 2 AS top_k FROM {benchmark} p")
def _(t: Tables):
    prompts = t("benchmark").select(F.col("item_id").alias("pos"), F.length("text").cast("long").alias("n"))
    return Q.zipped(prompts, prompts.select("pos", (F.col("pos") * 2).alias("top_k")))


@query("wn13_log_softmax", f"WITH {LG}, m AS (SELECT *, max(logit) OVER (PARTITION BY req) AS m FROM l) SELECT req, token_id, round(logit - m - ln(sum(exp(logit - m)) OVER (PARTITION BY req)), 6) AS logprob FROM m")
def _(t: Tables):
    return P.with_logprobs(logits(t)).select("req", "token_id", F.round("logprob", 6).alias("logprob"))


@query("wn14_top_p", f"""WITH {LG}, m AS (SELECT *, exp(logit) AS e FROM l), p AS (SELECT *, e / sum(e) OVER (PARTITION BY req) AS p FROM m),
c AS (SELECT *, sum(p) OVER (PARTITION BY req ORDER BY logit, token_id ROWS UNBOUNDED PRECEDING) AS c, row_number() OVER (PARTITION BY req ORDER BY logit DESC, token_id DESC) AS n FROM p)
SELECT req, count(*) AS kept, sum(token_id) AS tokens FROM c WHERE c > 1 - 0.8 OR n = 1 GROUP BY req""")
def _(t: Tables):
    return P.top_p_mask(logits(t), 0.8).filter(F.col("logit") > P.NEVER).groupBy("req").agg(F.count("*").alias("kept"), F.sum("token_id").alias("tokens"))


@query("tk3_top_k", f"WITH {LG}, r AS (SELECT *, rank() OVER (PARTITION BY req ORDER BY logit DESC) AS r FROM l) SELECT req, count(*) AS kept, sum(token_id) AS tokens FROM r WHERE r <= 5 GROUP BY req")
def _(t: Tables):
    return P.top_k_mask(logits(t), 5).filter(F.col("logit") > P.NEVER).groupBy("req").agg(F.count("*").alias("kept"), F.sum("token_id").alias("tokens"))


@query("tk4_top_logprobs", f"WITH {LG}, m AS (SELECT req, token_id, round(logit - ln(sum(exp(logit)) OVER (PARTITION BY req)), 6) AS logprob, row_number() OVER (PARTITION BY req ORDER BY logit DESC, token_id) AS rank FROM l) SELECT * FROM m WHERE rank <= 3")
def _(t: Tables):
    return P.top_logprobs(logits(t), 3).select("req", "token_id", F.round("logprob", 6).alias("logprob"), F.col("rank").cast("long").alias("rank"))


@query("tk5_greedy", f"WITH {LG} SELECT req, CAST(first(token_id ORDER BY logit DESC, token_id) AS INT) AS token_id FROM l GROUP BY req")
def _(t: Tables):
    return P.greedy(logits(t))


@query("tk6_min_p", f"WITH {LG}, p AS (SELECT *, max(logit) OVER (PARTITION BY req) AS m FROM l) SELECT req, count(*) AS kept, sum(token_id) AS tokens FROM p WHERE exp(logit - m) >= 0.101 GROUP BY req")
def _(t: Tables):
    return P.min_p_mask(logits(t), 0.101).filter(F.col("logit") > P.NEVER).groupBy("req").agg(F.count("*").alias("kept"), F.sum("token_id").alias("tokens"))


@query("wn12_token_rank", f"WITH {LG}, s AS (SELECT req, logit AS x FROM l WHERE token_id = req % 64) SELECT l.req, CAST(l.req % 64 AS INT) AS token_id, count(*) FILTER (WHERE logit >= x) AS rank FROM l JOIN s USING (req) GROUP BY l.req")
def _(t: Tables):
    rows = logits(t)
    sampled = t("embeddings").select(F.col("vec_id").alias("req"), (F.col("vec_id") % 64).cast("int").alias("token_id"))
    return P.sampled_rank(rows, sampled)


@query("flt18_allowed_tokens", f"WITH {LG} SELECT req, count(*) AS kept FROM l WHERE req % 3 = 0 OR token_id % 7 = req % 7 GROUP BY req")
def _(t: Tables):
    rows = logits(t)
    allowed = rows.filter("req % 3 <> 0 AND token_id % 7 = req % 7").select("req", "token_id")
    return P.allowed_only(rows, allowed).filter(F.col("logit") > P.NEVER).groupBy("req").agg(F.count("*").alias("kept"))


@query("jn6_logit_bias", f"WITH {LG} SELECT req, round(sum(logit + CASE WHEN token_id % 8 = 0 THEN 2.5 ELSE 0 END), 6) AS total FROM l GROUP BY req")
def _(t: Tables):
    rows = logits(t)
    bias = rows.filter("token_id % 8 = 0").select("req", "token_id", F.lit(2.5).alias("bias"))
    return P.biased(rows, bias).groupBy("req").agg(F.round(F.sum("logit"), 6).alias("total"))


@query("mth14_temperature", f"WITH {LG} SELECT req, round(sum(CASE WHEN req % 4 > 0 THEN logit / (req % 4) ELSE logit END), 6) AS total FROM l GROUP BY req")
def _(t: Tables):
    return P.scaled(logits(t), (F.col("req") % 4).cast("double")).groupBy("req").agg(F.round(F.sum("logit"), 6).alias("total"))


@query("mth15_penalties", f"""WITH {LG}, c AS (SELECT *, CASE WHEN token_id % 5 = 0 THEN token_id % 3 + 1 ELSE 0 END AS n, token_id % 5 = 0 OR token_id % 7 = 0 AS seen FROM l)
SELECT req, round(sum(CASE WHEN seen THEN CASE WHEN logit > 0 THEN logit / 2.0 ELSE logit * 2.0 END ELSE logit END - 0.1 * n - 0.5 * CASE WHEN n > 0 THEN 1 ELSE 0 END), 6) AS total FROM c GROUP BY req""")
def _(t: Tables):
    rows = logits(t)
    counts = rows.filter("token_id % 5 = 0").select("req", "token_id", (F.col("token_id") % 3 + 1).alias("n"))
    prompt = rows.filter("token_id % 7 = 0").select("req", "token_id")
    return P.penalised(rows, counts, prompt, 0.5, 0.1, 2.0).groupBy("req").agg(F.round(F.sum("logit"), 6).alias("total"))


@query("jsn12_min_tokens", f"WITH {LG} SELECT req, count(*) FILTER (WHERE NOT (req % 10 < 5 AND token_id IN (3, 9))) AS kept FROM l GROUP BY req")
def _(t: Tables):
    x = K.masked_before_minimum(F.col("logit"), F.col("token_id"), F.col("req") % 10, 5, [3, 9])
    return logits(t).withColumn("logit", x).groupBy("req").agg(F.count_if(F.col("logit") > P.NEVER).alias("kept"))


@query("wn17_draft_acceptance", """WITH d AS (SELECT l_orderkey AS req, l_linenumber AS pos, l_partkey % 2 AS draft, l_suppkey % 2 AS target FROM {lines}),
b AS (SELECT *, min(pos) FILTER (WHERE draft <> target) OVER (PARTITION BY req) AS bad FROM d)
SELECT req, count(*) FILTER (WHERE draft = target) AS accepted, string_agg(CAST(target AS VARCHAR), ',' ORDER BY pos) AS tokens FROM b WHERE bad IS NULL OR pos <= bad GROUP BY req""")
def _(t: Tables):
    rows = t("lines").select(F.col("l_orderkey").alias("req"), F.col("l_linenumber").alias("pos"), (F.col("l_partkey") % 2).alias("draft"), (F.col("l_suppkey") % 2).alias("target"))
    out = P.accepted_drafts(rows)
    return out.select("req", "accepted", F.array_join(F.transform("tokens", lambda x: x.cast("string")), ",").alias("tokens"))


@query("tk7_random_sample")
def _(t: Tables):
    return P.random_tokens(logits(t), 11)


@query("tk8_beam_search")
def _(t: Tables):
    starts = t("embeddings").select(F.col("vec_id").alias("req"))
    table = P.with_logprobs(logits(t)).select("req", "token_id", "logprob")
    out = P.beam_search(lambda b: b.select("req", "beam").join(table, "req"), starts, 3, 4, eos=0)
    return out.select("req", F.col("rank").cast("long").alias("rank"), F.array_join(F.transform("tokens", lambda x: x.cast("string")), ",").alias("tokens"), F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- token sequences


@query("jsn9_prefix_hashes", f"""WITH {TK}, h AS (SELECT doc_id, len(tokens) AS n, tokens, sha256('root|' || array_to_string(tokens[1:4], ',') || '|') AS h1 FROM t)
SELECT doc_id, CAST(floor(n / 4) AS INT) AS blocks, CASE WHEN n >= 4 THEN h1 END AS first_hash, CASE WHEN n >= 8 THEN sha256(h1 || '|' || array_to_string(tokens[5:8], ',') || '|') END AS second_hash FROM h""")
def _(t: Tables):
    h = K.prefix_block_hashes(F.col("tokens"), 4)
    return tokens(t).select("doc_id", h.alias("h")).select("doc_id", F.size("h").alias("blocks"), F.get("h", F.lit(0)).alias("first_hash"), F.get("h", F.lit(1)).alias("second_hash"))


@query("jn9_cached_prefix", f"""WITH {TK}, k AS (SELECT doc_id, len(tokens) AS n, list_transform(range(1, CAST(floor(len(tokens) / 4) AS BIGINT) + 1), lambda i: md5(array_to_string(tokens[1:i * 4], ','))) AS p FROM t),
c AS (SELECT DISTINCT unnest(p) AS p FROM k WHERE doc_id % 2 = 0),
r AS (SELECT doc_id, n, p[i] AS prefix, i FROM k, unnest(range(1, len(p) + 1)) u(i)),
m AS (SELECT doc_id, n, min(i) FILTER (WHERE c.p IS NULL) AS miss, count(*) AS blocks FROM r LEFT JOIN c ON c.p = r.prefix GROUP BY doc_id, n)
SELECT t.doc_id AS req, CAST(coalesce(least(coalesce(miss - 1, blocks), floor((len(t.tokens) - 1) / 4)), 0) AS INT) AS blocks FROM t LEFT JOIN m USING (doc_id)""")
def _(t: Tables):
    rows = tokens(t).select(F.col("doc_id").alias("req"), F.size("tokens").alias("n"), K.prefix_block_hashes(F.col("tokens"), 4).alias("hashes"))
    cache = rows.filter("req % 2 = 0").select(F.explode_outer("hashes").alias("hash"))  # outer: no filter that hashes once more
    return Q.cached_prefix(rows, cache, 4).select("req", "blocks")


@query("jsn10_ngram_lookup", f"""WITH {TK}, s AS (SELECT doc_id, tokens AS t, 1000000 - len(tokens) AS room FROM t),
m AS (SELECT doc_id, t, len(t) AS n, room, list_filter(range(1, len(t) - 2), lambda i: t[i:i + 2] = t[-3:]) AS m3, list_filter(range(1, len(t) - 1), lambda i: t[i:i + 1] = t[-2:]) AS m2 FROM s)
SELECT doc_id, array_to_string(CASE WHEN room <= 0 THEN NULL WHEN n > 3 AND len(m3) > 0 THEN t[m3[1] + 3 : least(m3[1] + 2 + least(3, room), n)] WHEN n > 2 AND len(m2) > 0 THEN t[m2[1] + 2 : least(m2[1] + 1 + least(3, room), n)] END, ',') AS proposal FROM m""")
def _(t: Tables):
    p = K.ngram_proposal(F.col("tokens"), 2, 3, 3, 1_000_000)
    return tokens(t).select("doc_id", F.array_join(F.transform(p, lambda x: x.cast("string")), ",").alias("proposal"))


@query("jsn11_bad_words", f"WITH {TK} SELECT doc_id, len(tokens) >= 2 AND tokens[-2:] = [2, 3] AS bad FROM t")
def _(t: Tables):
    return tokens(t).select("doc_id", K.ends_with_bad_prefix(F.col("tokens"), [2, 3, 1]).alias("bad"))


@query("jsn13_finish_reason", f"WITH {TK} SELECT doc_id, CASE WHEN len(tokens) >= 40 THEN 'length' WHEN tokens[-1] = 0 OR tokens[-1] = 3 THEN 'stop' END AS reason FROM t")
def _(t: Tables):
    n = F.size("tokens")
    return tokens(t).select("doc_id", K.finish_reason(n, n, F.element_at("tokens", -1), 40, 1000, 0, [3]).alias("reason"))


@query("jsn16_token_replace", f"WITH {TK} SELECT doc_id, replace(array_to_string(tokens, ''), '12', '9') AS tokens, (len(array_to_string(tokens, '')) - len(replace(array_to_string(tokens, ''), '12', ''))) // 2 AS found FROM t")
def _(t: Tables):
    rows = tokens(t).select("doc_id", K.replaced(F.col("tokens"), [1, 2], [9]).alias("r"), F.size(K.found_at(F.col("tokens"), [1, 2])).cast("long").alias("found"))
    return rows.select("doc_id", F.array_join(F.transform("r", lambda x: x.cast("string")), "").alias("tokens"), "found")


@query("jsn17_first_one", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 6 AS INT) AS first FROM {lineitem}")
def _(t: Tables):
    k = (F.col("l_linenumber") % 6).cast("int")
    flags = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.when(i >= k, 1).otherwise(0))
    return t("lineitem").select("l_orderkey", "l_linenumber", K.first_one(flags).alias("first"))


@query("jsn18_slot_mapping", "SELECT l_orderkey, l_linenumber, CAST([7, 3, 9][CAST(floor(l_linenumber / 4) AS INT) + 1] * 4 + l_linenumber % 4 AS INT) AS slot FROM {lineitem}")
def _(t: Tables):
    return t("lineitem").select("l_orderkey", "l_linenumber", K.slot(F.col("l_linenumber"), F.array(F.lit(7), F.lit(3), F.lit(9)), 4).cast("int").alias("slot"))


@query("jsn19_merged_logprobs", """WITH e AS (SELECT vec_id, CAST(i - 1 AS INT) AS token, CAST(embedding[i] AS DOUBLE) AS logprob FROM embeddings, unnest(range(1, 65)) u(i)),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY logprob DESC, token) AS rank FROM e)
SELECT vec_id, string_agg(token || ':' || rank, ',' ORDER BY token) AS entries, round(sum(logprob), 6) AS total FROM r WHERE rank <= 5 OR token = vec_id % 64 GROUP BY vec_id""")
def _(t: Tables):
    """The five best of all components, and the sampled one with its rank among them all."""
    from sparkloom.functions.records import merged_logprobs

    entry = "array<struct<token:int,logprob:double>>"
    best = F.array_sort(F.transform("embedding", lambda x, i: F.struct((-x.cast("double")).alias("key"), i.alias("token"))))
    rows = t("embeddings").select("vec_id", F.transform(best, lambda b: F.struct(b["token"].alias("token"), (-b["key"]).alias("logprob"))).cast(entry).alias("ranked"), (F.col("vec_id") % 64).cast("int").alias("sampled"))
    rank = F.array_position(F.transform("ranked", lambda r: r["token"]), F.col("sampled")).cast("int")
    own = F.element_at("ranked", rank)
    m = rows.select("vec_id", F.array_sort(F.map_entries(merged_logprobs(F.col("sampled"), own["logprob"], rank, F.slice("ranked", 1, 5)))).alias("m"))
    entries = F.array_join(F.transform("m", lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"]["rank"].cast("string"))), ",")
    return m.select("vec_id", entries.alias("entries"), F.round(F.aggregate("m", F.lit(0.0), lambda a, e: a + e["value"]["logprob"]), 6).alias("total"))


@query("ag21_token_counts", f"WITH {TK} SELECT token_id, sum(n) AS n, count(*) AS docs FROM (SELECT doc_id, token_id, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS token_id FROM t) GROUP BY ALL) GROUP BY token_id")
def _(t: Tables):
    return P.token_counts(tokens(t).withColumnRenamed("doc_id", "req")).groupBy("token_id").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))


# ---------------------------------------------------------------- scheduling


@query("tk9_queue_order", "SELECT o_orderkey AS req, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderdate, o_orderkey) AS place FROM {orders}")
def _(t: Tables):
    rows = t("orders").select(F.col("o_orderstatus").alias("queue"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("arrival"), F.col("o_orderkey").alias("req"))
    return Q.queue_order(rows, "priority").select("req", F.col("place").cast("long").alias("place"))


@query("tk10_preemption_victim", "SELECT o_orderstatus AS queue, max_by(o_orderkey, (o_orderpriority, o_orderdate, o_orderkey)) AS req FROM {orders} GROUP BY 1")
def _(t: Tables):
    rows = t("orders").select(F.col("o_orderstatus").alias("queue"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("arrival"), F.col("o_orderkey").alias("req"))
    return Q.preemption_victim(rows, "priority")


@query("tk12_top_keywords", "SELECT user_id, count(*) AS n FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY min(ts), event_type) AS r FROM {events} GROUP BY user_id, event_type) WHERE r <= 3 GROUP BY user_id")
def _(t: Tables):
    firsts = t("events").groupBy("user_id", "event_type").agg(F.min("ts").alias("ts"))
    top = firsts.groupBy("user_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("ts", "event_type"))), 1, 3).alias("k"))
    return top.select("user_id", F.size("k").cast("long").alias("n"))


@query("tk14_load_balance")
def _(t: Tables):
    items = t("lineitem").select((F.col("l_orderkey") % 50).alias("group"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"), F.col("l_quantity").alias("size"))
    return Q.balanced(items, 4).groupBy("group", "bin").agg(F.count("*").alias("n"), F.sum("item").alias("items"))


@query("tk15_even_packing")
def _(t: Tables):
    items = t("embeddings").select(F.floor(F.col("vec_id") / 40).alias("group"), F.col("vec_id").alias("item"), F.abs(F.col("embedding")[0]).cast("double").alias("size"))
    return Q.packed_evenly(Q.filled_evenly(items, 8), 8).filter("item IS NOT NULL").groupBy("group", "bin").agg(F.count("*").alias("n"))


@query("tk17_modality_runs", "SELECT conv_id, count(*) AS runs FROM (SELECT conv_id, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS new FROM {conversations}) WHERE new GROUP BY conv_id")
def _(t: Tables):
    from sparkloom.operators.documents import consecutive_groups

    return consecutive_groups(t("conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], "role").groupBy("conv_id").agg(F.max("island").alias("runs"))


@query("set7_store_if_absent", "SELECT source, count(DISTINCT md5(text)) AS n FROM {documents} WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id < 100) GROUP BY source")
def _(t: Tables):
    rows = t("documents").select("source", "doc_id", F.md5("text").alias("hash"))
    return Q.store_if_absent(rows, rows.filter("doc_id < 100")).groupBy("source").agg(F.countDistinct("hash").alias("n"))


@query("flt17_url_dispatch", """SELECT coalesce(task, 'error') AS task, status, count(*) AS n FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'chat' WHEN 1 THEN 'embedding' WHEN 2 THEN 'score' WHEN 3 THEN 'rerank' END AS task, CASE WHEN o_orderkey % 5 = 4 THEN 400 ELSE 200 END AS status FROM {orders}) GROUP BY ALL""")
def _(t: Tables):
    urls = F.array(*[F.lit(u) for u in ("/v1/chat/completions", "/v1/embeddings", "/v1/score", "/v2/rerank", "/bad_url")])
    rows = t("orders").select(F.get(urls, (F.col("o_orderkey") % 5).cast("int")).alias("url"))
    return Q.dispatch(rows).groupBy(F.coalesce("task", F.lit("error")).alias("task"), "status").agg(F.count("*").alias("n"))


@query("jn10_request_order", "SELECT CAST(o_orderkey AS VARCHAR) AS request_id, o_orderstatus FROM {orders}")
def _(t: Tables):
    return Q.in_request_order(t("orders").select(F.col("o_orderkey").cast("string").alias("request_id"), "o_orderstatus"))


@query("udf5_fan_out", "SELECT item_id AS req, item_id % 3 + 1 AS n, string_agg(k || '_' || item_id, ',' ORDER BY k) AS outputs FROM {benchmark}, unnest(range(0, item_id % 3 + 1)) u(k) GROUP BY item_id")
def _(t: Tables):
    rows = t("benchmark").select(F.col("item_id").alias("req"), (F.col("item_id") % 3 + 1).alias("n"))
    fanned = Q.fanned_out(rows).withColumn("output", F.col("child"))
    return Q.regrouped(fanned).join(rows, "req").select("req", "n", F.array_join("outputs", ",").alias("outputs"))


@query("stm4_lru_replay")
def _(t: Tables):
    rows = t("events").select((F.col("user_id") % 10).alias("cache"), F.col("event_id").alias("seq"), F.concat("event_type", (F.col("user_id") % 30).cast("string")).alias("hash"), F.lit(0).alias("pin"))
    return Q.lru_simulation(rows, 5).groupBy("cache").agg(F.count("*").alias("n"), F.count_if("hit").alias("hits"), F.count("evicted").alias("evicted"))


@query("stm5_continuous_batching")
def _(t: Tables):
    rows = t("conversations").select((F.col("conv_id") % 5).alias("queue"), (F.col("conv_id") * 100 + F.col("turn")).alias("req"), F.col("turn").alias("arrival"), (F.length("text") % 200 + 1).alias("prompt"), (F.col("turn") % 5 + 1).alias("output"))
    out = Q.batching_simulation(rows, 256, 8, blocks=40)
    return out.groupBy("queue").agg(F.max("tick").alias("ticks"), F.sum("tokens").alias("tokens"), F.count_if("preempted").alias("preemptions"))


@query("str21_detokenise", """SELECT conv_id, turn, CASE WHEN contains(text, 'er ') THEN left(text, strpos(text, 'er ') - 1) ELSE text END AS text, contains(text, 'er ') AS stopped FROM {conversations} WHERE text <> ''""")
def _(t: Tables):
    """Every text as tokens of three bytes, which cut characters apart; it ends before the first stop string."""
    from sparkloom.operators.detokenising import detokenised
    from sparkloom.operators.documents import joined_text

    rows = t("conversations").select(F.struct("conv_id", "turn").alias("req"), F.encode("text", "utf-8").alias("b"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.length("b") - 1) / 3).cast("int")), lambda i: F.substring("b", i * 3 + 1, F.lit(3)))
    tokens = rows.filter(F.length("b") > 0).select("req", F.posexplode(cut).alias("pos", "piece"))
    out = detokenised(tokens, stop=("er ",))
    stopped = out.groupBy("req").agg(F.bool_or(F.col("stopped").isNotNull()).alias("stopped"))
    return joined_text(out, "req", ["pos"], "delta", "", "text").join(stopped, "req").select("req.conv_id", "req.turn", "text", "stopped")
