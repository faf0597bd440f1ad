"""Queries of layout boxes, speech segments and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkloom.functions import geometry as G
from sparkloom.operators import conversations as C
from sparkloom.operators import documents as D
from sparkloom.operators import layout as L
from sparkloom.operators import speech as S
from sparkloom.plans.base import BOXES, SEGMENTS, Tables, boxes, query, segments
from sparkloom.sources import sinks

B = f"b AS ({BOXES})"
_DIST = "sqrt(pow(greatest(0, {b}.x0 - {a}.x1, {a}.x0 - {b}.x1), 2) + pow(greatest(0, {b}.y0 - {a}.y1, {a}.y0 - {b}.y1), 2))"


@query("flt2_label_filter", f"WITH {B} SELECT label, count(*) AS n FROM b WHERE label IN ('paragraph_title', 'text', 'footer') AND label NOT IN ('footer') GROUP BY label")
def _(t: Tables):
    return L.label_filter(boxes(t), exclude=("footer",)).groupBy("label").agg(F.count("*").alias("n"))


@query("flt3_target_labels", f"WITH {B} SELECT label, count(*) AS n FROM b WHERE label IN ('image', 'chart') GROUP BY label")
def _(t: Tables):
    return L.target_filter(boxes(t)).groupBy("label").agg(F.count("*").alias("n"))


@query("flt4_min_size", f"WITH {B} SELECT label, count(*) AS n FROM b WHERE NOT (abs(x1 - x0) < 200 AND abs(y1 - y0) < 300) GROUP BY label")
def _(t: Tables):
    return L.min_size_filter(boxes(t), 200, 300).groupBy("label").agg(F.count("*").alias("n"))


@query("flt5_max_size", f"WITH {B} SELECT label, count(*) AS n FROM b WHERE abs(x1 - x0) <= 300 AND abs(y1 - y0) <= 850 GROUP BY label")
def _(t: Tables):
    return L.max_size_filter(boxes(t), 300).groupBy("label").agg(F.count("*").alias("n"))


@query("flt7_long_pages", f"WITH {B}, s AS (SELECT *, sum(length(text) + 1) OVER (PARTITION BY doc, page) AS n FROM b) SELECT doc, count(*) AS n FROM s WHERE n >= 12 GROUP BY doc")
def _(t: Tables):
    return L.long_pages(boxes(t), 12).groupBy("doc").agg(F.count("*").alias("n"))


@query("flt8_footers", f"WITH {B} SELECT doc, page, min_by(text, pos) AS footer FROM b WHERE label = 'footer' GROUP BY doc, page")
def _(t: Tables):
    return L.footer_text(boxes(t))


@query("flt12_complete_documents", f"""WITH {B}, e AS (SELECT doc, label, count(*) AS need FROM b GROUP BY ALL), h AS (SELECT doc, label, count(*) AS have FROM b WHERE pos < 4 GROUP BY ALL)
SELECT doc, bool_and(coalesce(have, 0) >= need) AS complete FROM e LEFT JOIN h USING (doc, label) GROUP BY doc""")
def _(t: Tables):
    rows = boxes(t).select("doc", "label", "pos")
    return L.complete_documents(rows, rows.filter("pos < 4"))


@query("jn1_nearest_title", f"""WITH {B}, p AS (SELECT f.doc, f.page, f.pos, f.label, t.text AS t_text, t.pos AS t_pos, {_DIST.format(a="f", b="t")} AS d
FROM b f LEFT JOIN b t ON f.doc = t.doc AND f.page = t.page AND t.label = 'figure_title' WHERE f.label IN ('image', 'chart'))
SELECT doc, page, pos, label, first(t_text ORDER BY d, t_pos DESC) FILTER (WHERE d <= 50 AND t_pos IS NOT NULL) AS subtitle, round(min(d) FILTER (WHERE d <= 50 AND t_pos IS NOT NULL), 6) AS distance FROM p GROUP BY doc, page, pos, label""")
def _(t: Tables):
    return L.nearest_title(boxes(t)).withColumn("distance", F.round("distance", 6))


@query("jn2_has_title", f"""WITH {B} SELECT doc, page, pos, label, CASE WHEN EXISTS (SELECT 1 FROM b t WHERE t.doc = f.doc AND t.page = f.page AND t.label = 'figure_title' AND {_DIST.format(a="f", b="t")} <= 50) THEN 'found' ELSE 'none' END AS flag
FROM b f WHERE label IN ('image', 'chart')""")
def _(t: Tables):
    return L.has_title(boxes(t))


@query("jn5_class_thresholds", "WITH c AS (SELECT p_partkey % 20 AS class_id, round(min(p_size) / 100.0, 6) AS threshold FROM {part} GROUP BY 1) SELECT class_id, count(*) AS n FROM (SELECT l_partkey % 20 AS class_id, l_discount * 10 AS score FROM {lineitem}) JOIN c USING (class_id) WHERE score >= threshold GROUP BY class_id")
def _(t: Tables):
    classes = t("part").groupBy((F.col("p_partkey") % 20).alias("class_id")).agg(F.round(F.min("p_size") / 100.0, 6).alias("threshold"))
    detections = t("lineitem").select((F.col("l_partkey") % 20).alias("class_id"), (F.col("l_discount") * 10).alias("score"))
    return L.with_thresholds(detections, classes).groupBy("class_id").agg(F.count("*").alias("n"))


@query("wn1_block_order")
def _(t: Tables):
    return L.block_order(boxes(t)).groupBy("doc").agg(F.max("block_id").alias("last_block"), F.sum(F.col("rank") * F.col("pos")).alias("check"))


@query("wn3_running_index", f"WITH {B} SELECT doc, page, pos, row_number() OVER (PARTITION BY doc, page, label ORDER BY pos) AS index FROM b")
def _(t: Tables):
    return L.running_index(boxes(t), "label").select("doc", "page", "pos", "index")


@query("wn4_global_number", "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS number FROM {lineitem}")
def _(t: Tables):
    rows = t("lineitem").select("l_orderkey", "l_linenumber").withColumn("span", F.floor(F.col("l_orderkey") / 1000))
    return L.global_number(rows, ["l_orderkey", "l_linenumber"], "span").drop("span")


@query("set2_block_dedup", f"WITH {B} SELECT doc, page, text, min(pos) AS pos FROM b WHERE label <> 'footer' GROUP BY doc, page, text")
def _(t: Tables):
    return L.first_per_block(boxes(t).withColumn("block_id", F.lit(0))).select("doc", "page", "text", "pos")


@query("set6_last_write_wins", "SELECT l_suppkey AS name, max(l_orderkey * 10 + l_linenumber) AS number, max_by(l_partkey, l_orderkey * 10 + l_linenumber) AS l_partkey FROM {lineitem} GROUP BY 1")
def _(t: Tables):
    return L.last_write_wins(t("lineitem").select(F.col("l_suppkey").alias("name"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("number"), "l_partkey"), "name", "number")


@query("ag2_label_counts", f"WITH {B} SELECT doc, count(*) FILTER (WHERE label = 'image') AS n_image, count(*) FILTER (WHERE label = 'chart') AS n_chart FROM b GROUP BY doc")
def _(t: Tables):
    return L.label_counts(boxes(t))


@query("src12_markdown_documents")
def _(t: Tables):
    ordered = L.block_order(boxes(t))
    return D.markdown_documents(ordered, least=10).select("doc", F.length("markdown").alias("n"), F.md5("markdown").alias("digest"))


@query("src25_block_report", f"WITH {B} SELECT doc, page, string_agg(CASE WHEN pos = first THEN '--- block 0 ---' || chr(10) ELSE '' END || pos || '. [' || label || '] ' || text, chr(10) ORDER BY pos, text) AS report FROM (SELECT *, min(pos) OVER (PARTITION BY doc, page) AS first FROM b) GROUP BY doc, page")
def _(t: Tables):
    return sinks.block_report(boxes(t).withColumn("rank", F.col("pos")).withColumn("block_id", F.lit(0)))


@query("mth1_box_distance", f"WITH {B} SELECT a.doc, a.pos, round({_DIST.format(a='a', b='c')}, 6) AS d FROM b a JOIN b c ON a.doc = c.doc AND c.pos = a.pos + 1")
def _(t: Tables):
    rows = boxes(t)
    nxt = rows.select("doc", (F.col("pos") - 1).alias("pos"), F.col("coordinate").alias("other"))
    return rows.join(nxt, ["doc", "pos"]).select("doc", "pos", F.round(G.box_distance(F.col("coordinate"), F.col("other")), 6).alias("d"))


@query("mth2_box_sizes", f"WITH {B} SELECT label, round(avg(abs(x1 - x0)), 6) AS width, round(avg(abs(y1 - y0)), 6) AS height FROM b GROUP BY label")
def _(t: Tables):
    c = F.col("coordinate")
    return boxes(t).groupBy("label").agg(F.round(F.avg(G.box_width(c)), 6).alias("width"), F.round(F.avg(G.box_height(c)), 6).alias("height"))


@query("mth3_padded_boxes", f"WITH {B} SELECT doc, pos, greatest(0, x0 - 5) AS a, greatest(0, y0 - 5) AS b, least(1000, x1 + 5) AS c, least(1000, y1 + 5) AS d FROM b".replace("AS b, least", "AS e, least"))
def _(t: Tables):
    p = G.padded_box(F.col("coordinate"), F.lit(1000), F.lit(1000))
    return boxes(t).select("doc", "pos", *[p[i].alias(n) for i, n in enumerate("aecd")])


@query("mth4_image_sizes", """SELECT p_partkey, CASE WHEN greatest(w, h) > 900 THEN CAST(trunc(w * (900.0::DOUBLE / greatest(w, h))) AS INT) ELSE w END AS lw, CASE WHEN greatest(w, h) > 900 THEN CAST(trunc(h * (900.0::DOUBLE / greatest(w, h))) AS INT) ELSE h END AS lh,
CASE WHEN w > h THEN 1024 ELSE CAST(trunc(w * (1024.0::DOUBLE / h)) AS INT) END AS fw, CASE WHEN w > h THEN CAST(trunc(h * (1024.0::DOUBLE / w)) AS INT) ELSE 1024 END AS fh,
CASE WHEN w % 4 = 0 THEN w WHEN w % 4 = 1 THEN h END AS rw FROM (SELECT p_partkey, CAST(p_size * 31 + 200 AS INT) AS w, CAST(p_partkey % 1500 + 100 AS INT) AS h FROM {part})""")
def _(t: Tables):
    rows = t("part").select("p_partkey", (F.col("p_size") * 31 + 200).cast("int").alias("w"), (F.col("p_partkey") % 1500 + 100).cast("int").alias("h"))
    w, h = F.col("w"), F.col("h")
    angle = F.when(w % 4 == 0, 180).when(w % 4 == 1, 90).otherwise(45)
    s = rows.select("p_partkey", G.long_side_size(w, h, 900).alias("l"), G.longest_dim_size(w, h, 1024).alias("f"), G.rotated_size(w, h, angle).alias("r"))
    return s.select("p_partkey", F.col("l.width").alias("lw"), F.col("l.height").alias("lh"), F.col("f.width").alias("fw"), F.col("f.height").alias("fh"), F.col("r.width").alias("rw"))


@query("mth6_margin_crop", "SELECT p_partkey, CAST(trunc(p_size * 0.05::DOUBLE) AS INT) AS x0, CAST(p_size AS INT) - CAST(trunc(p_size * 0.05::DOUBLE) AS INT) AS x1 FROM {part}")
def _(t: Tables):
    c = G.margin_crop(F.col("p_size"), F.col("p_size"), 5)
    return t("part").select("p_partkey", c[0].alias("x0"), c[2].alias("x1"))


@query("mth9_batches", "SELECT CAST(floor((rn - 1) / 64) AS BIGINT) AS batch, count(*) AS n, min(o_orderkey) AS first FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM {orders}) GROUP BY 1")
def _(t: Tables):
    from pyspark.sql import Window

    rn = F.row_number().over(Window.partitionBy("o_orderstatus").orderBy("o_orderkey"))
    return t("orders").select("o_orderkey", G.batch_number(rn, 64).alias("batch")).groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("mth16_frame_sampling", "SELECT p_partkey, list_sum(CASE WHEN p_size <= 8 THEN range(0, p_size) ELSE list_transform(range(0, 8), lambda i: CAST(floor(i * (p_size - 1) / 7.0::DOUBLE) AS BIGINT)) END) AS total FROM {part}")
def _(t: Tables):
    frames = G.frame_indices(F.col("p_size").cast("int"), F.lit(8))
    return t("part").select("p_partkey", F.aggregate(frames, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("mth20_tight_boxes", f"WITH {B} SELECT doc, greatest(0, min(x0) - 20) AS x0, greatest(0, min(y0) - 20) AS y0, least(1000, max(x0) + 20) AS x1, least(1000, max(y0) + 20) AS y1 FROM b GROUP BY doc")
def _(t: Tables):
    points = boxes(t).groupBy("doc").agg(F.collect_list(F.slice("coordinate", 1, 2)).alias("p"))
    b = G.tight_box(F.col("p"), F.lit(1000), F.lit(1000), F.lit(30))
    return points.select("doc", *[b[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


@query("mth21_unit_rescale", "SELECT p_partkey, round((p_size - 1.0) / 49.0 * 2 - 1, 6) AS u FROM {part}")
def _(t: Tables):
    return t("part").select("p_partkey", F.round(G.rescaled_to_unit(F.col("p_size").cast("double"), F.lit(1.0), F.lit(50.0)), 6).alias("u"))


# ---------------------------------------------------------------- speech

SEG = f"s AS ({SEGMENTS})"
_GAPS = """g AS (SELECT *, lag(end_s, 1, 0.0) OVER (PARTITION BY audio ORDER BY start_s, end_s) AS before FROM s),
f AS (SELECT audio, start_s, end_s, speaker FROM s UNION ALL SELECT audio, before, start_s, 'UNKNOWN' FROM g WHERE start_s > before + 0.5
UNION ALL SELECT audio, e, 20000.0, 'UNKNOWN' FROM (SELECT audio, max_by(end_s, start_s) AS e FROM s GROUP BY audio) WHERE 20000.0 > e + 0.5)"""


@query("wn5_gap_fill", f"WITH {SEG}, {_GAPS} SELECT audio, speaker, count(*) AS n, round(sum(end_s - start_s), 6) AS seconds FROM f GROUP BY audio, speaker")
def _(t: Tables):
    rows = segments(t)
    durations = rows.select("audio").distinct().withColumn("duration", F.lit(20000.0))
    return S.fill_gaps(rows, durations).groupBy("audio", "speaker").agg(F.count("*").alias("n"), F.round(F.sum(F.col("end") - F.col("start")), 6).alias("seconds"))


@query("wn6_fixed_split", f"WITH {SEG}, p AS (SELECT audio, start_s + i * 15 AS a, least(end_s, start_s + (i + 1) * 15) AS b FROM (SELECT *, unnest(range(0, CAST(greatest(1, ceil((end_s - start_s) / 15.0)) AS BIGINT))) AS i FROM s)) SELECT audio, count(*) AS n, round(sum(a), 6) AS starts, round(sum(b), 6) AS ends FROM p GROUP BY audio")
def _(t: Tables):
    return S.split_long(segments(t)).groupBy("audio").agg(F.count("*").alias("n"), F.round(F.sum("start"), 6).alias("starts"), F.round(F.sum("end"), 6).alias("ends"))


@query("wn7_speaker_islands", f"""WITH {SEG}, m AS (SELECT *, CASE WHEN speaker IS DISTINCT FROM lag(speaker) OVER (PARTITION BY audio ORDER BY start_s, end_s) THEN 1 ELSE 0 END AS new FROM s),
i AS (SELECT *, sum(new) OVER (PARTITION BY audio ORDER BY start_s, end_s ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT audio, min(start_s) AS start, max_by(end_s, start_s) AS "end", min(speaker) AS speaker, string_agg(text, ' ' ORDER BY start_s) AS text FROM i GROUP BY audio, island""")
def _(t: Tables):
    return S.merge_speakers(segments(t))


@query("flt13_min_audio", f"WITH {SEG} SELECT audio, count(*) AS n FROM s WHERE floor(start_s * 16000) < 80000000 AND least(floor(end_s * 16000), 80000000) - floor(start_s * 16000) > 160000 GROUP BY audio")
def _(t: Tables):
    return S.long_enough(segments(t).withColumn("samples", F.lit(80_000_000)), least=160_000).groupBy("audio").agg(F.count("*").alias("n"))


@query("flt14_valid_transcripts", f"WITH {SEG} SELECT audio, count(*) AS n FROM s WHERE event_id % 3 = 0 GROUP BY audio")
def _(t: Tables):
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), "text")).when(F.col("event_id") % 3 == 1, "<|nospeech|>").otherwise(" \t ")
    return S.valid_transcripts(segments(t).withColumn("text", text)).groupBy("audio").agg(F.count("*").alias("n"))


@query("flt15_unknown_speakers", f"WITH {SEG} SELECT audio, md5(string_agg(text, ' ' ORDER BY start_s)) AS digest FROM s WHERE event_id % 4 <> 0 GROUP BY audio")
def _(t: Tables):
    rows = segments(t).withColumn("speaker", F.when(F.col("event_id") % 4 == 0, S.UNKNOWN).otherwise(F.col("speaker")))
    return S.full_text(S.without_unknown(rows)).select("audio", F.md5("text").alias("digest"))


@query("ag8_speaker_order", f"WITH {SEG} SELECT audio, speaker, row_number() OVER (PARTITION BY audio ORDER BY min(start_s)) AS number FROM s GROUP BY audio, speaker")
def _(t: Tables):
    return S.speakers(segments(t))


@query("src16_timeline", f"""WITH {SEG} SELECT audio, md5(string_agg(printf('[%02d:%02d - %02d:%02d] **%s**: %s', CAST(floor(start_s / 60) AS INT), CAST(start_s % 60 AS INT), CAST(floor(end_s / 60) AS INT), CAST(end_s % 60 AS INT), speaker, text), chr(10) || chr(10) ORDER BY start_s)) AS digest FROM s GROUP BY audio""")
def _(t: Tables):
    return S.timeline(segments(t)).select("audio", F.md5("markdown").alias("digest"))


# ---------------------------------------------------------------- conversations


@query("flt16_conversation_filter", """WITH s AS (SELECT *, max(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS started FROM {conversations}),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM s WHERE started = 1),
m AS (SELECT *, bool_and(role = CASE WHEN n % 2 = 1 THEN 'user' ELSE 'assistant' END AND length(text) <= 4000) OVER (PARTITION BY conv_id) AS ok, count(*) OVER (PARTITION BY conv_id) AS c FROM n WHERE n <= 4)
SELECT conv_id, turn, role, n FROM m WHERE ok AND c >= 2""")
def _(t: Tables):
    return C.cleaned(t("conversations"), 2, 4, None, 4000).select("conv_id", "turn", "role", F.col("n").cast("long").alias("n"))


@query("flt16_non_ascii_only", "SELECT conv_id, count(*) AS n FROM {conversations} GROUP BY conv_id HAVING bool_and(strlen(text) <> length(text))")
def _(t: Tables):
    return C.non_ascii_only(t("conversations")).groupBy("conv_id").agg(F.count("*").alias("n"))


@query("ag9_conversation_statistics", """SELECT conv_id, count(*) AS turns, sum(CASE WHEN role = 'user' THEN length(text) - length(replace(text, ' ', '')) + 1 ELSE 0 END) AS user_words, sum(CASE WHEN role = 'assistant' THEN length(text) - length(replace(text, ' ', '')) + 1 ELSE 0 END) AS assistant_words,
sum(CASE WHEN role = 'user' THEN length(text) ELSE 0 END) AS user_chars, sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS assistant_chars FROM {conversations} GROUP BY conv_id""")
def _(t: Tables):
    return C.statistics(t("conversations"))


@query("jn11_part_stitching", """WITH p AS (SELECT conv_id, CAST(floor(turn / 3) AS INT) AS part, turn AS pos, CASE WHEN turn % 4 = 0 THEN 'assistant' ELSE role END AS role, text FROM {conversations}),
m AS (SELECT *, row_number() OVER (PARTITION BY conv_id, part ORDER BY pos) = 1 AND coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY part, pos) = role, false) AS gone FROM p)
SELECT CAST(conv_id AS VARCHAR) AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS n, role, length(text) AS chars FROM m WHERE NOT gone""")
def _(t: Tables):
    turn = F.col("turn")
    parts = t("conversations").select(F.concat_ws("_", F.col("conv_id").cast("string"), F.floor(turn / 3).cast("string")).alias("id"), turn.alias("pos"), F.when(turn % 4 == 0, "assistant").otherwise(F.col("role")).alias("role"), "text")
    return C.stitched(parts).select("conv", F.col("n").cast("long").alias("n"), "role", F.length("text").cast("long").alias("chars"))


@query("wn9_between_turns", "SELECT conv_id, turn, (turn * 2500 + conv_id - lag(turn * 2500 + conv_id) OVER (PARTITION BY conv_id ORDER BY turn)) / 1000.0::DOUBLE AS since_last FROM {conversations}")
def _(t: Tables):
    return C.between_turns(t("conversations").withColumn("ms", F.col("turn") * 2500 + F.col("conv_id")), "ms").select("conv_id", "turn", "since_last")


@query("wn16_prompt_sizes", "SELECT conv_id, turn, prompt FROM (SELECT *, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS prompt FROM {conversations}) WHERE role = 'user'")
def _(t: Tables):
    return C.prompt_sizes(t("conversations"))


@query("tk13_seeded_sample")
def _(t: Tables):
    return C.seeded_sample(t("customer").select("c_custkey", "c_name"), "c_custkey", 50, 7)


@query("jsn15_few_shot_prompts", """WITH e AS (SELECT string_agg('Question: ' || text || chr(10) || 'Answer: ' || item_id || chr(10) || chr(10), '' ORDER BY item_id) AS prefix FROM {benchmark} WHERE item_id < 3)
SELECT item_id AS id, md5(prefix || 'Question: ' || text || chr(10) || 'Answer:') AS digest FROM {benchmark}, e WHERE item_id >= 3""")
def _(t: Tables):
    items = t("benchmark")
    examples = items.filter("item_id < 3").select(F.col("item_id").alias("pos"), F.col("text").alias("question"), F.col("item_id").cast("string").alias("answer"))
    questions = items.filter("item_id >= 3").select(F.col("item_id").alias("id"), F.col("text").alias("question"))
    return C.few_shot_prompts(questions, examples).select("id", F.md5("prompt").alias("digest"))
