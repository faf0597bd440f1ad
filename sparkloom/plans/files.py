"""Queries of source, sink and adapter semantics on rows that stand for files."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkloom.functions import geometry as G
from sparkloom.functions import records as R
from sparkloom.functions import tables as H
from sparkloom.functions import text as T
from sparkloom.functions import vectors as V
from sparkloom.operators import adapters as A
from sparkloom.operators import documents as D
from sparkloom.plans.base import BOXES, LOGITS_SQL, Tables, boxes, logits, query
from sparkloom.sources import files as S
from sparkloom.sources.content import content_type
from sparkloom.streaming.operators import with_dead_letters

#: Documents as files: every seventh below a metadata folder.
_PATH = "'/d/' || CASE WHEN doc_id % 2 = 0 THEN 'PDF' ELSE 'IMG' END || '/' || source || CASE WHEN doc_id % 7 = 0 THEN '/metadata' ELSE '' END || '/layout_' || (doc_id % 50) || CASE doc_id % 4 WHEN 0 THEN '.JSON' WHEN 1 THEN '.png' WHEN 2 THEN '.tar.gz' ELSE '' END"


def _files(t: Tables):
    i = F.col("doc_id")
    path = F.concat(
        F.lit("/d/"), F.when(i % 2 == 0, "PDF").otherwise("IMG"), F.lit("/"), "source", F.when(i % 7 == 0, "/metadata").otherwise(""), F.lit("/layout_"), (i % 50).cast("string"),
        F.when(i % 4 == 0, ".JSON").when(i % 4 == 1, ".png").when(i % 4 == 2, ".tar.gz").otherwise(""),
    )
    return t("documents").select("doc_id", path.alias("path"), F.encode("text", "utf-8").alias("content"), F.octet_length("text").cast("long").alias("length"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("modificationTime"))


@query("src1_metadata_pruning", f"SELECT count(*) AS n, count(DISTINCT path) AS paths FROM (SELECT {_PATH} AS path FROM {{documents}}) WHERE NOT regexp_matches(path, '/metadata/')")
def _(t: Tables):
    return _files(t).filter(~F.col("path").rlike("/metadata/")).agg(F.count("*").alias("n"), F.countDistinct("path").alias("paths"))


@query("src2_file_inventory", f"""SELECT path AS file_path, regexp_extract(path, '[^/]*$') AS file_name, CAST(strlen(text) AS BIGINT) AS file_size, lower(regexp_extract(regexp_extract(path, '[^/]*$'), '.(\\.[^.]*)$', 1)) AS file_extension, md5(text) AS file_hash_md5
FROM (SELECT {_PATH} AS path, text FROM {{documents}})""")
def _(t: Tables):
    return S.inventory(_files(t)).select("file_path", "file_name", "file_size", "file_extension", "file_hash_md5")


# The first bytes of some types.
_HEADS = {"255044462D": "application/pdf", "89504E470D0A1A0A": "image/png", "FFD8FF": "image/jpeg", "524946460000000057415645": "audio/x-wav", "524946460000000057454250": "image/webp", "0000002066747970": "video/mp4", "00": "application/octet-stream"}


@query("src2_content_types", f"""SELECT page_id, CASE page_id % 8 {" ".join(f"WHEN {i} THEN '{kind}'" for i, kind in enumerate(_HEADS.values()))} ELSE 'text/html' END AS mime_type FROM {{pages}}""")
def _(t: Tables):
    """Pages behind the first bytes of other types, or as they are, which is HTML."""
    head = F.unhex(F.element_at(F.array(*[F.lit(h) for h in _HEADS], F.lit("3C68746D6C3E")), (F.col("page_id") % 8 + 1).cast("int")))
    rows = t("pages").select("page_id", content_type(F.concat(head, F.col("html").cast("binary"))).alias("k"))
    return rows.select("page_id", F.regexp_replace("k.mime_type", "^text/.*", "text/html").alias("mime_type"))


@query("src5_layout_discovery", f"SELECT string_split(path, '/')[-2] AS doc, doc_id % 50 AS page, count(*) AS n FROM (SELECT doc_id, {_PATH} AS path FROM {{documents}}) WHERE path LIKE '%layout_%' AND lower(path) LIKE '%.json' GROUP BY ALL")
def _(t: Tables):
    rows = _files(t).filter(F.col("path").contains("layout_") & (T.extension(F.col("path")) == ".json"))
    return rows.select(T.folder_of(F.col("path")).alias("doc"), T.layout_page(T.file_name(F.col("path"))).cast("long").alias("page")).groupBy("doc", "page").agg(F.count("*").alias("n"))


@query("src6_pages_of_documents", f"SELECT doc, string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) AS pages FROM (SELECT DISTINCT string_split(path, '/')[-2] AS doc, doc_id % 50 AS page FROM (SELECT doc_id, {_PATH} AS path FROM {{documents}})) GROUP BY doc")
def _(t: Tables):
    rows = _files(t).select(T.folder_of(F.col("path")).alias("doc"), T.layout_page(T.file_name(F.col("path"))).alias("page")).distinct()
    return D.collected(rows, "doc", ["page"], "page", "p").select("doc", F.array_join(F.transform("p", lambda p: p.cast("string")), ",").alias("pages"))


@query("src7_folder_types", "SELECT CASE WHEN doc_id % 2 = 0 THEN 'PDF' ELSE 'IMG' END AS folder_type, count(*) AS n FROM {documents} GROUP BY 1")
def _(t: Tables):
    return S.with_folder_type(_files(t)).groupBy("folder_type").agg(F.count("*").alias("n"))


@query("src8_skip_bad_json", "SELECT sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS total, count(*) AS n FROM {events} WHERE event_id % 3 <> 0")
def _(t: Tables):
    raw = t("events").select(F.when(F.col("event_id") % 3 == 0, F.lit('["not')).otherwise(F.col("props")).alias("value"))
    good, _ = with_dead_letters(raw, "k INT")
    return good.agg(F.sum("k").alias("total"), F.count("*").alias("n"))


@query("src11_image_files", f"SELECT DISTINCT path FROM (SELECT {_PATH} AS path FROM {{documents}}) WHERE lower(path) LIKE '%.png'")
def _(t: Tables):
    return S.image_files(_files(t))


@query("src17_request_lines", "SELECT CAST(o_orderkey AS VARCHAR) AS custom_id, '/v1/embeddings' AS url FROM {orders} WHERE o_orderkey % 3 <> 0")
def _(t: Tables):
    k = F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 3 == 0, "   ").otherwise(F.concat(F.lit('{"custom_id":"'), k, F.lit('","method":"POST","url":"/v1/embeddings","body":{"x":1}}')))
    return S.parsed_requests(t("orders").select(line.alias("value"))).select("custom_id", "url")


@query("src18_response_lines", "SELECT 'batch-' || left(sha256(CAST(o_orderkey AS VARCHAR)), 32) AS id, CAST(o_orderkey AS VARCHAR) AS custom_id, CASE WHEN o_orderkey % 4 = 0 THEN 400 ELSE 200 END AS status_code, CASE WHEN o_orderkey % 4 = 0 THEN 'bad' END AS error FROM {orders}")
def _(t: Tables):
    status = F.when(F.col("o_orderkey") % 4 == 0, 400).otherwise(200)
    rows = t("orders").select(F.col("o_orderkey").cast("string").alias("custom_id"), status.alias("status"), F.lit("{}").alias("body"), F.lit("bad").alias("error"))
    return S.responses(rows).select("id", "custom_id", "response.status_code", "error")


@query("src19_media_sources", "SELECT CASE WHEN page_id % 3 = 0 THEN 'data' WHEN page_id % 3 = 1 THEN 'refused' ELSE 'http' END AS source, count(*) AS n FROM {pages} GROUP BY 1")
def _(t: Tables):
    k = F.col("page_id") % 3
    url = F.when(k == 0, F.concat(F.lit("data:text/plain;base64,"), F.base64(F.encode("url", "utf-8")))).when(k == 1, "file:///ok/../x").otherwise(F.col("url"))
    return t("pages").select(S.media_source(url, "/ok").alias("source")).groupBy("source").agg(F.count("*").alias("n"))


@query("src19_data_urls", "SELECT page_id, url AS text FROM {pages}")
def _(t: Tables):
    data = S.data_url(F.concat(F.lit("data:text/plain;base64,"), F.base64(F.encode("url", "utf-8"))))
    return t("pages").select("page_id", F.decode(data["data"], "utf-8").alias("text"))


@query("wn2_hybrid_sort", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber // 3, l_suppkey, l_linenumber) AS rank FROM {lines}")
def _(t: Tables):
    order = Window.partitionBy("l_orderkey").orderBy(F.floor(F.col("l_linenumber") / 3), "l_suppkey", "l_linenumber")
    return t("lines").select("l_orderkey", "l_linenumber", F.row_number().over(order).cast("long").alias("rank"))


@query("tk1_page_sort", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 100 END, o_orderkey) AS place FROM {orders}")
def _(t: Tables):
    page = F.when(F.col("o_orderkey") % 5 == 0, "none").otherwise((F.col("o_orderkey") % 100).cast("string"))
    rows = t("orders").select("o_orderkey", "o_orderstatus", page.alias("page_num"))
    return rows.select("o_orderkey", F.row_number().over(Window.partitionBy("o_orderstatus").orderBy(D.page_order(), "o_orderkey")).cast("long").alias("place"))


@query("tk11_first_match", f"WITH b AS ({BOXES}) SELECT doc, min_by(text, pos) AS text FROM b WHERE label = 'image' GROUP BY doc")
def _(t: Tables):
    return boxes(t).filter("label = 'image'").groupBy("doc").agg(F.min_by("text", "pos").alias("text"))


@query("str13_markdown_blocks", f"WITH b AS ({BOXES}) SELECT doc, pos, CASE WHEN label = 'paragraph_title' THEN '**' || text || '**' ELSE text END || chr(10) || chr(10) AS md FROM b")
def _(t: Tables):
    return boxes(t).select("doc", "pos", T.markdown_block(F.col("label"), F.col("text")).alias("md"))


@query("str19_parser_registry", "SELECT conv_id, turn, 'look' AS name FROM {conversations}")
def _(t: Tables):
    output = F.concat(F.lit('[{"name": "look", "arguments": "{\\"id\\": '), F.col("conv_id").cast("string"), F.lit('}"}]'))
    return t("conversations").select("conv_id", "turn", F.get(T.TOOL_PARSERS["bare_json"](output)["calls"], F.lit(0))["name"].alias("name"))


@query("mth5_forced_resize", "SELECT p_partkey, CASE WHEN w > h THEN 64 ELSE CAST(trunc(w * (64.0::DOUBLE / h)) AS INT) END AS fw FROM (SELECT p_partkey, CAST(p_size AS INT) AS w, CAST(p_partkey % 40 + 1 AS INT) AS h FROM {part})")
def _(t: Tables):
    size = G.longest_dim_size(F.col("p_size").cast("int"), (F.col("p_partkey") % 40 + 1).cast("int"), 64)
    return t("part").select("p_partkey", size["width"].alias("fw"))


@query("mth7_rotation", "SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN 7 WHEN 3 THEN 7 WHEN 4 THEN NULL ELSE CAST(p_size AS INT) END AS width FROM {part}")
def _(t: Tables):
    angle = F.when(F.col("p_partkey") % 5 == 4, 45).otherwise((F.col("p_partkey") % 5 * 90).cast("int"))
    return t("part").select("p_partkey", G.rotated_size(F.col("p_size").cast("int"), F.lit(7), angle)["width"].alias("width"))


@query("mth18_audio_split")
def _(t: Tables):
    rows = t("embeddings").select(F.col("vec_id").cast("string").alias("audio"), F.col("embedding").cast("array<double>").alias("samples"))
    return A.split_audio(rows, 8, 3.0, 4)


@query("mth17_resample", """WITH s AS (SELECT vec_id, list_transform(range(1, 33), lambda i: (CAST(embedding[i] AS DOUBLE) + CAST(embedding[i + 32] AS DOUBLE)) / 2) AS x FROM embeddings),
r AS (SELECT vec_id, i, i * 44100.0 / 16000 AS p, x FROM s, unnest(range(0, 12)) u(i)), f AS (SELECT vec_id, i, p, CAST(floor(p) AS BIGINT) AS j, x FROM r)
SELECT vec_id, CAST(i AS INT) AS i, round(x[least(j, 31) + 1] + (x[least(j + 1, 31) + 1] - x[least(j, 31) + 1]) * (p - j), 6) AS sample FROM f""")
def _(t: Tables):
    """Left and right channel of 32 samples each."""
    channels = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)).cast("array<array<double>>")
    mixed = t("embeddings").select("vec_id", V.mono(F.transform(channels, lambda c: V.resampled(c, 44_100))).alias("x"))
    return mixed.select("vec_id", F.posexplode("x").alias("i", "sample")).select("vec_id", "i", F.round("sample", 6).alias("sample"))


_WEIGHT = "CASE WHEN abs(t) >= 6 THEN 0 WHEN t = 0 THEN 1 ELSE sin(pi() * t) / (pi() * t) * pow(cos(t * pi() / 12), 2) END"


@query("mth17_band_limited", f"""WITH s AS (SELECT vec_id, j, (CAST(embedding[j + 1] AS DOUBLE) + CAST(embedding[j + 33] AS DOUBLE)) / 2 AS x FROM embeddings, unnest(range(0, 32)) u(j)),
w AS (SELECT vec_id, i, x, (j / 441.0::DOUBLE - i / 160.0::DOUBLE) * 158.4 AS t FROM s, unnest(range(0, 12)) u(i))
SELECT vec_id, CAST(i AS INT) AS i, round(sum(x * {_WEIGHT}) * 158.4 / 441, 6) + 0.0 AS sample FROM w GROUP BY vec_id, i""")
def _(t: Tables):
    """Left and right channel of 32 samples each, from 44.1 to 16 kHz and mixed."""
    channels = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    mixed = t("embeddings").select("vec_id", V.waveform(channels, 44_100).alias("x"))
    return mixed.select("vec_id", F.posexplode("x").alias("i", "sample")).select("vec_id", "i", (F.round("sample", 6) + 0.0).alias("sample"))


@query("mth19_unwarp", """WITH g AS (SELECT vec_id, embedding AS e, y, x, 1.75 + 1.75 * x AS px, 1.75 * y AS py FROM embeddings, unnest(range(0, 3)) a(x), unnest(range(0, 5)) b(y)),
f AS (SELECT *, CAST(floor(px) AS BIGINT) AS x0, least(CAST(floor(py) AS BIGINT), 6) AS y0 FROM g)
SELECT vec_id, CAST(y AS INT) AS y, CAST(x AS INT) AS x, round((CAST(e[y0 * 8 + x0 + 1] AS DOUBLE) * (1 - px + x0) + CAST(e[y0 * 8 + x0 + 2] AS DOUBLE) * (px - x0)) * (1 - py + y0)
+ (CAST(e[y0 * 8 + x0 + 9] AS DOUBLE) * (1 - px + x0) + CAST(e[y0 * 8 + x0 + 10] AS DOUBLE) * (px - x0)) * (py - y0), 6) AS value FROM f""")
def _(t: Tables):
    """Images of 8 x 8; the grid narrows them to the middle half."""
    image = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, F.lit(8))).cast("array<array<double>>")
    corner = [F.array(*[F.array(F.lit(x), F.lit(y)) for x in (-0.5, 0.5)]) for y in (-1.0, 1.0)]
    out = A.grid_unwarped(t("embeddings").select("vec_id", image.alias("image"), F.array(*corner).alias("grid")), 3, 5)
    rows = out.select("vec_id", F.posexplode("image").alias("y", "row"))
    return rows.select("vec_id", "y", F.posexplode("row").alias("x", "value")).select("vec_id", "y", "x", F.round("value", 6).alias("value"))


@query("udf1_stateful_processor", """SELECT vec_id AS req, CAST(64 - len(list_distinct([vec_id % 7, vec_id % 5])) AS BIGINT) AS left_over FROM embeddings""")
def _(t: Tables):
    """A processor that never repeats an output token, told of two tokens of every request."""
    rows = logits(t)
    once = A.LogitsProcessor(lambda ids, x, outputs: np.where(np.isin(ids, outputs), -np.inf, x), stateful=True)
    ids = t("embeddings").select(F.col("vec_id").alias("req"))
    once.update_state(ids.select("req", F.lit(0).alias("pos"), (F.col("req") % 7).alias("token")))
    added = ids.select("req", F.lit(1).alias("pos"), (F.col("req") % 5).alias("token"))
    return A.processed(rows, [once], added=added).filter(F.col("logit") > float("-inf")).groupBy("req").agg(F.count("*").alias("left_over"))


@query("jsn2_image_tags", "SELECT page_id, trim(replace('<image> ' || url || '<image>', '<image>', ''), ' ') AS text FROM {pages}")
def _(t: Tables):
    return t("pages").select("page_id", R.without_image_tags(F.concat(F.lit("<image> "), "url", F.lit("<image>"))).alias("text"))


@query("jsn4_matrix_to_html", """SELECT o_orderkey, '<table><tr><td colspan="2">' || o_orderstatus || '</td></tr><tr><td rowspan="2">' || o_orderkey || '</td><td>b</td></tr><tr><td>c</td></tr></table>' AS html FROM {orders}""")
def _(t: Tables):
    matrix = F.concat(F.lit("<table><tr><td>"), "o_orderstatus", F.lit("</td><td><l></l></td></tr><tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td>b</td></tr><tr><td><t></t></td><td>c</td></tr></table>"))
    return t("orders").select("o_orderkey", H.tables_to_html(matrix).alias("html"))


@query("jsn5_html_to_matrix", "SELECT o_orderkey, '<table><tr><td>' || o_orderstatus || '</td><td><l></td></tr><tr><td><t></td><td><lt></td></tr><tr><td>x</td><td>' || o_orderkey || '</td></tr></table>' AS matrix FROM {orders}")
def _(t: Tables):
    html = F.concat(F.lit('<table><tr><td rowspan="2" colspan="2">'), "o_orderstatus", F.lit("</td></tr><tr></tr><tr><td>x</td><td>"), F.col("o_orderkey").cast("string"), F.lit("</td></tr></table>"))
    return t("orders").select("o_orderkey", H.tables_to_matrix(html).alias("matrix"))


@query("jsn6_markdown_fragments", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'intro' || chr(10) || chr(10) || '<table><tr><td colspan="2">' || o_orderstatus || '</td></tr></table>' END AS markdown FROM {orders}""")
def _(t: Tables):
    text = F.concat(F.lit("intro\n\n<table><tr><td>"), "o_orderstatus", F.lit("</td><td><l></l></td></tr></table>"))
    return t("orders").select("o_orderkey", H.tables_to_html(F.when(F.col("o_orderkey") % 2 == 0, text)).alias("markdown"))


@query("jsn7_metadata_override", "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '_text' AS id, 'new ' || o_orderstatus AS text FROM {orders}")
def _(t: Tables):
    record = F.struct(F.struct(F.concat(F.col("o_orderkey").cast("string"), F.lit("_text")).alias("id"), F.lit("old").alias("text")).alias("metadata"))
    changed = R.with_metadata_fields(record, text=F.concat(F.lit("new "), "o_orderstatus"))
    return t("orders").select("o_orderkey", changed.alias("r")).select("o_orderkey", "r.metadata.id", "r.metadata.text")


@query("udf1_logits_processor", f"WITH l AS ({LOGITS_SQL}) SELECT req, round(sum(CASE WHEN token_id < 8 THEN logit / 2 ELSE logit END), 6) AS total FROM l GROUP BY req")
def _(t: Tables):
    halve = A.LogitsProcessor(lambda ids, x: np.where(ids >= 8, x, x / 2))
    return A.processed(logits(t), [halve]).groupBy("req").agg(F.round(F.sum("logit"), 6).alias("total"))


@query("udf3_batch_inference", "SELECT item_id, 'answer ' || left(sha256(text), 8) AS output FROM {benchmark}")
def _(t: Tables):
    return A.infer(t("benchmark"), "generate").select("item_id", "output")


@query("udf7_output_constraints", "SELECT count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS choice, count(*) FILTER (WHERE regexp_full_match(o_orderpriority, '[1-3]-.*')) AS regex, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS json FROM {orders}")
def _(t: Tables):
    body = F.when(F.col("o_orderkey") % 2 == 0, '{"x": 1}').otherwise('{"x": ')
    return t("orders").agg(
        F.count_if(A.meets(F.col("o_orderstatus"), "choice", ["F", "O"])).alias("choice"),
        F.count_if(A.meets(F.col("o_orderpriority"), "regex", "[1-3]-.*")).alias("regex"),
        F.count_if(A.meets(body, "json", "x int")).alias("json"),
    )


@query("src13_ocr_failures", "SELECT page_id, '# p' || page_id || chr(10) || chr(10) || '[처리 실패: bad]' AS markdown FROM {pages}")
def _(t: Tables):
    return t("pages").select("page_id", R.failed_page_markdown(F.concat(F.lit("p"), F.col("page_id").cast("string")), F.lit("bad")).alias("markdown"))

