"""Queries of text scalars, sentence and chunk operators, documents and pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkloom.functions import records as R
from sparkloom.functions import text as T
from sparkloom.functions.repetition import collapsed
from sparkloom.operators import documents as D
from sparkloom.plans.base import Tables, query

_DISTINCT = "list_filter({x}, lambda e, i: list_position({x}, e) = i)"
_SENTENCES = r"string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"
_TRIMMED = f"list_filter(list_transform({_SENTENCES}, lambda s: trim(s, E' \\t\\n\\r')), lambda s: s <> '')"
_DEDUP = "array_to_string(" + _DISTINCT.format(x="ss") + ", ' ')"


@query("str1_sentence_split", f"SELECT doc_id, len({_SENTENCES}) AS n, {_SENTENCES}[1] AS first_sentence FROM {{documents}}")
def _(t: Tables):
    s = T.sentences(F.col("text"))
    return t("documents").select("doc_id", F.size(s).cast("long").alias("n"), s[0].alias("first_sentence"))


@query("set1_sentence_dedup", f"SELECT doc_id, {_DEDUP} AS text FROM (SELECT doc_id, {_TRIMMED} AS ss FROM {{documents}})")
def _(t: Tables):
    return t("documents").select("doc_id", T.dedup_sentences(F.col("text")).alias("text"))


#: Paragraphs do not occur in the table, so line ends stand for them. Pieces are packed by recursion over their number.
_CHUNKS = f"""
WITH RECURSIVE d AS (SELECT doc_id, {{text}} AS text FROM {{documents}}),
p AS (SELECT doc_id, text, pi, par FROM d, unnest(string_split(text, chr(10) || chr(10))) WITH ORDINALITY u(par, pi) WHERE length(text) > {{most}}),
q AS (
  SELECT doc_id, pi, si, piece, CASE WHEN length(par) > {{most}} THEN 2 ELSE 4 END AS room, CASE WHEN length(par) > {{most}} THEN ' ' ELSE chr(10) || chr(10) END AS sep
  FROM p, unnest(CASE WHEN length(par) > {{most}} THEN string_split(regexp_replace(par, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) ELSE [par] END) WITH ORDINALITY u(piece, si)
),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pi, si) AS k, count(*) OVER (PARTITION BY doc_id) AS total FROM q),
r AS (
  SELECT doc_id, k, total, piece AS cur, CAST(NULL AS VARCHAR) AS done FROM n WHERE k = 1
  UNION ALL
  SELECT n.doc_id, n.k, n.total,
         CASE WHEN length(r.cur) + length(n.piece) + n.room <= {{most}} THEN CASE WHEN r.cur <> '' THEN r.cur || n.sep || n.piece ELSE n.piece END ELSE n.piece END,
         CASE WHEN length(r.cur) + length(n.piece) + n.room <= {{most}} OR r.cur = '' THEN NULL ELSE trim(r.cur, E' \\t\\n\\r') END
  FROM r JOIN n ON n.doc_id = r.doc_id AND n.k = r.k + 1
),
c AS (
  SELECT doc_id, k AS ord, done AS chunk FROM r WHERE done IS NOT NULL
  UNION ALL SELECT doc_id, k + 1, trim(cur, E' \\t\\n\\r') FROM r WHERE k = total AND cur <> ''
  UNION ALL SELECT doc_id, 1, text FROM d WHERE length(text) <= {{most}} AND text <> ''
),
chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS n, chunk FROM c)
"""


def _chunks_sql(text: str, most: int) -> str:
    return _CHUNKS.replace("{text}", text).replace("{most}", str(most))


@query("str4_chunk_split", _chunks_sql("replace(text, chr(10), chr(10) || chr(10))", 800) + "SELECT doc_id, n, chunk FROM chunks")
def _(t: Tables):
    text = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    return t("documents").select("doc_id", F.posexplode(T.split_chunks(text, 800)).alias("n", "chunk")).select("doc_id", (F.col("n") + 1).cast("long").alias("n"), "chunk")


_FLAGSHIP = (
    _chunks_sql(f"(SELECT {_DEDUP} FROM (SELECT {_TRIMMED} AS ss) x)", 2000)
    + """SELECT lang, toxic, count(*) AS chunks, count(DISTINCT doc_id) AS docs, round(avg(length(chunk)), 6) AS mean_chars
FROM chunks JOIN documents USING (doc_id) LEFT JOIN labels USING (doc_id) GROUP BY lang, toxic"""
)


@query("str5_chunk_report", _FLAGSHIP)
def chunk_report(t: Tables):
    """Sentences deduplicated, chunked, joined with labels, counted by language. Chunks are counted in place, so no text is shuffled."""
    def sizes(chunks):
        return F.struct(F.size(chunks).alias("n"), F.aggregate(chunks, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("chars"))

    # no filter on the chunks: it would be pushed below their projection and split every text twice
    docs = t("documents").select("doc_id", "lang", T.let(T.gated_chunks(T.dedup_sentences(F.col("text"))), sizes).alias("s")).select("doc_id", "lang", "s.n", "s.chars")
    joined = docs.join(t("labels").select("doc_id", "toxic"), "doc_id", "left")
    out = joined.groupBy("lang", "toxic").agg(F.sum("n").alias("chunks"), F.count_if(F.col("n") > 0).alias("docs"), F.sum("chars").alias("chars"))
    return out.filter("chunks > 0").select("lang", "toxic", "chunks", "docs", F.round(F.col("chars") / F.col("chunks"), 6).alias("mean_chars"))


@query("str3_repetition_collapse")
def _(t: Tables):
    text = F.col("text")
    return t("documents").select("doc_id", F.length(collapsed(text)).alias("intended"), F.length(collapsed(text, mode="observed")).alias("observed"))


@query("str2_page_markers", r"""SELECT doc_id, length(trim(regexp_replace(regexp_replace(regexp_replace(md, '\n---\n', chr(10), 'g'), '## 페이지 \d+', '', 'g'), '\n\s*\n\s*\n', chr(10) || chr(10), 'g'), E' \t\n\r')) AS n
FROM (SELECT doc_id, '## 페이지 ' || (doc_id % 40) || chr(10) || chr(10) || text || chr(10) || '---' || chr(10) AS md FROM {documents})""")
def _(t: Tables):
    md = F.concat(F.lit("## 페이지 "), (F.col("doc_id") % 40).cast("string"), F.lit("\n\n"), F.col("text"), F.lit("\n---\n"))
    return t("documents").select("doc_id", F.length(T.remove_page_markers(md)).cast("long").alias("n"))


#: An empty line takes the next numbered line into its chunk, so every other line of a run of empty ones heads a chunk.
_RESPONSE = r"""WITH l AS (SELECT doc_id, i, len(x) AS m, x[i] AS line, regexp_matches(x[i], '^\s*$') AS blank FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM {documents}), unnest(range(1, len(x) + 1)) u(i)),
r AS (SELECT *, i - 1 - coalesce(max(CASE WHEN NOT blank THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM l),
c AS (SELECT doc_id, i, CASE WHEN NOT blank THEN trim(line, E' \t\n\r') WHEN i < m THEN rtrim('청크 ' || (i + 1) || ':' || chr(10) || next, E' \t\n\r') END AS chunk FROM r WHERE run % 2 = 0)
SELECT doc_id, count(chunk) AS n, first(chunk ORDER BY i) FILTER (WHERE chunk IS NOT NULL) AS first_chunk FROM c GROUP BY doc_id"""


@query("str6_chunk_response", _RESPONSE)
def _(t: Tables):
    rows = t("documents")
    lines = F.split("text", "\n", -1)
    response = F.array_join(F.transform(lines, lambda s, i: F.concat(F.lit("청크 "), (i + 1).cast("string"), F.lit(":\n"), s)), "\n")
    found = T.parse_chunk_response(response)
    return rows.select("doc_id", F.size(found).cast("long").alias("n"), F.get(found, F.lit(0)).alias("first_chunk"))


@query("str7_think_removal", r"""SELECT conv_id, turn, trim(text, E' \t\n\r') AS closed, trim(text, E' \t\n\r') AS unclosed FROM {conversations}""")
def _(t: Tables):
    text = F.col("text")
    closed = T.remove_thinking(F.concat(F.lit("<think>a\nb</think>"), text))
    return t("conversations").select("conv_id", "turn", closed.alias("closed"), T.remove_thinking(F.concat(text, F.lit("<think>"), text)).alias("unclosed"))


@query("str8_keywords", f"""SELECT doc_id, array_to_string(({_DISTINCT.format(x='k')})[1:5], '|') AS keywords FROM
(SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '[，、]', ',', 'g'), ','), lambda x: trim(x, E' \\t\\n\\r')), lambda x: x <> '') AS k FROM {{documents}})""")
def _(t: Tables):
    return t("documents").select("doc_id", F.array_join(T.keywords(F.col("text")), "|").alias("keywords"))


@query("str9_page_numbers", r"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 1000 END AS layout_page,
CASE WHEN o_orderkey % 3 = 0 THEN '000' ELSE lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS page,
CASE WHEN o_orderkey % 3 <> 0 THEN lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS page_or_null FROM {orders}""")
def _(t: Tables):
    page = F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0")
    name = F.when(F.col("o_orderkey") % 3 == 0, "cover.json").otherwise(F.concat(F.lit("layout_"), page, F.lit("_sorted.json")))
    return t("orders").select("o_orderkey", T.layout_page(name).cast("long").alias("layout_page"), T.three_digit_page(name).alias("page"), T.three_digit_page_or_null(name).alias("page_or_null"))


@query("str10_numbered_lists", r"SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE regexp_matches(CASE o_orderkey % 4 WHEN 0 THEN '①' ELSE '' END || o_orderpriority, '^[①②③④⑤⑥⑦⑧⑨⑩]|^\([0-9]+\)|^[0-9]+\.|^[0-9]+\)')) AS numbered FROM {orders} GROUP BY 1")
def _(t: Tables):
    text = F.concat(F.when(F.col("o_orderkey") % 4 == 0, "①").otherwise(""), F.col("o_orderpriority"))
    return t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if(T.starts_numbered(text)).alias("numbered"))


@query("str11_file_names", r"""SELECT page_id, regexp_extract(url, '[^/]*$') AS name, regexp_replace(regexp_extract(url, '[^/]*$'), '(.)\.[^.]*$', '\1') AS stem, lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') AS padded FROM {pages}""")
def _(t: Tables):
    url = F.col("url")
    return t("pages").select("page_id", T.file_name(url).alias("name"), T.file_stem(url).alias("stem"), T.zero_padded(F.col("page_id") % 1000).alias("padded"))


@query("str12_chunk_ids", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey || '_text' ELSE o_orderkey || '_text_chunk' || (o_orderkey % 4) END AS last_id FROM {orders}")
def _(t: Tables):
    chunks = F.array_repeat(F.lit("c"), F.greatest(F.lit(1), (F.col("o_orderkey") % 4).cast("int")))
    ids = T.chunk_ids(F.concat(F.col("o_orderkey").cast("string"), F.lit("_text")), chunks)
    return t("orders").select("o_orderkey", F.element_at(ids, -1).alias("last_id"))


@query("str14_path_segments", r"SELECT page_id, string_split(url, '/')[4] AS first_segment, string_split(url, '/')[-2] AS folder FROM {pages}")
def _(t: Tables):
    parts = F.split("url", "/")
    return t("pages").select("page_id", F.get(parts, F.lit(3)).alias("first_segment"), T.folder_of(F.col("url")).alias("folder"))


@query("str15_prompts", "SELECT conv_id, turn, length('<|im_start|>system' || chr(10) || 'Read.' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)) AS n FROM {conversations}")
def _(t: Tables):
    return t("conversations").select("conv_id", "turn", F.length(T.chat_prompt("Read.", F.col("text"))).cast("long").alias("n"))


@query("str16_stop_strings", """SELECT doc_id, CASE WHEN strpos(text, 'qu') > 0 THEN 'qu' WHEN strpos(text, 'th') > 0 THEN 'th' WHEN strpos(text, 'en') > 0 THEN 'en' END AS stop,
CASE WHEN strpos(text, 'qu') > 0 THEN strpos(text, 'qu') - 1 WHEN strpos(text, 'th') > 0 THEN strpos(text, 'th') - 1 WHEN strpos(text, 'en') > 0 THEN strpos(text, 'en') - 1 ELSE length(text) END AS n FROM {documents}""")
def _(t: Tables):
    return t("documents").select("doc_id", T.stop_at(F.col("text"), ["qu", "th", "en"]).alias("s")).select("doc_id", "s.stop", F.length("s.text").cast("long").alias("n"))


@query("str17_reasoning", """SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN text ELSE role END AS reasoning, CASE WHEN turn % 3 = 0 THEN text END AS content FROM {conversations}""")
def _(t: Tables):
    turn, text = F.col("turn") % 3, F.col("text")
    output = F.when(turn == 0, F.concat(F.lit("<think>"), "role", F.lit("</think>"), text)).when(turn == 1, F.concat("role", F.lit("</think>"))).otherwise(text)
    return t("conversations").select("conv_id", "turn", T.REASONING_PARSERS["think_tags"](output).alias("r")).select("conv_id", "turn", "r.reasoning", "r.content")


@query("str18_tool_calls", """SELECT conv_id, turn, turn % 3 = 0 AS called, CASE WHEN turn % 3 = 0 THEN 'look' END AS name, CASE WHEN turn % 3 = 0 THEN '{{"id":' || conv_id || '}}' END AS arguments FROM {conversations}""".replace("{{", "{ ").replace("}}", " }").replace("{ ", "{").replace(" }", "}"))
def _(t: Tables):
    turn = F.col("turn") % 3
    call = F.concat(F.lit('<tool_call>\n{"name": "look", "arguments": {"id":'), F.col("conv_id").cast("string"), F.lit("}}\n</tool_call>"))
    output = F.when(turn == 0, F.concat("role", call)).when(turn == 1, F.concat(call, F.lit("<tool_call>{broken</tool_call>"))).otherwise(F.col("role"))
    rows = t("conversations").select("conv_id", "turn", T.TOOL_PARSERS["call_tags"](output).alias("r"))
    return rows.select("conv_id", "turn", "r.called", F.get("r.calls", F.lit(0))["name"].alias("name"), F.get("r.calls", F.lit(0))["arguments"].alias("arguments"))


@query("str20_word_count_ascii", r"SELECT doc_id, length(text) - length(replace(text, ' ', '')) + 1 AS words, strlen(text) = length(text) AS is_ascii FROM {documents}")
def _(t: Tables):
    return t("documents").select("doc_id", T.spaces_word_count(F.col("text")).cast("long").alias("words"), T.is_ascii(F.col("text")).alias("is_ascii"))


@query("flt19_last_number", r"SELECT page_id, TRY_CAST(list_extract(regexp_extract_all(replace(url, ',', ''), '\d+'), -1) AS BIGINT) AS answer FROM {pages}")
def _(t: Tables):
    return t("pages").select("page_id", T.last_number(F.col("url")).alias("answer"))


@query("flt1_router", """WITH f AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PNG' WHEN 2 THEN '.wav' WHEN 3 THEN '.x' WHEN 4 THEN '' ELSE '.tif' END AS ext,
CASE o_orderkey % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'audio/mpeg' WHEN 2 THEN 'application/pdf' ELSE NULL END AS mime FROM {orders}),
k AS (SELECT CASE WHEN lower(ext) = '.pdf' OR mime = 'application/pdf' THEN 'pdf' WHEN lower(ext) IN ('.png', '.tif') OR mime LIKE 'image/%' THEN 'image' WHEN lower(ext) = '.wav' OR mime LIKE 'audio/%' THEN 'audio' ELSE 'unsupported' END AS kind FROM f)
SELECT kind, count(*) AS n FROM k GROUP BY kind""")
def _(t: Tables):
    k, m = F.col("o_orderkey") % 6, F.col("o_orderkey") % 5
    ext = F.when(k == 0, ".pdf").when(k == 1, ".PNG").when(k == 2, ".wav").when(k == 3, ".x").when(k == 4, "").otherwise(".tif")
    mime = F.when(m == 0, "image/png").when(m == 1, "audio/mpeg").when(m == 2, "application/pdf")
    return t("orders").select(D.route(ext, mime).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("ag5_run_statistics", """SELECT count(*) AS total, count(*) FILTER (WHERE k = 0) AS pdf, count(*) FILTER (WHERE k = 1) AS image, count(*) FILTER (WHERE k = 2) AS audio, count(*) FILTER (WHERE k = 3) AS other,
count(*) FILTER (WHERE o_orderstatus = 'F') AS failed FROM (SELECT o_orderkey % 4 AS k, o_orderstatus FROM {orders})""")
def _(t: Tables):
    kind = F.element_at(F.array(F.lit("pdf"), F.lit("image"), F.lit("audio"), F.lit("other")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return D.run_statistics(t("orders").withColumn("kind", kind).withColumn("failed", F.col("o_orderstatus") == "F"))


@query("flt6_valid_pages", r"SELECT count(*) AS n, sum(CAST(p AS BIGINT)) AS total FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN '001-003' ELSE CAST(o_orderkey % 9 AS VARCHAR) END AS p FROM {orders}) WHERE regexp_matches(p, '^\d+$') AND TRY_CAST(p AS BIGINT) > 0")
def _(t: Tables):
    k = F.col("o_orderkey")
    p = F.when(k % 4 == 0, "none").when(k % 4 == 1, "001-003").otherwise((k % 9).cast("string"))
    return D.valid_pages(t("orders").select(p.alias("page_num"))).agg(F.count("*").alias("n"), F.sum(F.col("page_num").try_cast("bigint")).alias("total"))


_TOC = "SELECT l_orderkey AS doc, CAST(l_linenumber * 2 AS INT) AS page, CAST(l_partkey % 3 + 1 AS INT) AS level FROM {lineitem}"
#: Returned lines and accepted ones are entries; documents without such lines have no table of contents.
_SOME_TOC = _TOC + " WHERE l_returnflag <> 'N'"
_TOC_PAGES = "SELECT l_orderkey AS doc, CAST(l_linenumber AS INT) AS page FROM {lineitem} UNION SELECT l_orderkey AS doc, CAST(l_linenumber + 3 AS INT) AS page FROM {lineitem}"


@query("flt9_toc_pages", f"""WITH toc AS ({_SOME_TOC}), p AS ({_TOC_PAGES}), m AS (SELECT doc, page, min(level) AS level FROM toc GROUP BY ALL),
d AS (SELECT doc, max(level) >= 2 AS deep FROM toc GROUP BY doc),
f AS (SELECT p.doc, p.page, coalesce(deep, false) AS deep, last_value(level IGNORE NULLS) OVER (PARTITION BY p.doc ORDER BY p.page ROWS UNBOUNDED PRECEDING) AS level FROM p LEFT JOIN m USING (doc, page) LEFT JOIN d USING (doc))
SELECT doc, count(*) AS n, sum(page) AS pages FROM f WHERE NOT deep OR coalesce(level <> 1, true) GROUP BY doc""")
def _(t: Tables):
    return D.toc_pages(t.sql(_TOC_PAGES), t.sql(_SOME_TOC)).groupBy("doc").agg(F.count("*").alias("n"), F.sum("page").alias("pages"))


@query("ag3_level_histogram", f"SELECT level, count(*) AS n FROM ({_TOC}) GROUP BY level")
def _(t: Tables):
    return D.level_histogram(t.sql(_TOC))


@query("ag4_min_level", f"SELECT page, count(*) AS docs, sum(level) AS levels FROM (SELECT doc, page, min(level) AS level FROM ({_TOC}) GROUP BY ALL) GROUP BY page")
def _(t: Tables):
    return t.sql(_TOC).groupBy("doc", "page").agg(F.min("level").alias("level")).groupBy("page").agg(F.count("*").alias("docs"), F.sum("level").alias("levels"))


@query("ag6_page_range", """SELECT l_orderkey AS doc, CASE WHEN min(l_linenumber) = max(l_linenumber) THEN lpad(CAST(min(l_linenumber) AS VARCHAR), 3, '0')
ELSE lpad(CAST(min(l_linenumber) AS VARCHAR), 3, '0') || '-' || lpad(CAST(max(l_linenumber) AS VARCHAR), 3, '0') END AS page_range FROM {lineitem} GROUP BY 1""")
def _(t: Tables):
    return D.page_range(t("lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page")), "doc", "page")


@query("ag7_ordered_concat", "SELECT conv_id, md5(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn, text)) AS digest FROM {conversations} GROUP BY conv_id")
def _(t: Tables):
    rows = t("conversations").withColumn("line", F.concat("role", F.lit(": "), "text"))
    return D.joined_text(rows, "conv_id", ["turn", "text"], "line", "\n\n").select("conv_id", F.md5("text").alias("digest"))


@query("ag1_group_to_list", "SELECT lang, source, count(*) AS n, md5(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)) AS ids FROM {documents} GROUP BY lang, source")
def _(t: Tables):
    out = D.collected(t("documents"), ["lang", "source"], ["doc_id"], "doc_id", "ids")
    return out.select("lang", "source", F.size("ids").cast("long").alias("n"), F.md5(F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")).alias("ids"))


@query("flt10_resume", "SELECT source, count(*) AS n FROM {documents} d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source")
def _(t: Tables):
    return D.unprocessed(t("documents").select("doc_id", "source"), t("labels"), "doc_id").groupBy("source").agg(F.count("*").alias("n"))


@query("flt11_high_water", """WITH o AS (SELECT l_orderkey AS doc, CASE WHEN l_partkey % 4 = 0 THEN 'cover' ELSE CAST(l_linenumber AS VARCHAR) END AS name FROM {lineitem} WHERE l_partkey % 2 = 0),
m AS (SELECT doc, max(TRY_CAST(name AS INT)) AS mark FROM o GROUP BY doc)
SELECT l_linenumber AS page, count(*) AS n FROM {lineitem} LEFT JOIN m ON doc = l_orderkey WHERE l_linenumber > coalesce(mark, 0) GROUP BY 1""")
def _(t: Tables):
    rows = t("lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), "l_partkey")
    done = rows.filter("l_partkey % 2 = 0").select("doc", F.when(F.col("l_partkey") % 4 == 0, "cover").otherwise(F.col("page").cast("string")).alias("name"))
    return D.beyond_high_water(rows, done).groupBy("page").agg(F.count("*").alias("n"))


@query("jn4_page_slice", "SELECT doc_id, 'body ' || doc_id || ' 2' AS second, 'body ' || doc_id || ' 4' AS eighth, NULL::VARCHAR AS seventh FROM {documents}")
def _(t: Tables):
    pages = [(1, 1), (2, 2), (3, 3), (4, 8), (5, 10)]
    md = F.concat(*[F.concat(F.lit(f"## 페이지 {p}\n\nbody "), F.col("doc_id").cast("string"), F.lit(f" {i}\n\n---\n\n")) for i, p in pages])
    return t("documents").select("doc_id", *[D.page_slice(md, F.lit(p)).alias(n) for p, n in ((2, "second"), (8, "eighth"), (7, "seventh"))])


@query("jn3_ocr_page_lookup", "SELECT doc_id, lpad(CAST(p AS VARCHAR), 3, '0') AS page, CASE WHEN p <> 2 THEN 'text ' || doc_id || ' ' || p END AS text FROM {documents}, (SELECT unnest([1, 2, 3]) AS p)")
def _(t: Tables):
    body = F.concat(*[F.concat(F.lit(f"###00{p}.png\n"), F.concat(F.lit("text "), F.col("doc_id").cast("string"), F.lit(f" {p}")) if p != 2 else F.lit(""), F.lit("\n\n")) for p in (1, 2, 3)])
    return D.ocr_pages(t("documents").select(F.col("doc_id").alias("doc"), body.alias("text"))).withColumnRenamed("doc", "doc_id")


@query("src10_markdown_lookup", """WITH r AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'f' || (o_orderkey % 17) ELSE '' END AS title, 'layout_f' || (o_orderkey % 13) || '_001' AS file_name, '/d/f' || (o_orderkey % 11) || '/x.json' AS file_path FROM {orders}),
n AS (SELECT DISTINCT 'f' || (c_custkey % 9) AS name FROM {customer}),
c AS (SELECT id, 1 AS p, title AS name FROM r UNION ALL SELECT id, 2, string_split(file_path, '/')[-2] FROM r UNION ALL SELECT id, 3, regexp_replace(file_name, '_\\d+(_\\d+)?$', '') FROM r UNION ALL SELECT id, 4, replace(regexp_replace(file_name, '_\\d+(_\\d+)?$', ''), 'layout_', '') FROM r)
SELECT r.id, min_by(c.name, p) AS markdown FROM r LEFT JOIN (SELECT c.* FROM c JOIN n ON n.name = c.name) c ON r.id = c.id GROUP BY r.id""".replace("\\\\", "\\"))
def _(t: Tables):
    k = F.col("o_orderkey")
    records = t("orders").select(
        k.alias("id"),
        F.when(k % 3 == 0, F.concat(F.lit("f"), (k % 17).cast("string"))).otherwise("").alias("title"),
        F.concat(F.lit("layout_f"), (k % 13).cast("string"), F.lit("_001")).alias("file_name"),
        F.concat(F.lit("/d/f"), (k % 11).cast("string"), F.lit("/x.json")).alias("file_path"),
    )
    files = t("customer").select(F.concat(F.lit("f"), (F.col("c_custkey") % 9).cast("string")).alias("name"))
    return D.markdown_candidates(records, files)


@query("src15_metadata_merge", """SELECT source AS parent, coalesce(min_by(lang, doc_id) FILTER (WHERE doc_id % 3 = 0), source) AS title, count(*) AS n, md5(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id)) AS files FROM {documents} GROUP BY source""")
def _(t: Tables):
    rows = t("documents").select(F.col("source").alias("parent"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("title"), F.col("doc_id").cast("string").alias("file_name"))
    return D.merged_metadata(rows).select("parent", "title", "n", F.md5(F.array_join("file_names", ",")).alias("files"))


@query("src13_combined_ocr", "SELECT source, md5(string_agg('###' || doc_id || '.png' || chr(10) || text, chr(10) || chr(10) ORDER BY doc_id)) AS digest FROM {documents} GROUP BY source")
def _(t: Tables):
    rows = t("documents").select("source", F.col("doc_id").alias("pos"), F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("image_name"), F.col("text").alias("markdown_text"))
    line = F.concat(F.lit("###"), F.col("image_name"), F.lit("\n"), F.col("markdown_text"))
    return D.joined_text(rows.withColumn("line", line), "source", ["pos"], "line", "\n\n").select("source", F.md5("text").alias("digest"))


@query("src4_expired_backups", "SELECT count(*) AS n FROM {orders} WHERE o_orderdate < TIMESTAMP '1997-01-01' - INTERVAL 90 DAY AND o_orderkey % 2 = 0")
def _(t: Tables):
    name = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("a.json."), F.date_format("o_orderdate", "yyyyMMddHHmmss"), F.lit(".bak"))).otherwise("a.json")
    return D.expired_backups(t("orders").select(name.alias("name")), F.lit("1997-01-01").cast("timestamp")).agg(F.count("*").alias("n"))


@query("mth8_date_stamps", "SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(o_orderdate, '%Y%m%d%H%M%S') AS compact FROM {orders}")
def _(t: Tables):
    from sparkloom.functions.geometry import stamps

    return t("orders").select("o_orderkey", stamps(F.col("o_orderdate")).alias("s")).select("o_orderkey", "s.*")


@query("jsn1_tolerant_json", """SELECT conv_id, turn, CASE WHEN turn % 4 IN (0, 1) THEN 'en' ELSE 'ko' END AS primary_language, CASE turn % 4 WHEN 0 THEN 'hi ' || conv_id WHEN 2 THEN 'only ' || conv_id ELSE 'JSON 파싱 실패' END AS natural_text, CASE WHEN turn % 4 = 0 THEN 90 ELSE 0 END AS rotation_correction FROM {conversations}""")
def _(t: Tables):
    k, c = F.col("turn") % 4, F.col("conv_id").cast("string")
    raw = (
        F.when(k == 0, F.concat(F.lit('{"primary_language":"en","rotation_correction":90,"natural_text":"hi '), c, F.lit('"}')))
        .when(k == 1, F.concat(F.lit('{"primary_language":"en","natural_text":"cut '), c))
        .when(k == 2, F.concat(F.lit('page: "natural_text": "only '), c, F.lit('" end')))
        .otherwise("garbage")
    )
    return t("conversations").select("conv_id", "turn", R.tolerant_page(raw).alias("p")).select("conv_id", "turn", "p.primary_language", "p.natural_text", "p.rotation_correction")


@query("jsn3_page_markdown", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<table></table>' || chr(10) || chr(10) ELSE '' END || text AS markdown FROM {documents}")
def _(t: Tables):
    page = F.struct((F.col("doc_id") % 2 == 0).alias("is_table"), F.lit("m").alias("table_matrix"), F.col("text").alias("natural_text"))
    return t("documents").select("doc_id", R.page_markdown(page, F.lit("<table></table>")).alias("markdown"))


@query("jsn8_embedded_metadata", """SELECT o_orderkey, '<!--METADATA:{"source_type": "audio", "audio_filename": "' || o_orderpriority || '", "id": ' || o_orderkey || '}-->' AS header FROM {orders}""")
def _(t: Tables):
    return t("orders").select("o_orderkey", R.embedded_metadata(source_type=F.lit("audio"), audio_filename=F.col("o_orderpriority"), id=F.col("o_orderkey")).alias("header"))


@query("jsn14_status_sets", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM {events} GROUP BY user_id")
def _(t: Tables):
    return t("events").groupBy("user_id").agg(F.collect_list("event_type").alias("e")).select("user_id", F.array_join(R.as_set(F.col("e")), ",").alias("types"))


@query("wn8_forward_fill", "SELECT l_orderkey, l_linenumber, last_value(CASE WHEN l_partkey % 3 = 0 THEN l_suppkey END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING) AS filled FROM {lines}")
def _(t: Tables):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rowsBetween(Window.unboundedPreceding, 0)
    value = F.when(F.col("l_partkey") % 3 == 0, F.col("l_suppkey"))
    return t("lines").select("l_orderkey", "l_linenumber", F.last(value, ignorenulls=True).over(w).alias("filled"))


@query("set3_union_parts", "SELECT parent, count(*) AS n FROM (SELECT 'orders' AS parent FROM {orders} UNION ALL SELECT 'customer' FROM {customer}) GROUP BY parent")
def _(t: Tables):
    parts = [t(n).select(F.lit(n).alias("parent"), F.lit("x").alias("_source_path")) for n in ("orders", "customer")]
    return D.last_word_wins_union(parts).groupBy("parent").agg(F.count("*").alias("n"))


@query("set4_distinct", "SELECT lang, count(*) AS n FROM (SELECT DISTINCT lang, text FROM {documents}) GROUP BY lang")
def _(t: Tables):
    # a digest stands for the text in the shuffle
    return t("documents").select("lang", F.sha2("text", 256).alias("d")).distinct().groupBy("lang").agg(F.count("*").alias("n"))


@query("set5_except", "SELECT c_nationkey, count(*) AS n FROM {customer} WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY 1")
def _(t: Tables):
    return t("customer").join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query("set8_content_digest", "SELECT sha256(source || chr(0) || text) AS digest, count(*) AS n, min(doc_id) AS first FROM {documents} GROUP BY 1")
def _(t: Tables):
    from sparkloom.operators.scheduling import content_keys

    rows = t("documents").select("doc_id", F.col("source").alias("key"), F.encode("text", "utf-8").alias("content"))
    return content_keys(rows).groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
