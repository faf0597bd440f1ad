"""Queries of model outputs: calls of nested forms, grammars, many patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import calls as C
from sparkloom.functions import grammar as G
from sparkloom.functions import patterns as A
from sparkloom.functions import text as T
from sparkloom.operators import adapters, passages
from sparkloom.plans.base import TOKENS_SQL, Tables, query, tokens

#: JSON in full.
JSON_GRAMMAR = r"""
root ::= ws value ws
value ::= object | array | string | number | "true" | "false" | "null"
object ::= "{" ws ( pair ( ws "," ws pair )* )? ws "}"
pair ::= string ws ":" ws value
array ::= "[" ws ( value ( ws "," ws value )* )? ws "]"
string ::= "\"" ( [^"\\\x00-\x1f] | "\\" ["\\/bfnrt] | "\\u" [0-9a-fA-F]{4} )* "\""
number ::= "-"? ( "0" | [1-9] [0-9]* ) ( "." [0-9]+ )? ( [eE] [-+]? [0-9]+ )?
ws ::= [ \t\n\r]*
"""
#: Brackets of two kinds, closed in order.
BRACKETS = r'root ::= ( [^()\[\]] | "(" root ")" | "[" root "]" )*'


def _quoted(text: Column) -> Column:
    """A text as a string literal that Python and JSON both read."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), text, F.lit('"'))


def _called(t: Tables, output: Column, parser: Column | None = None):
    """conv_id, turn, the number of calls, the first call's name and its text argument."""
    rows = t("conversations").select("conv_id", "turn", "text", (output if parser is None else parser).alias("r"))
    first = F.get("r.calls", F.lit(0))
    return rows.select("conv_id", "turn", F.size("r.calls").cast("long").alias("n"), first["name"].alias("name"), F.get_json_object(first["arguments"], "$.text").alias("text"), F.get_json_object(first["arguments"], "$.at[1].turn").cast("long").alias("again"))


_CALLED = "SELECT conv_id, turn, 2::BIGINT AS n, 'say' AS name, text, CAST(turn AS BIGINT) AS again FROM {conversations}"


@query("str19_call_expressions", _CALLED)
def _(t: Tables):
    turn = F.col("turn").cast("string")
    output = F.concat(F.lit("[say(text="), _quoted(F.col("text")), F.lit(", at=[None, {'turn': "), turn, F.lit("}]), stop()]"))
    return _called(t, T.TOOL_PARSERS["call_expressions"](output))


@query("str19_bracket_list", _CALLED)
def _(t: Tables):
    turn = F.col("turn").cast("string")
    output = F.concat(F.lit('so: [TOOL_CALLS] [{"name": "say", "arguments": {"text": '), _quoted(F.col("text")), F.lit(', "at": [null, {"turn": '), turn, F.lit('}]}}, {"name": "stop", "arguments": null}]'))
    return _called(t, T.TOOL_PARSERS["bracketed"](output))


@query("str19_argument_pairs", "SELECT conv_id, turn, 2::BIGINT AS n, 'say' AS name, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text, CAST(turn AS BIGINT) AS again FROM {conversations}")
def _(t: Tables):
    turn = F.col("turn").cast("string")
    pairs = [F.lit("<tool_call>say\n<arg_key>text</arg_key>\n<arg_value>"), F.col("text"), F.lit('</arg_value>\n<arg_key>at</arg_key><arg_value>[null, {"turn": '), turn, F.lit("}]</arg_value></tool_call><tool_call>stop\n</tool_call>")]
    return _called(t, C.parsed(F.concat(*pairs), C.argument_pairs, tools={"say": {"text": "string"}}))


@query("str19_parameter_tags", "SELECT conv_id, turn, 1::BIGINT AS n, 'say' AS name, text, CAST(turn AS BIGINT) AS again FROM {conversations}")
def _(t: Tables):
    """The output ends early; what is open ends with it."""
    turn = F.col("turn").cast("string")
    output = F.concat(F.lit("<tool_call><function=say><parameter=text>\n"), F.col("text"), F.lit("\n</parameter><parameter=at>[0, {'turn': "), turn, F.lit("}]"))
    return _called(t, C.parsed(output, C.parameter_tags, tools={"say": {"text": "string", "at": "array"}}))


@query("str19_unfinished_calls", "SELECT conv_id, turn, turn % 2 = 0 AS finished, CASE WHEN turn % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS n, CASE WHEN turn % 2 = 0 THEN text ELSE left(text, length(text) // 2) END AS text FROM {conversations}")
def _(t: Tables):
    """Every second output is cut within the string of its first call."""
    half = F.left("text", F.floor(F.length("text") / 2).cast("int"))
    whole = F.concat(F.lit('[say(text="'), F.regexp_replace(_quoted(F.col("text")), '^"|"$', ""), F.lit('"), stop()]'))
    output = F.when(F.col("turn") % 2 == 0, whole).otherwise(F.concat(F.lit('[say(text="'), F.regexp_replace(_quoted(half), '^"|"$', "")))
    rows = t("conversations").select("conv_id", "turn", C.parsed(output, C.call_expressions, partial=True).alias("r"))
    return rows.select("conv_id", "turn", "r.finished", F.size("r.calls").cast("long").alias("n"), F.get_json_object(F.get("r.calls", F.lit(0))["arguments"], "$.text").alias("text"))


@query("udf7_json_grammar", "SELECT conv_id, turn, turn % 3 <> 0 AS accepted, turn % 3 <> 0 AS whole FROM {conversations}")
def _(t: Tables):
    """Every third output lacks its last bracket: it can still become JSON, but is none."""
    output = F.to_json(F.struct("role", "text", F.array("turn", F.lit(-2.5e3)).alias("at")))
    cut = F.when(F.col("turn") % 3 == 0, F.left(output, F.length(output) - 1)).otherwise(output)
    rows = t("conversations").select("conv_id", "turn", G.recognised(cut, JSON_GRAMMAR).alias("g"), F.length(cut).alias("n"), F.length(output).alias("all"))
    return rows.filter("g.valid = n").select("conv_id", "turn", "g.accepted", (F.col("g.valid") == F.col("all")).alias("whole"))


def _without_pairs(sql: str, times: int) -> str:
    for _ in range(times):
        sql = rf"regexp_replace({sql}, '\(\)|\[\]', '', 'g')"
    return sql


@query("udf7_bracket_grammar", f"SELECT doc_id, {_without_pairs(r"regexp_replace(text, '[^()\[\]]', '', 'g')", 24)} = '' AS accepted, length(text) AS n FROM {{documents}}")
def _(t: Tables):
    """Whether the brackets of whole documents are closed in order."""
    return t("documents").select("doc_id", adapters.meets(F.col("text"), "grammar", BRACKETS).alias("accepted"), F.length("text").cast("long").alias("n"))


def _passages(t: Tables) -> DataFrame:
    """First characters of all the benchmark's texts, ranked by their items."""
    return t("benchmark").select(F.left("text", F.lit(12)).alias("pattern"), F.col("item_id").alias("rank"))


@query("str16_many_stop_strings", """WITH p AS (SELECT left(text, 12) AS s, min(item_id) AS k FROM {benchmark} WHERE length(text) > 0 GROUP BY 1),
h AS (SELECT doc_id, arg_min(s, k) AS stop FROM {documents}, p WHERE contains(text, s) GROUP BY doc_id)
SELECT doc_id, stop, CASE WHEN stop IS NULL THEN length(text) ELSE strpos(text, stop) - 1 END AS n FROM {documents} LEFT JOIN h USING (doc_id)""")
def _(t: Tables):
    rows = t("documents").select("doc_id", "text", F.length("text").alias("n"))
    return passages.first_stop(rows, "text", _passages(t)).select("doc_id", "stop", F.coalesce("at", "n").cast("long").alias("n"))


@query("str16_pattern_counts", """WITH p AS (SELECT DISTINCT left(text, 12) AS s FROM {benchmark} WHERE length(text) > 0)
SELECT s AS pattern, count(*) AS docs FROM {documents}, p WHERE contains(text, s) GROUP BY s""")
def _(t: Tables):
    return passages.texts_with(t("documents"), "text", _passages(t)).withColumnRenamed("texts", "docs")


@query("jsn11_many_bad_words", f"""WITH t AS ({TOKENS_SQL}), b AS (SELECT DISTINCT tokens[1:4] AS w FROM t WHERE len(tokens) >= 4), h AS (SELECT w[1:3] AS head, list(w[4] ORDER BY w[4]) AS masked FROM b GROUP BY 1)
SELECT doc_id, array_to_string(coalesce(masked, []), ',') AS masked FROM t LEFT JOIN h ON len(tokens) >= 3 AND head = tokens[-3:]""")
def _(t: Tables):
    """Bad words: the first four tokens of every document, of which there are at most 256."""
    words = tokens(t).filter(F.size("tokens") >= 4).select(F.slice("tokens", 1, 4).alias("w")).distinct().limit(256)
    masked = A.masked_tokens(F.col("tokens"), [list(r["w"]) for r in words.collect()])
    return tokens(t).select("doc_id", F.array_join(F.transform(masked, lambda x: x.cast("string")), ",").alias("masked"))
