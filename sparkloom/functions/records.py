"""JSON, map and struct scalars of model responses and metadata records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.text import strip

# Defaults of a page response.
FAILED = "JSON 파싱 실패"
PAGE_DEFAULTS = {"primary_language": "ko", "is_rotation_valid": True, "rotation_correction": 0, "is_table": False, "is_diagram": False, "natural_text": FAILED}
PAGE_SCHEMA = "primary_language string, is_rotation_valid boolean, rotation_correction int, is_table boolean, is_diagram boolean, natural_text string, table_matrix string"


# Escapes that are broken, and the natural text alone in an answer that is no JSON.
BROKEN_ESCAPES = (r"\\u[^0-9a-fA-F]", r"\\u[0-9a-fA-F]{0,3}(?![0-9a-fA-F])")
LONE_TEXT = r'(?s)"natural_text"\s*:\s*"([^"]*(?:\\.[^"]*)*)"'


def repaired_json(raw: Column) -> Column:
    """Broken unicode escapes go; an object that was cut off is closed after its last whole string value."""
    clean = raw
    for broken in BROKEN_ESCAPES:
        clean = F.regexp_replace(clean, broken, "")
    last = F.length(clean) - F.instr(F.reverse(clean), ',"')  # characters up to and with the last quote before a comma
    closed = F.when(F.instr(clean, '",') > 1, F.concat(F.left(clean, last.cast("int")), F.lit("}"))).otherwise(F.concat(clean, F.lit('"}')))
    return F.when(F.rtrim(strip(clean)).endswith("}"), clean).otherwise(closed)


def _is_object(text: Column) -> Column:
    return F.coalesce(F.try_parse_json(text).isNotNull() & strip(text).startswith("{"), F.lit(False))


def tolerant_page(raw: Column) -> Column:
    """Page response struct: strict JSON, else repaired JSON, else the natural text alone, else defaults. Missing keys get defaults."""
    fixed = repaired_json(raw)
    text = F.when(_is_object(raw), raw).when(_is_object(fixed), fixed)
    parsed = F.from_json(text, PAGE_SCHEMA)
    present = F.from_json(text, "map<string,string>")
    lone = F.regexp_extract(raw, LONE_TEXT, 1)
    found = raw.rlike(LONE_TEXT)
    unescaped = F.replace(F.replace(lone, F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))

    def field(name: str) -> Column:
        default = F.lit(PAGE_DEFAULTS[name])
        if name == "natural_text":
            default = F.when(text.isNull() & found, unescaped).otherwise(default)
        return F.when(text.isNotNull() & F.map_contains_key(present, name), parsed[name]).otherwise(default).alias(name)

    return F.struct(*[field(n) for n in PAGE_DEFAULTS], parsed["table_matrix"].alias("table_matrix"))


def without_image_tags(text: Column) -> Column:
    return strip(F.regexp_replace(text, "<image>", ""))


def page_markdown(page: Column, table_html: Column) -> Column:
    """Table first, then text, an empty line between; what is empty is left out."""
    table = F.when(page["is_table"] & (F.coalesce(page["table_matrix"], F.lit("")) != ""), table_html)
    text = F.when(page["natural_text"] != "", page["natural_text"])
    return F.concat_ws("\n\n", table, text)


def failed_page_markdown(stem: Column, error: Column) -> Column:
    return F.concat(F.lit("# "), stem, F.lit("\n\n[처리 실패: "), error, F.lit("]"))


def with_metadata_fields(record: Column, **fields: Column) -> Column:
    """A copy of a metadata record in which some fields are replaced."""
    out = record
    for name, value in fields.items():
        out = out.withField(f"metadata.{name}", value)
    return out


def embedded_metadata(**fields: Column) -> Column:
    """A metadata comment; spacing is that of a JSON writer with a space after separators."""
    parts = [F.concat(F.lit(f'"{k}": '), F.to_json(F.array(v)).substr(F.lit(2), F.length(F.to_json(F.array(v))) - 2)) for k, v in fields.items()]
    return F.concat(F.lit("<!--METADATA:{"), F.concat_ws(", ", *parts), F.lit("}-->"))


def read_embedded_metadata(text: Column, schema: str) -> Column:
    return F.from_json(F.regexp_extract(text, r"(?s)<!--METADATA:(\{.*?\})-->", 1), schema)


def merged_logprobs(sampled: Column, sampled_logprob: Column, sampled_rank: Column, top: Column) -> Column:
    """map<token, struct<logprob, rank>>: the top entries by rank, and the sampled token with its own rank."""
    entry = "struct<logprob:double,rank:int>"
    ranked = F.transform(top, lambda t, i: F.struct(t["token"].alias("key"), F.struct(t["logprob"].cast("double").alias("logprob"), (i + 1).alias("rank")).cast(entry).alias("value")))
    others = F.map_from_entries(F.filter(ranked, lambda e: e["key"] != sampled))
    own = F.create_map(sampled, F.struct(sampled_logprob.cast("double").alias("logprob"), sampled_rank.cast("int").alias("rank")).cast(entry))
    return F.map_concat(own, others)


def as_set(values: Column) -> Column:
    """Distinct values in ascending order: a status list that behaves like a set."""
    return F.array_sort(F.array_distinct(values))
