"""Text scalars: sentences, chunks, page markers, file names, prompts, model-output parsers.

White space is Unicode white space (``strip``), lengths are code points, arrays keep order.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions import calls


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not wherever it occurs."""
    return F.transform(F.array(value), body)[0]


EDGES = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, EDGES, "")


def sentences(text: Column) -> Column:
    """Split after . ! or ? that white space follows."""
    return F.split(text, r"(?U)(?<=[.!?])\s+", -1)


def dedup_sentences(text: Column) -> Column:
    """The first of equal sentences stays; the rest are joined by a space."""
    return F.array_join(F.array_distinct(F.filter(F.transform(sentences(text), strip), lambda s: s != "")), " ")


def remove_page_markers(markdown: Column) -> Column:
    """Page rules and page headings go, blank runs shrink to one empty line."""
    # The markers, in the order in which they are removed.
    out = F.regexp_replace(markdown, r"\n---\n", "\n")
    out = F.regexp_replace(out, r"(?U)## 페이지 \d+", "")
    out = F.regexp_replace(out, r"### 페이지.*?\n", "")
    out = F.regexp_replace(out, r"(?U)\n\s*\n\s*\n", "\n\n")
    return strip(out)


def split_chunks(text: Column, most: int = 3000) -> Column:
    """Paragraphs packed into chunks of at most ``most`` characters; longer paragraphs are packed by sentence.

    A single sentence longer than ``most`` stays whole. Joining costs 4 characters of room for a paragraph, 2 for a sentence.
    """
    piece = "array<struct<text:string,sep:string,room:int>>"

    def pieces(p: Column) -> Column:
        short = F.array(F.struct(p.alias("text"), F.lit("\n\n").alias("sep"), F.lit(4).alias("room")))
        long = F.transform(sentences(p), lambda s: F.struct(s.alias("text"), F.lit(" ").alias("sep"), F.lit(2).alias("room")))
        return F.when(F.length(p) > most, long.cast(piece)).otherwise(short.cast(piece))

    # the fold carries places only: where the open chunk began, its length, and the ends of those before it
    bounds = "array<struct<first:int,last:int>>"
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("first"), F.lit(0).alias("open"), F.array().cast(bounds).alias("done"))

    def closed(acc: Column) -> Column:
        whole = F.array(F.struct(acc["first"].alias("first"), (acc["at"] - 1).alias("last")))
        return F.when(acc["open"] > 0, F.concat(acc["done"], whole)).otherwise(acc["done"])

    def add(acc: Column, x: Column) -> Column:
        fits = acc["open"] + x["n"] + x["room"] <= most
        joins = fits & (acc["open"] > 0)
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(joins, acc["first"]).otherwise(acc["at"]).alias("first"),
            F.when(joins, acc["open"] + x["sep"] + x["n"]).otherwise(x["n"]).alias("open"),
            F.when(fits, acc["done"]).otherwise(closed(acc)).alias("done"),
        )

    def cut(all_: Column) -> Column:
        sizes = F.transform(all_, lambda p: F.struct(F.length(p["text"]).alias("n"), F.length(p["sep"]).alias("sep"), p["room"].alias("room")))
        text_of = lambda own: F.array_join(F.transform(own, lambda p, i: F.when(i == 0, p["text"]).otherwise(F.concat(p["sep"], p["text"]))), "")
        return F.transform(F.aggregate(sizes, start, add, closed), lambda b: strip(text_of(F.slice(all_, b["first"] + 1, b["last"] - b["first"] + 1))))

    def whole(value: Column) -> Column:
        packed = let(F.flatten(F.transform(F.split(value, "\n\n", -1), pieces)), cut)
        return F.when(F.coalesce(value, F.lit("")) == "", F.array().cast("array<string>")).when(F.length(value) <= most, F.array(value)).otherwise(packed)

    return let(text, whole)


def gated_chunks(text: Column, most: int = 2000) -> Column:
    """One chunk up to ``most`` characters, packed chunks beyond."""
    return split_chunks(text, most)


def parse_chunk_response(response: Column) -> Column:
    """Chunks of a model's answer that numbers them (``청크 N:``); empty ones are dropped."""
    found = F.regexp_extract_all(response, F.lit(r"(?U)청크 \d+:\s*\n([\s\S]*?)(?=\n\s*청크 \d+:|$)"), F.lit(1))
    return F.filter(F.transform(found, strip), lambda c: c != "")


def remove_thinking(answer: Column) -> Column:
    """Without closed <think> spans and an unclosed one to the end."""
    return strip(F.regexp_replace(F.regexp_replace(answer, r"(?s)<think>.*?</think>", ""), r"(?s)<think>.*$", ""))


def keywords(answer: Column, most: int = 5) -> Column:
    """Distinct keywords in order, at most ``most``."""
    parts = F.filter(F.transform(F.split(answer, "[,，、]", -1), strip), lambda k: k != "")
    return F.slice(F.array_distinct(parts), 1, most)


def layout_page(name: Column) -> Column:
    """Page number after ``layout_``, 0 if there is none."""
    return F.coalesce(F.regexp_extract(name, r"layout_(\d+)", 1).try_cast("int"), F.lit(0))


def three_digit_page(name: Column) -> Column:
    """Three digits after an underscore, '000' if there are none."""
    found = F.regexp_extract(name, r"_([0-9]{3})_?", 1)
    return F.when(found == "", "000").otherwise(found)


def three_digit_page_or_null(name: Column) -> Column:
    found = F.regexp_extract(name, r"_([0-9]{3})_?", 1)
    return F.when(found != "", found)


def starts_numbered(text: Column) -> Column:
    """Whether a text starts like a numbered item."""
    return text.rlike(r"^[①-⑩]|^\([0-9]+\)|^[0-9]+\.|^[0-9]+\)")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """Lower-cased suffix with its dot, empty if there is none."""
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]*)$", 1))


def zero_padded(number: Column, width: int = 3) -> Column:
    text = number.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def folder_of(path: Column) -> Column:
    """Name of the folder that holds a file."""
    return F.coalesce(F.get(F.reverse(F.split(path, "/")), F.lit(1)), F.lit(""))


def segment_after(path: Column, marker: str) -> Column:
    """The path segment that follows ``marker``, null if there is none."""
    parts = F.split(path, "/")
    at = F.array_position(parts, marker).cast("int")
    return F.when(at > 0, F.get(parts, at))


def chunk_ids(base: Column, chunks: Column) -> Column:
    """Identifiers of chunks: the base id for one chunk, numbered from 1 for more."""
    stem = F.split(base, "_")[0]
    return F.when(F.size(chunks) > 1, F.transform(chunks, lambda c, i: F.concat(stem, F.lit("_text_chunk"), (i + 1).cast("string")))).otherwise(F.transform(chunks, lambda c: base))


def markdown_block(label: Column, text: Column) -> Column:
    """Titles in bold, all followed by an empty line."""
    return F.when(label == "paragraph_title", F.concat(F.lit("**"), text, F.lit("**\n\n"))).otherwise(F.concat(text, F.lit("\n\n")))


def chat_prompt(system: Column | str, user: Column) -> Column:
    """A prompt of a system and a user part in the usual chat markup."""
    system = F.lit(system) if isinstance(system, str) else system
    return F.concat(F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n<|im_start|>user\n"), user, F.lit("<|im_end|>\n<|im_start|>assistant\n"))


def stop_at(text: Column, stops: list[str], include: bool = False) -> Column:
    """struct<text, stop>: the text up to the first *listed* stop string that occurs in it."""
    out = F.struct(text.alias("text"), F.lit(None).cast("string").alias("stop"))
    for stop in reversed(stops):
        if not stop:
            continue
        at = F.instr(text, stop)
        end = at - 1 + (len(stop) if include else 0)
        out = F.when(at > 0, F.struct(F.left(text, end.cast("int")).alias("text"), F.lit(stop).alias("stop"))).otherwise(out)
    return out


def split_reasoning(output: Column, start: str = "<think>", end: str = "</think>") -> Column:
    """struct<reasoning, content>. Without the end mark all is reasoning; empty content is null."""
    body = F.when(F.instr(output, start) > 0, F.substr(output, F.instr(output, start) + len(start))).otherwise(output)
    at = F.instr(body, end)
    content = F.substr(body, at + len(end))
    return F.struct(
        F.when(at > 0, F.left(body, at - 1)).otherwise(body).alias("reasoning"),
        F.when((at > 0) & (content != ""), content).alias("content"),
    )


def reasoning_between(output: Column, start: str = "<think>", end: str = "</think>") -> Column:
    """struct<reasoning, content> where both marks are there, otherwise all is content. Text before the start goes."""
    body = F.substr(output, F.instr(output, start) + len(start))
    at = F.instr(body, end)
    content = F.substr(body, at + len(end))
    both = (F.instr(output, start) > 0) & (F.instr(output, end) > 0)
    reasoning = F.when(at > 0, F.left(body, at - 1)).otherwise(body)
    return F.struct(F.when(both, reasoning).alias("reasoning"), F.when(~both, output).when((at > 0) & (content != ""), content).alias("content"))


def is_one_json_value(text: Column) -> Column:
    """Whether a text is one JSON value with nothing behind it, which Spark's JSON functions do not ask for: as the only item of a list it
    makes one, and one more item makes two."""
    alone, more = (F.json_array_length(F.concat(F.lit("["), text, F.lit(end))) for end in ("]", ",0]"))
    return F.coalesce((alone == 1) & (more == 2), F.lit(False))


CALL = "struct<name:string,arguments:string>"


def tagged_tool_calls(output: Column, start: str = "<tool_call>", end: str = "</tool_call>") -> Column:
    """struct<called, calls, content>: JSON calls between tags (plain text), the last of which may lack its end. Each piece must be one
    JSON object with ``name`` and ``arguments``, of which the arguments may be null; otherwise the whole output is plain content."""
    first, last = re.escape(start), re.escape(end)
    raw = F.transform(F.regexp_extract_all(output, F.lit(f"(?s){first}.*?{last}|{first}.*"), F.lit(0)), lambda m: strip(F.regexp_replace(m, f"^{first}|{last}$", "")))
    name = F.transform(raw, lambda c: F.get_json_object(c, "$.name"))
    arguments = F.transform(raw, lambda c: F.coalesce(F.get_json_object(c, "$.arguments"), F.lit("null")))
    whole = F.forall(raw, lambda c: is_one_json_value(c) & F.coalesce(F.array_contains(F.json_object_keys(c), "arguments"), F.lit(False)))
    good = (F.size(raw) > 0) & whole & F.forall(name, lambda n: n.isNotNull())
    made = F.zip_with(name, arguments, lambda n, a: F.struct(n.alias("name"), a.alias("arguments")).cast(CALL))
    before = F.substring_index(output, start, 1)
    return F.struct(
        good.alias("called"),
        F.when(good, made).otherwise(F.array().cast(f"array<{CALL}>")).alias("calls"),
        F.when(good, F.when(before != "", before)).otherwise(output).alias("content"),
    )


def bare_json_tool_calls(output: Column) -> Column:
    """The same for outputs that are a JSON array or object of calls with nothing around."""
    text = strip(output)
    one = F.from_json(text, "name string, arguments string, parameters string")
    many = F.from_json(text, "array<struct<name:string,arguments:string,parameters:string>>")
    listed = F.when(text.startswith("["), many).when(text.startswith("{"), F.array(one))
    made = F.transform(listed, lambda c: F.struct(c["name"].alias("name"), F.coalesce(c["arguments"], c["parameters"]).alias("arguments")).cast(CALL))
    good = F.coalesce((F.size(made) > 0) & F.forall(made, lambda c: c["name"].isNotNull() & c["arguments"].isNotNull()), F.lit(False))
    return F.struct(good.alias("called"), F.when(good, made).otherwise(F.array().cast(f"array<{CALL}>")).alias("calls"), F.when(~good, output).alias("content"))


#: Parsers of model output by name; ``register_parser`` adds more. Those of nested forms tell in ``finished`` whether the output was whole.
TOOL_PARSERS: dict[str, Callable[[Column], Column]] = {
    "call_tags": tagged_tool_calls,
    "bare_json": bare_json_tool_calls,
    "bracketed": lambda c: calls.parsed(c, calls.bracket_list),
    "bracketed_names": lambda c: calls.parsed(c, calls.bracket_list, named=True),
    "bracket_pairs": lambda c: tagged_tool_calls(c, "[TOOL_CALLS]", "[/TOOL_CALLS]"),
    "call_expressions": lambda c: calls.parsed(c, calls.call_expressions),
    "parameter_tags": lambda c: calls.parsed(c, calls.parameter_tags),
    "argument_pairs": lambda c: calls.parsed(c, calls.argument_pairs),
    "call_list": lambda c: calls.parsed(c, calls.bracket_list, tag="<|tool_call|>"),
    "function_list": lambda c: calls.parsed(c, calls.bracket_list, tag="functools"),
    **{f"{form}_section": lambda c, form=form: calls.parsed(c, calls.marked_section, form=form) for form in calls.SECTIONS},
}
REASONING_PARSERS: dict[str, Callable[[Column], Column]] = {
    "think_tags": split_reasoning,
    "upper_think_tags": lambda c: split_reasoning(c, "[THINK]", "[/THINK]"),
    "both_think_tags": reasoning_between,
    "response_heading": lambda c: split_reasoning(c, "Here is my thought process:", "Here is my response:"),
}


def register_parser(kind: str, name: str, parser: Callable[[Column], Column]) -> None:
    {"tool": TOOL_PARSERS, "reasoning": REASONING_PARSERS}[kind][name] = parser


def spaces_word_count(text: Column) -> Column:
    """Spaces plus one."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def is_ascii(text: Column) -> Column:
    return text.rlike(r"^\p{ASCII}*$")


def has_only_non_ascii_messages(messages: Column) -> Column:
    """Whether every message has a non-ASCII character: what the observed conversation filter keeps."""
    return F.forall(messages, lambda m: ~is_ascii(m))


def last_number(text: Column) -> Column:
    """The last run of digits after commas are dropped, null if there is none or it is no number."""
    found = F.regexp_extract_all(F.regexp_replace(text, ",", ""), F.lit(r"\d+"), F.lit(0))
    return F.try_element_at(found, F.lit(-1)).try_cast("bigint")
