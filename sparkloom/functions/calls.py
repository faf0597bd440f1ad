"""Tool calls of model output whose form is nested: call expressions, bracket lists, tagged parameters.

One scanner serves all of them. It reads values with a stack of openers, so depth costs no recursion, and knows strings and escapes.
Output that ends too early is read as far as it goes: open strings, lists and maps end there, a name without its value is left out,
and ``finished`` is false. Each parser gives struct<called, finished, calls, content> for whole columns in Arrow batches; a call is a
name and its arguments as JSON text. Output that is no call of the form is content as it stands.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.ship import ship

CALLS = "called boolean, finished boolean, calls array<struct<name:string,arguments:string>>, content string"
_TYPE = pa.struct([("called", pa.bool_()), ("finished", pa.bool_()), ("calls", pa.list_(pa.struct([("name", pa.string()), ("arguments", pa.string())]))), ("content", pa.string())])


class Malformed(ValueError):
    """Not of the form. ``content`` is what the output says then, if not all of it."""

    content: str | None = None


class Ended(Exception):
    """The text ends inside a value."""


_SPACE = re.compile(r"[ \t\r\n\f]*")
_NAME = re.compile(r"[A-Za-z]+\w*")
_KEY = re.compile(r"[^\W\d]\w*")
_WORD = re.compile(r"[A-Za-z]+")
_NUMBER = re.compile(r"0[xX][0-9a-fA-F_]+|0[oO][0-7_]+|0[bB][01_]+|(?:\d[\d_]*)?\.\d[\d_]*(?:[eE][-+]?\d+)?|\d[\d_]*\.?(?:[eE][-+]?\d+)?")
_JSON_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?")
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f", "a": "\a", "v": "\v", "\\": "\\", "'": "'", '"': '"', "/": "/", "\n": ""}
#: What a dialect calls its constants.
_PYTHON = {"True": True, "False": False, "None": None}
_JSON = {"true": True, "false": False, "null": None}


class Scanner:
    """Values of a text from a place on: Python literals (``python``; numbers without a sign unless ``signed``) or JSON. In ``partial``
    output a value may be cut off, which ``ended`` then tells; ``Ended`` is raised where nothing of it is there."""

    def __init__(self, text: str, at: int = 0, python: bool = False, partial: bool = False, signed: bool = False):
        self.text, self.at, self.python, self.partial, self.signed, self.ended = text, at, python, partial, signed, False

    def peek(self) -> str:
        """The next character that is no space, empty at the end."""
        self.at = _SPACE.match(self.text, self.at).end()
        return self.text[self.at : self.at + 1]

    def expect(self, *marks: str) -> str:
        """One of the marks, which is passed."""
        mark = self.peek()
        if not mark or self.ended:
            raise Ended
        if mark not in marks:
            raise Malformed(f"{' or '.join(marks)} expected at {self.at}")
        self.at += 1
        return mark

    def rest_is_blank(self) -> bool:
        return not self.peek()

    def _cut(self, so_far: list[str]) -> str:
        """A string that the text's end cuts off."""
        self.ended, self.at = True, len(self.text)
        if not self.partial:
            raise Ended
        return "".join(so_far)

    def _hexadecimal(self, at: int, digits: int) -> int:
        found = re.compile(rf"[0-9a-fA-F]{{{digits}}}").match(self.text, at)
        if not found:
            raise Malformed("no such escape")
        return int(found[0], 16)

    def string(self) -> str:
        """The string at a quote."""
        text, quote = self.text, self.text[self.at]
        mark = quote * 3 if self.python and text.startswith(quote * 3, self.at) else quote
        stop = re.compile(re.escape(mark) + r"|\\" + ("" if len(mark) == 3 else r"|\n" if self.python else r"|[\x00-\x1f]"))
        out, at = [], self.at + len(mark)
        while found := stop.search(text, at):
            out.append(text[at : found.start()])
            at = found.end()
            if found[0] == mark:
                self.at = at
                return "".join(out)
            if found[0] != "\\":
                raise Malformed("a string crosses a line")
            escape = text[at : at + 1]
            digits = {"u": 4, "x": 2, "U": 8}.get(escape, 0) if self.python or escape == "u" else 0
            if len(text) < at + 1 + digits:
                return self._cut(out)
            if digits:
                code = self._hexadecimal(at + 1, digits)
                at += 1 + digits
                if 0xD800 <= code < 0xDC00 and not self.python and text.startswith("\\u", at):
                    if len(text) < at + 6:
                        return self._cut(out)
                    low = self._hexadecimal(at + 2, 4)
                    if 0xDC00 <= low < 0xE000:  # a pair stands for one character
                        code, at = 0x10000 + ((code - 0xD800) << 10) + low - 0xDC00, at + 6
                if 0xD800 <= code < 0xE000 or code >= 0x110000:
                    raise Malformed("half of a pair, or no character")
                out.append(chr(code))
                continue
            if self.python and (octal := re.compile(r"[0-7]{1,3}").match(text, at)):
                out.append(chr(int(octal[0], 8)))
                at = octal.end()
                continue
            known = escape in (_ESCAPES.keys() - {"/"} if self.python else set('nrtbf\\"/'))
            if not known and not self.python:
                raise Malformed("no such escape")
            out.append(_ESCAPES[escape] if known else "\\" + escape)
            at += 1
        return self._cut([*out, text[at:]])

    def scalar(self):
        """A string, number or constant."""
        text, mark = self.text, self.peek()
        if not mark:
            raise Ended
        if mark == '"' or self.python and mark == "'":
            value = self.string()
            while self.python and not self.ended and self.peek() in {"'", '"'}:
                value += self.string()  # strings side by side are one
            return value
        words = _PYTHON if self.python else _JSON
        if word := _WORD.match(text, self.at):
            if word[0] in words:
                self.at = word.end()
                return words[word[0]]
            if word.end() == len(text) and any(w.startswith(word[0]) for w in words):
                raise Ended
            raise Malformed(f"{word[0]} is no value")
        negative = self.python and self.signed and mark == "-"
        self.at += negative
        number = (_NUMBER if self.python else _JSON_NUMBER).match(text, self.at)
        if not number:
            raise Ended if text[self.at :] in ("", "-") else Malformed(f"no value at {self.at}")
        if self.partial and number.end() == len(text):
            raise Ended  # more digits may follow
        self.at = number.end()
        if re.compile(r"\w").match(text, self.at):
            raise Malformed("a number runs into a name")
        try:
            value = int(number[0], 0) if self.python else int(number[0])
        except ValueError:
            if self.python and re.compile(r"0[\d_]*[1-9][\d_]*").fullmatch(number[0]):
                raise Malformed("a leading zero") from None
            try:
                value = float(number[0])
            except ValueError:
                raise Malformed("no number") from None
        return -value if negative else value

    def _key(self):
        key = self.scalar()
        if not self.python and not isinstance(key, str):
            raise Malformed("a key is a string")
        self.expect(":")
        return key

    def value(self):
        """A value. Open lists and maps are on a stack, each with the key whose value is next."""
        stack: list[list] = []

        def put(value) -> None:
            whole, key = stack[-1]
            whole.append(value) if isinstance(whole, list) else whole.__setitem__(key, value)

        try:
            while True:
                mark = self.peek()
                if mark and mark in "[{":
                    self.at += 1
                    stack.append([[] if mark == "[" else {}, None])
                    fresh = True
                else:
                    value, fresh = self.scalar(), False
                while stack:
                    end = "]" if isinstance(stack[-1][0], list) else "}"
                    if not fresh:
                        put(value)
                    # a comma leads to the next value; Python takes one before the end as well
                    comma = not fresh and self.expect(",", end) == ","
                    if comma or fresh:
                        closes = self.peek() == end and (fresh or self.python)
                        if not closes:
                            stack[-1][1] = self._key() if end == "}" else None
                            break
                        self.at += 1
                    value, fresh = stack.pop()[0], False
                else:
                    return value
        except Ended:
            if not self.partial or not stack:
                raise
            self.ended = True
            while len(stack) > 1:
                value = stack.pop()[0]
                put(value)
            return stack[0][0]


def literal(text: str, python: bool = False):
    """A whole text as one value, strict."""
    scan = Scanner(text, python=python, signed=python)
    try:
        value = scan.value()
    except Ended:
        raise Malformed("the text ends inside a value") from None
    if not scan.rest_is_blank():
        raise Malformed("more follows the value")
    return value


# ---------------------------------------------------------------- the forms


Calls = tuple[list[tuple[str, object]], bool, str | None]


def call_expressions(text: str, partial: bool = False, signed: bool = False) -> Calls:
    """``[name(key=value, ...), ...]``, and nothing around it: values are Python literals, all arguments have names."""
    if not text.startswith("["):
        raise Malformed("no list")
    scan, calls = Scanner(text, 1, True, partial, signed), []
    try:
        while True:
            scan.peek()
            name = _NAME.match(text, scan.at)
            if not name:
                raise Malformed("a name expected") if scan.peek() else Ended
            scan.at = name.end()
            scan.expect("(")
            arguments: dict = {}
            calls.append((name[0], arguments))
            while scan.peek() != ")":
                key = _KEY.match(text, scan.at)
                if not key:
                    raise Malformed("a name expected") if scan.peek() else Ended
                scan.at = key.end()
                scan.expect("=")
                arguments[key[0]] = scan.value()
                if scan.expect(",", ")") == ")":
                    scan.at -= 1
                    break
            scan.at += 1
            if scan.expect(",", "]") == "]":
                break
    except Ended:
        if not partial:
            raise Malformed("the list does not end") from None
        return calls, False, None
    if not scan.rest_is_blank():
        raise Malformed("more follows the list")
    return calls, True, None


def bracket_list(text: str, partial: bool = False, tag: str = "[TOOL_CALLS]", named: bool = False) -> Calls:
    """A tag, then a JSON list of objects with ``name`` and ``arguments``; with ``named`` names that an object of arguments follows."""
    before, found, _ = text.partition(tag)
    if not found:
        raise Malformed("no tag")
    body = text.replace(tag, "").strip() if not partial else text[len(before) + len(tag) :].strip()
    try:
        calls, finished = _listed(body, partial, named)
    except Malformed as e:
        e.content = body
        raise
    return calls, finished, before or None


def _listed(body: str, partial: bool, named: bool) -> tuple[list[tuple[str, object]], bool]:
    scan = Scanner(body, 0, False, partial)
    raw, finished = [], True
    try:
        if named:
            for name in iter(lambda: re.compile(r"[\s,]*([A-Za-z0-9_-]+)(?=\{)").match(body, scan.at), None):
                scan.at = name.end()
                raw.append({"name": name[1], "arguments": scan.value()})
            finished = scan.rest_is_blank() and not scan.ended
        else:
            try:
                raw = scan.value()
                if not scan.ended and not scan.rest_is_blank():
                    raise Malformed("more follows the list")
            except Malformed:
                first, last = body.find("[{"), body.rfind("}]")
                if partial or first < 0 or last < first:
                    raise
                raw = literal(body[first : last + 2])
            finished = not scan.ended
    except Ended:
        if not partial:
            raise Malformed("the list does not end") from None
        finished = False
    if not isinstance(raw, list) or not all(isinstance(c, dict) for c in raw) or not raw:
        raise Malformed("no list of objects")
    if partial:  # an object that is cut off may lack its arguments still, or its name
        raw = [{"arguments": {}, **c} for c in raw if isinstance(c.get("name"), str)]
    if not all(isinstance(c.get("name"), str) and "arguments" in c for c in raw):
        raise Malformed("a call without name or arguments")
    return [(c["name"], c["arguments"]) for c in raw], finished


def _segments(text: str, start: str, stop: str) -> list[tuple[str, bool]]:
    """What lies between tags, and whether the last one is closed."""
    out, at = [], 0
    while (first := text.find(start, at)) >= 0:
        first += len(start)
        last = text.find(stop, first)
        out.append((text[first : last if last >= 0 else len(text)], last >= 0))
        at = last + len(stop) if last >= 0 else len(text)
    return out


def converted(value: str, kind: str | None):
    """A tagged value in the type that a tool's parameter declares; text where it does not fit."""
    if value.lower() == "null":
        return None
    kind = "string" if kind is None else kind.strip().lower()
    if kind in ("string", "str", "text", "varchar", "char", "enum"):
        return value
    try:
        if kind.startswith(("int", "uint", "long", "short", "unsigned")):
            return int(value)
        if kind.startswith(("num", "float")):
            number = float(value)
            return int(number) if number == int(number) else number
    except ValueError:
        return value
    except OverflowError:
        raise Malformed("no finite number") from None
    if kind in ("boolean", "bool", "binary"):
        return value.lower() == "true"
    for python in (False, True) if kind in ("object", "array", "arr") or kind.startswith(("dict", "list")) else (True,):
        try:
            return literal(value, python)
        except Malformed:
            pass
    return value


def parameter_tags(text: str, partial: bool = False, tools: dict[str, dict[str, str]] | None = None) -> Calls:
    """``<function=name><parameter=key>value</parameter>...</function>``, in ``<tool_call>`` tags or not. ``tools`` gives the types of
    parameters. What is not closed ends with the text, partial or not."""
    function, tag = "<function=", "<tool_call>"
    if function not in text:
        raise Malformed("no call")
    calls, finished = [], True
    for outer, _ in _segments(text, tag, "</tool_call>") or [(text, True)]:
        for body, closed in _segments(outer, function, "</function>"):
            finished &= closed
            name, end, rest = body.partition(">")
            if not end:
                raise Malformed("a name that does not end")
            kinds = (tools or {}).get(name, {})
            arguments = {}
            for part in rest.split("<parameter=")[1:]:
                key, end, value = part.partition(">")
                if not end:
                    raise Malformed("a key that does not end")
                value = value.partition("</parameter>")[0].partition("</function>")[0]
                value = value.removeprefix("\n").removesuffix("\n")
                arguments[key] = converted(value, kinds[key]) if key in kinds or value.lower() == "null" else value
            calls.append((name, arguments))
    if not calls:
        raise Malformed("no call")
    at = text.find(tag) if tag in text else text.find(function)
    return calls, finished, text[:at] or None


_PAIRS = re.compile(r"<arg_key>(.*?)</arg_key>\s*<arg_value>(.*?)</arg_value>", re.DOTALL)


def argument_pairs(text: str, partial: bool = False, tools: dict[str, dict[str, str]] | None = None) -> Calls:
    """``<tool_call>name``, a line end, then ``<arg_key>`` and ``<arg_value>`` tags in turn. Values that are JSON or a Python literal are
    read as such, but for parameters that ``tools`` declares a string."""
    tag = "<tool_call>"
    calls, finished = [], True
    for body, closed in _segments(text, tag, "</tool_call>"):
        finished &= closed
        name, line, rest = body.partition("\n")
        if not (closed or partial):
            continue
        if not line:
            if not closed:
                continue
            raise Malformed("a name without a line end")
        arguments = {}
        for key, value in ((k.strip(), v.strip()) for k, v in _PAIRS.findall(rest)):
            for python in (False, True) if (tools or {}).get(name, {}).get(key) != "string" else ():
                try:
                    value = literal(value, python)
                    break
                except Malformed:
                    pass
            arguments[key] = value
        calls.append((name, arguments))
    if not calls:
        raise Malformed("no call")
    return calls, finished, text[: text.find(tag)]


class Raw(str):
    """Arguments that are kept as they stand."""


# Forms of marked sections. Section, call and end marks, and for each field of a call the mark that ends it.
SECTIONS = {
    "typed": ("<｜tool▁calls▁begin｜>", "<｜tool▁call▁begin｜>", "<｜tool▁call▁end｜>", (("type", "<｜tool▁sep｜>"), ("name", "\n```json\n"), ("arguments", "\n```"))),
    "plain": ("<｜tool▁calls▁begin｜>", "<｜tool▁call▁begin｜>", "<｜tool▁call▁end｜>", (("name", "<｜tool▁sep｜>"), ("arguments", ""))),
    "numbered": ("<|tool_calls_section_begin|>", "<|tool_call_begin|>", "<|tool_call_end|>", (("name", "<|tool_call_argument_begin|>"), ("arguments", ""))),
}


def marked_section(text: str, partial: bool = False, form: str = "plain") -> Calls:
    """A section of calls between marks; arguments stay the text that they are. A name of ``numbered`` loses its number and what a dot
    divides from it. Calls whose marks are not all there are left out; in partial output the last may lack the end."""
    section, begin, end, fields = SECTIONS[form]
    before, found, body = text.partition(section)
    if not found:
        raise Malformed("no section")
    calls, finished = [], True
    for rest, closed in _segments(body, begin, end):
        finished &= closed
        got: dict[str, str] = {}
        for role, mark in fields:
            value, met, rest = rest.partition(mark) if mark else (rest, "whole", "")
            if not met and not (partial and role == "arguments"):
                break
            got[role] = value.strip()
        if "arguments" not in got or not (closed or partial):
            continue
        name = got["name"].rsplit(":", 1)[0].rsplit(".", 1)[-1] if form == "numbered" else got["name"]
        calls.append((name, Raw(got["arguments"])))
    return calls, finished, before or None


def parsed(output: Column, parser: Callable[..., Calls], **options) -> Column:
    """struct<called, finished, calls, content> by a parser of this module, null for null."""

    def one(text: str | None) -> dict | None:
        if text is None:
            return None
        try:
            calls, finished, content = parser(text, **options)
            made = [{"name": n, "arguments": a if isinstance(a, Raw) else json.dumps(a, ensure_ascii=False, allow_nan=False)} for n, a in calls]
            return {"called": bool(made), "finished": finished, "calls": made, "content": content}
        except ValueError as e:  # malformed, or a number that JSON has no form for
            content = getattr(e, "content", None)
            return {"called": False, "finished": True, "calls": [], "content": text if content is None else content}

    ship()
    return F.arrow_udf(lambda values: pa.array([one(t) for t in values.to_pylist()], _TYPE), CALLS)(output)
