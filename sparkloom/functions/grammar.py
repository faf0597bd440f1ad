"""Context-free constraints on texts: a grammar's text is compiled once, whole columns are recognised in Arrow batches.

A grammar is rules ``name ::= alternatives`` from the rule ``root`` on. An alternative is a sequence of literals (``"..."``), character classes
(``[a-z_]``, ``[^"]``), any character (``.``), rule names and groups in parentheses, each with an optional ``*``, ``+``, ``?`` or
``{m,n}``; ``#`` starts a comment. Escapes in literals and classes: backslash before n, r, t, x and two, u and four hex digits, or any
other character, which then stands for itself.

Recognition is Earley's, with sets that are told apart by content: an item points to the set where its rule began, not to a place in
the text. Equal sets are one object, whatever their places, and remember where each class of characters leads. So what a grammar does
over and over is looked up, a character costs one look, and only new nestings are worked out. Repetitions are compiled to left
recursion, which keeps sets small; a rule that is right recursive by itself grows them with its depth.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.ship import ship

#: Code points end here.
END = 0x110000
#: Sets that a worker remembers between texts.
MOST_SETS = 50_000
START = "root"
#: Copies that ``{m,n}`` may ask for.
MOST_COPIES = 1000

Ranges = tuple[tuple[int, int], ...]


# ---------------------------------------------------------------- the grammar's text


class _Reader:
    """Rules of a grammar's text: name -> alternatives, each a list of rule names (str) and character ranges (tuple)."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.rules: dict[str, list[list[str | Ranges]]] = {}
        self.space()
        while self.at < len(self.text):
            name = self.name()
            self.space()
            self.expect("::=")
            if name in self.rules:
                raise ValueError(f"rule {name} is given twice")
            self.rules[name] = []
            self.rules[name] = self.alternatives(name)
        missing = {s for alternatives in self.rules.values() for a in alternatives for s in a if isinstance(s, str)} - set(self.rules)
        if missing or START not in self.rules:
            raise ValueError(f"rules not given: {sorted(missing) or [START]}")

    def space(self) -> None:
        while self.at < len(self.text):
            if self.text[self.at] == "#":
                end = self.text.find("\n", self.at)
                self.at = len(self.text) if end < 0 else end
            elif self.text[self.at].isspace():
                self.at += 1
            else:
                return

    def expect(self, mark: str) -> None:
        if not self.text.startswith(mark, self.at):
            raise ValueError(f"{mark} expected at {self.at}")
        self.at += len(mark)

    def name(self) -> str:
        first = self.at
        while self.at < len(self.text) and (self.text[self.at].isalnum() or self.text[self.at] in "_-"):
            self.at += 1
        if first == self.at:
            raise ValueError(f"a name expected at {first}")
        return self.text[first : self.at]

    def begins_rule(self) -> bool:
        """Whether a name and ``::=`` follow, so that a new rule begins."""
        kept = self.at
        try:
            self.name()
            self.space()
            return self.text.startswith("::=", self.at)
        except ValueError:
            return False
        finally:
            self.at = kept

    def helper(self, owner: str, alternatives: list[list[str | Ranges]]) -> str:
        name = f"{owner}/{len(self.rules)}"
        self.rules[name] = alternatives
        return name

    def alternatives(self, owner: str) -> list[list[str | Ranges]]:
        out: list[list[str | Ranges]] = [[]]
        while True:
            self.space()
            if self.at >= len(self.text) or self.text[self.at] == ")" or self.begins_rule():
                return out
            if self.text[self.at] == "|":
                self.at += 1
                out.append([])
                continue
            out[-1] += self.counted(owner, self.one(owner))

    def one(self, owner: str) -> list[str | Ranges]:
        mark = self.text[self.at]
        if mark == '"':
            return [((c, c + 1),) for c in self.until('"')]
        if mark == "[":
            return [self.character_class()]
        if mark == ".":
            self.at += 1
            return [((0, END),)]
        if mark == "(":
            self.at += 1
            inner = self.alternatives(owner)
            self.expect(")")
            return [self.helper(owner, inner)]
        return [self.name()]

    def escaped(self) -> int:
        """The character at a backslash."""
        mark = self.text[self.at + 1 : self.at + 2]
        digits = {"x": 2, "u": 4}.get(mark, 0)
        if not mark:
            raise ValueError("a backslash ends the grammar")
        code = int(self.text[self.at + 2 : self.at + 2 + digits], 16) if digits else ord({"n": "\n", "r": "\r", "t": "\t"}.get(mark, mark))
        self.at += 2 + digits
        return code

    def until(self, end: str) -> list[int]:
        self.at += 1
        out = []
        while self.text[self.at : self.at + 1] != end:
            if self.at >= len(self.text):
                raise ValueError(f"{end} expected at the end")
            if self.text[self.at] == "\\":
                out.append(self.escaped())
            else:
                out.append(ord(self.text[self.at]))
                self.at += 1
        self.at += 1
        return out

    def character_class(self) -> Ranges:
        self.at += 1
        negated = self.text.startswith("^", self.at)
        self.at += negated
        ranges = []
        while self.text[self.at : self.at + 1] != "]":
            if self.at >= len(self.text):
                raise ValueError("] expected at the end")
            low = high = self.member()
            if self.text.startswith("-", self.at) and self.text[self.at + 1 : self.at + 2] not in ("]", ""):
                self.at += 1
                high = self.member()
            ranges.append((low, high + 1))
        self.at += 1
        ranges.sort()
        if not negated:
            return tuple(ranges)
        out, last = [], 0
        for low, high in ranges:
            if last < low:
                out.append((last, low))
            last = max(last, high)
        return (*out, (last, END)) if last < END else tuple(out)

    def member(self) -> int:
        if self.text[self.at] == "\\":
            return self.escaped()
        self.at += 1
        return ord(self.text[self.at - 1])

    def counted(self, owner: str, one: list[str | Ranges]) -> list[str | Ranges]:
        mark = self.text[self.at : self.at + 1]
        low, high = {"*": (0, None), "+": (1, None), "?": (0, 1)}.get(mark, (1, 1))
        if mark == "{":
            end = self.text.find("}", self.at)
            first, comma, last = self.text[self.at + 1 : end].partition(",")
            low = int(first)
            high = int(last) if last.strip() else None if comma else low
            self.at = end
            if max(low, high or 0) > MOST_COPIES or high is not None and high < low:
                raise ValueError(f"{{{first}{comma}{last}}} is no count up to {MOST_COPIES}")
        if mark and mark in "*+?{":
            self.at += 1
        if (low, high) == (1, 1):
            return one
        # a literal counts as a whole
        name = self.helper(owner, [one])
        out: list[str | Ranges] = [name] * low
        if high is None:
            loop = self.helper(owner, [])
            self.rules[loop] = [[], [loop, name]]
            return [*out, loop]
        rest = ""
        for _ in range(high - low):  # a part, then perhaps the rest
            rest = self.helper(owner, [[], [name, rest] if rest else [name]])
        return [*out, rest] if rest else out


# ---------------------------------------------------------------- recognition


class _Set:
    """An Earley set: open items (rule number, dot, the set where the rule began or None for this one), and those that wait for a rule."""

    __slots__ = ("accepts", "items", "moves", "waiting")

    def __init__(self, items: frozenset, waiting: dict[str, list], accepts: bool):
        self.items, self.waiting, self.accepts = items, waiting, accepts
        self.moves: dict[int, _Set | None] = {}


class Grammar:
    """A compiled grammar. ``run`` gives how far a text can be the beginning of a sentence, and whether it is one."""

    def __init__(self, text: str):
        rules = _Reader(text).rules
        ranges = {s for alternatives in rules.values() for a in alternatives for s in a if not isinstance(s, str)}
        #: Characters between two edges are alike for every terminal: a class.
        self.edges = sorted({0, END, *(edge for r in ranges for pair in r for edge in pair)})
        classes = {r: frozenset(c for c, low in enumerate(self.edges[:-1]) if any(a <= low < b for a, b in r)) for r in ranges}
        self.heads: list[str] = []
        self.bodies: list[tuple] = []
        self.rules_of: dict[str, list[int]] = {name: [] for name in rules}
        for name, alternatives in rules.items():
            for body in alternatives:
                self.rules_of[name].append(len(self.heads))
                self.heads.append(name)
                self.bodies.append(tuple(s if isinstance(s, str) else classes[s] for s in body))
        self.nullable: set[str] = set()
        while more := {h for h, b in zip(self.heads, self.bodies, strict=True) if h not in self.nullable and all(isinstance(s, str) and s in self.nullable for s in b)}:
            self.nullable |= more
        self.class_of: dict[str, int] = {}
        self.known: dict[tuple, _Set] = {}
        self.first: _Set | None = None
        self.first = self._closed([(rule, 0, None) for rule in self.rules_of[START]])

    def _closed(self, kernel: list[tuple]) -> _Set:
        """The set of some items and all that follow from them without a character."""
        items, todo = set(kernel), list(kernel)
        waiting: dict[str, list] = {}  # items of this set that wait for a rule

        def add(item: tuple) -> None:
            if item not in items:
                items.add(item)
                todo.append(item)

        while todo:
            rule, dot, origin = todo.pop()
            body = self.bodies[rule]
            if dot < len(body):
                symbol = body[dot]
                if isinstance(symbol, str):
                    waiting.setdefault(symbol, []).append((rule, dot, origin))
                    for r in self.rules_of[symbol]:
                        add((r, 0, None))
                    if symbol in self.nullable:
                        add((rule, dot + 1, origin))
            elif origin is not None:  # rules that begin and end here are passed by their nullable names
                for r, d, o in origin.waiting.get(self.heads[rule], ()):
                    add((r, d + 1, origin if o is None else o))
        # what is complete has had its effect, so only the rest tells sets apart: a loop comes back to the set it left
        accepts = any(dot == len(self.bodies[rule]) and self.heads[rule] == START and origin is self.first for rule, dot, origin in items)
        open_ = frozenset((rule, dot, origin) for rule, dot, origin in items if dot < len(self.bodies[rule]))
        key = (open_, accepts)
        if key not in self.known:
            self.known[key] = _Set(open_, waiting, accepts)
        return self.known[key]

    def _next(self, now: _Set, cls: int) -> _Set | None:
        kernel = []
        for rule, dot, origin in now.items:
            body = self.bodies[rule]
            if dot < len(body) and not isinstance(body[dot], str) and cls in body[dot]:
                kernel.append((rule, dot + 1, now if origin is None else origin))
        found = now.moves[cls] = self._closed(kernel) if kernel else None
        return found

    def run(self, text: str) -> tuple[int, bool]:
        if len(self.known) > MOST_SETS:
            self.known = {(self.first.items, self.first.accepts): self.first}
            self.first.moves.clear()
        now, class_of = self.first, self.class_of
        for i, c in enumerate(text):
            cls = class_of.get(c)
            if cls is None:
                cls = class_of[c] = bisect_right(self.edges, ord(c)) - 1
            then = now.moves.get(cls)
            if then is None:
                then = None if cls in now.moves else self._next(now, cls)
                if then is None:
                    return i, False
            now = then
        return len(text), now.accepts or (now is self.first and START in self.nullable)


@lru_cache(maxsize=8)
def compiled(text: str) -> Grammar:
    """One per worker and grammar, kept from batch to batch."""
    return Grammar(text)


def recognised(text: Column, grammar: str) -> Column:
    """struct<accepted, valid>: whether a text is a sentence of the grammar, and how many of its first characters can begin one. Null for
    null. The grammar is checked when the column is made."""
    Grammar(grammar)
    ship()

    def run(values: pa.Array) -> pa.Array:
        machine = compiled(grammar)
        got = [None if t is None else machine.run(t) for t in values.to_pylist()]
        return pa.array([None if g is None else {"accepted": g[1], "valid": g[0]} for g in got], pa.struct([("accepted", pa.bool_()), ("valid", pa.int64())]))

    return F.arrow_udf(run, "accepted boolean, valid long")(text)
