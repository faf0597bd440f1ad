"""Model outputs: nested call forms, grammars, many patterns, token lookups."""

from __future__ import annotations

import ast
import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import calls, grammar, patterns, tokens
from sparkloom.functions import text as T
from sparkloom.operators import adapters, detokenising, passages, scheduling
from sparkloom.plans.outputs import JSON_GRAMMAR


def one(spark, text, parser):
    return spark.createDataFrame([(text,)], "t string").select(parser(F.col("t")).alias("r")).first()["r"]


# ---------------------------------------------------------------- calls


def plain_expressions(text):
    module = ast.parse(text)
    if not re.match(r"\[\s*[A-Za-z]", text) or len(module.body) != 1:
        raise ValueError

    def value(v):
        if isinstance(v, ast.Constant):
            return v.value
        if isinstance(v, ast.List):
            return [value(x) for x in v.elts]
        if isinstance(v, ast.Dict) and all(isinstance(k, ast.Constant) for k in v.keys):
            return {k.value: value(x) for k, x in zip(v.keys, v.values, strict=True)}
        raise ValueError

    listed = module.body[0].value
    if not isinstance(listed, ast.List) or not all(isinstance(e, ast.Call) and isinstance(e.func, ast.Name) and not e.args for e in listed.elts):
        raise ValueError
    return [(e.func.id, {k.arg: value(k.value) for k in e.keywords}) for e in listed.elts]


def python_value(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.55:
        return rng.choice(["1", "0", "1.5", "1e3", ".5", "5.", "'a'", '"b\\"c"', "'\\n\\x41\\u00e9'", "True", "None", "'x' 'y'", "'''t\nq'''", "1_000", "0x1f", "-3", "foo", "01", "''"])
    if kind < 0.8:
        return "[" + ", ".join(python_value(rng, depth + 1) for _ in range(rng.randint(0, 3))) + "]"
    return "{" + ",".join(rng.choice(["'k'", "1", "None"]) + ": " + python_value(rng, depth + 1) for _ in range(rng.randint(0, 3))) + "}"


@pytest.mark.filterwarnings("ignore::SyntaxWarning")
def test_call_expressions_equal_a_plain_parser():
    rng = random.Random(1)
    good = 0
    for _ in range(6000):
        text = "[" + ", ".join(rng.choice("fgh") + "(" + ", ".join(rng.choice("ab") + "=" + python_value(rng) for _ in range(rng.randint(0, 3))) + ")" for _ in range(rng.randint(1, 3))) + "]" + rng.choice(["", "\n", " x"])
        if rng.random() < 0.3:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice("()[]{}:='\"x") + text[k + rng.randint(0, 1) :]
        try:
            want = plain_expressions(text)
        except (ValueError, SyntaxError):
            want = None
        try:
            got = calls.call_expressions(text)[0]
        except calls.Malformed:
            got = None
        assert got == want, text
        good += want is not None
    assert good > 1000


def test_json_values_equal_the_standard_library():
    rng = random.Random(2)

    def made(depth=0):
        kind = rng.random()
        if depth > 3 or kind < 0.5:
            return rng.choice([1, 0, -2.5, "a", 'q"\\\né😀', True, None, 1e30, "\x01"])
        if kind < 0.75:
            return [made(depth + 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice("abc"): made(depth + 1) for _ in range(rng.randint(0, 3))}

    for _ in range(6000):
        text = json.dumps(made(), ensure_ascii=rng.random() < 0.5)
        if rng.random() < 0.4:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice('[]{},:" 1e-\\') + text[k + rng.randint(0, 1) :]
        try:
            want = json.loads(text)
            json.dumps(want, ensure_ascii=False).encode()
        except ValueError:  # no JSON, or half of a surrogate pair, which no text holds
            want = "none"
        try:
            got = calls.literal(text)
        except calls.Malformed:
            got = "none"
        assert got == want, text


@pytest.mark.parametrize(
    ("cut", "want"),
    [
        ("[", []),
        ("[get", []),
        ("[get(", [("get", {})]),
        ("[get(city", [("get", {})]),
        ('[get(city="New', [("get", {"city": "New"})]),
        ('[get(city="New Y\\u00', [("get", {"city": "New Y"})]),
        ('[get(city="a", days=[1, 2', [("get", {"city": "a", "days": [1]})]),
        ('[get(days=[1, {"a": [2, ', [("get", {"days": [1, {"a": [2]}]})]),
        ('[get(days={"a', [("get", {"days": {}})]),
        ("[get(ok=Tr", [("get", {})]),
        ("[get(ok=True), stop()", [("get", {"ok": True}), ("stop", {})]),
    ],
)
def test_unfinished_expressions(cut, want):
    assert calls.call_expressions(cut, partial=True) == (want, False, None)
    with pytest.raises(calls.Malformed):
        calls.call_expressions(cut)


def test_bracket_lists(spark):
    two = 'hello [TOOL_CALLS] [{"name":"f","arguments":{"a":"]"}},{"name":"g","arguments":null}]'
    r = one(spark, two, T.TOOL_PARSERS["bracketed"])
    assert (r.called, r.content, [(c.name, c.arguments) for c in r.calls]) == (True, "hello ", [("f", '{"a": "]"}'), ("g", "null")])
    r = one(spark, 'x [TOOL_CALLS] sure: [{"name":"f","arguments":{}}] done', T.TOOL_PARSERS["bracketed"])
    assert r.called and r.calls[0].name == "f"
    r = one(spark, '[TOOL_CALLS]f{"a": {"b": "}"}} g{}', T.TOOL_PARSERS["bracketed_names"])
    assert [(c.name, json.loads(c.arguments)) for c in r.calls] == [("f", {"a": {"b": "}"}}), ("g", {})]
    r = one(spark, "a [TOOL_CALLS] nothing", T.TOOL_PARSERS["bracketed"])
    assert (r.called, r.content) == (False, "a  nothing")
    assert one(spark, "plain", T.TOOL_PARSERS["bracketed"]).content == "plain"
    assert one(spark, None, T.TOOL_PARSERS["bracketed"]) is None
    r = one(spark, 'hello [TOOL_CALLS]{"name":"f","arguments":{}}[/TOOL_CALLS]', T.TOOL_PARSERS["bracket_pairs"])
    assert (r.called, r.content) == (True, "hello ")
    assert calls.bracket_list('[TOOL_CALLS] [{"name":"f","arguments":{"a":[1,"x', partial=True) == ([("f", {"a": [1, "x"]})], False, None)


def test_tagged_parameters():
    tools = {"f": {"a": "integer", "b": "object", "c": "number", "d": "bool", "e": "string"}}
    text = "hi<tool_call>\n<function=f>\n<parameter=a>\n5\n</parameter>\n<parameter=b>{'x': [1]}</parameter><parameter=c>2.0<parameter=d>TRUE</parameter><parameter=e>7</parameter><parameter=z>8</parameter></function>\n</tool_call>"
    assert calls.parameter_tags(text, tools=tools) == ([("f", {"a": 5, "b": {"x": [1]}, "c": 2, "d": True, "e": "7", "z": "8"})], True, "hi")
    assert calls.parameter_tags("<function=f><parameter=a>five</parameter><parameter=e>null", tools=tools) == ([("f", {"a": "five", "e": None})], False, None)
    assert calls.parameter_tags("<tool_call><function=g></function></tool_call><tool_call><function=h><parameter=k>v</parameter></function>")[0] == [("g", {}), ("h", {"k": "v"})]
    for bad in ("no call", "<function=name"):
        with pytest.raises(calls.Malformed):
            calls.parameter_tags(bad)


def test_argument_pairs():
    text = "c<tool_call>f\n<arg_key>a</arg_key>\n<arg_value>[1, 2]</arg_value><arg_key> b </arg_key><arg_value>hey</arg_value><arg_key>s</arg_key><arg_value>12</arg_value></tool_call>"
    assert calls.argument_pairs(text, tools={"f": {"s": "string"}}) == ([("f", {"a": [1, 2], "b": "hey", "s": "12"})], True, "c")
    with pytest.raises(calls.Malformed):
        calls.argument_pairs("<tool_call>f</tool_call>")
    assert calls.argument_pairs("<tool_call>f\n<arg_key>a</arg_key><arg_value>1</arg_value>", partial=True) == ([("f", {"a": 1})], False, "")


def test_marked_sections(spark):
    begin, call, sep, end = "<｜tool▁calls▁begin｜>", "<｜tool▁call▁begin｜>", "<｜tool▁sep｜>", "<｜tool▁call▁end｜>"
    r = one(spark, f'so {begin}{call}function{sep}f\n```json\n{{"a": 1}}\n```{end}\n{call}function{sep}g\n```json\n{{}}\n```{end}', T.TOOL_PARSERS["typed_section"])
    assert (r.called, r.finished, r.content, [tuple(c) for c in r.calls]) == (True, True, "so ", [("f", '{"a": 1}'), ("g", "{}")])
    r = one(spark, f'{begin}{call}f{sep}{{"a":1}}{end}{call}broken{end}', T.TOOL_PARSERS["plain_section"])
    assert [tuple(c) for c in r.calls] == [("f", '{"a":1}')] and r.content is None
    r = one(spark, 'x<|tool_calls_section_begin|><|tool_call_begin|> functions.get_it:0 <|tool_call_argument_begin|> {"a": [1]} <|tool_call_end|>', T.TOOL_PARSERS["numbered_section"])
    assert [tuple(c) for c in r.calls] == [("get_it", '{"a": [1]}')] and r.content == "x"
    assert one(spark, "none", T.TOOL_PARSERS["numbered_section"]).called is False
    assert calls.marked_section(f'{begin}{call}f{sep}{{"a', partial=True) == ([("f", '{"a')], False, None)
    r = one(spark, 'functools[{"name": "f", "arguments": {"a": 1}}]', T.TOOL_PARSERS["function_list"])
    assert [tuple(c) for c in r.calls] == [("f", '{"a": 1}')]


def test_reasoning_between_both_tags(spark):
    got = [tuple(one(spark, t, T.REASONING_PARSERS["both_think_tags"])) for t in ("a<think>b</think>c", "<think>b</think>", "<think>b", "b</think>c", "plain")]
    assert got == [("b", "c"), ("b", None), (None, "<think>b"), (None, "b</think>c"), (None, "plain")]


@pytest.mark.parametrize(
    ("text", "called"),
    [
        ('<tool_call>{"name":"f","arguments":{"a":1}} x</tool_call>', False),
        ('<tool_call>{"name":"f","arguments":null}</tool_call>', True),
        ('<tool_call>{"name":"f"}</tool_call>', False),
        ("<tool_call></tool_call>", False),
        ('<tool_call>{"name":"f","arguments":{}},0] x</tool_call>', False),
        ('<tool_call>{"name":"f","arguments":{}}] x</tool_call>', False),
        ('a<tool_call>{"name":"f","arguments":{}}', True),
    ],
)
def test_tagged_calls_are_strict(spark, text, called):
    r = one(spark, text, T.TOOL_PARSERS["call_tags"])
    assert r.called == called
    if "null" in text:
        assert r.calls[0].arguments == "null"


# ---------------------------------------------------------------- grammars


def sentences(rules, alphabet, most):
    """All sentences of up to ``most`` characters, by a fixed point of languages."""
    known = {name: set() for name in rules}
    while True:
        grown = False
        for name, alternatives in rules.items():
            for body in alternatives:
                made = {""}
                for s in body:
                    options = known[s] if isinstance(s, str) else {c for c in alphabet if any(a <= ord(c) < b for a, b in s)}
                    made = {x + y for x in made for y in options if len(x) + len(y) <= most}
                grown |= not made <= known[name]
                known[name] |= made
        if not grown:
            return known["root"]


def random_grammar(rng):
    names = ["root", "a-rule", "b"]

    def expression(depth):
        return " | ".join(" ".join(item(depth) for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(1, 3)))

    def item(depth):
        kind = rng.random()
        inner = rng.choice(['"x"', '"y"', "[xy]", "[^x]", '"xy"']) if kind < 0.5 else rng.choice(names) if kind < 0.8 or depth > 1 else f"({expression(depth + 1)})"
        return inner + rng.choice(["", "", "", "*", "+", "?", "{1,2}", "{2}"])

    return "\n".join(f"{n} ::= {expression(0)}" for n in names)


def test_grammars_accept_their_sentences_and_no_others():
    rng = random.Random(3)
    for _ in range(120):
        text = random_grammar(rng)
        machine, language = grammar.Grammar(text), sentences(grammar._Reader(text).rules, "xyz", 4)
        for n in range(5):
            for word in map("".join, itertools.product("xyz", repeat=n)):
                assert machine.run(word)[1] == (word in language), (text, word)


def test_json_grammar_equals_the_parser():
    rng, machine = random.Random(4), grammar.Grammar(JSON_GRAMMAR)
    for _ in range(1500):
        text = json.dumps({"a": [1, -2.5e3, {"b": None}], "c": 'é"\\\n', "d": [True, False, {}, []]}, ensure_ascii=rng.random() < 0.5)
        if rng.random() < 0.7:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice('[]{},:" 1e-\\ntf') + text[k + rng.randint(0, 1) :]
        try:
            json.loads(text)
            good = True
        except ValueError:
            good = False
        assert machine.run(text)[1] == good, text


def test_what_loops_is_looked_up():
    machine = grammar.Grammar(JSON_GRAMMAR)
    text = json.dumps([{f"k{i}": [i, str(i), {"z": [1.5]}]} for i in range(3000)])
    assert machine.run(text) == (len(text), True) and len(machine.known) < 400
    assert machine.run(text[:-1]) == (len(text) - 1, False)
    deep = "[" * 3000 + "]" * 3000
    assert machine.run(deep) == (6000, True)


def test_constraint_column(spark):
    rows = spark.createDataFrame([("(a[b]c)", 1), ("(a]", 2), (None, 3), ("", 4), ("((", 5)], "t string, i int")
    rule = r'root ::= ( [^()\[\]] | "(" root ")" | "[" root "]" )*'
    got = rows.select("i", grammar.recognised(F.col("t"), rule).alias("g"), adapters.meets(F.col("t"), "grammar", rule).alias("m")).orderBy("i").collect()
    assert [(r.g and (r.g.accepted, r.g.valid), r.m) for r in got] == [((True, 7), True), ((False, 2), False), (None, False), ((True, 0), True), ((False, 2), False)]
    for bad in ('root ::= "a', "root ::= other", 'a ::= "x"', "root ::= [a", 'root ::= "a"{5000}'):
        with pytest.raises(ValueError):
            grammar.recognised(F.col("t"), bad)


# ---------------------------------------------------------------- many patterns, token lookups


def test_many_stop_strings_equal_one_by_one(spark):
    rng = random.Random(5)
    stops = ["".join(rng.choices("abé", k=rng.randint(1, 4))) for _ in range(40)] + ["", "ab", "ab"]
    texts = ["".join(rng.choices("abéc ", k=rng.randint(0, 12))) for _ in range(300)] + [None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for include in (False, True):
        got = rows.select(patterns.stop_at_any(F.col("t"), stops, include).alias("a"), T.stop_at(F.col("t"), stops, include).alias("b")).collect()
        assert all(tuple(r.a) == tuple(r.b) for r in got)
    counts = rows.select("t", patterns.occurrences(F.col("t"), ["ab", "é", "aa"]).alias("m")).collect()
    assert all(r.m == (None if r.t is None else {p: n for p in ("ab", "é", "aa") if (n := len(re.findall(f"(?={p})", r.t)))}) for r in counts)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_patterns_of_a_table_equal_those_of_a_list(spark, broadcast):
    rng, block = random.Random(8), patterns.BLOCK
    stops = [("".join(rng.choices("abé😀", k=rng.randint(2, 9))), rng.choice([None, *range(60)])) for _ in range(300)] + [("", 0), (None, 1), ("w" * 200, 2)]
    texts = ["".join(rng.choices("abé😀c ", k=rng.randint(0, 40))) for _ in range(200)] + [None, "", *["x" * n + s for n in (block - 3, 2 * block - 150) for s in ("w" * 200, "éaab")], "w" * 199]
    rows = spark.createDataFrame([(i % 150, t, {"k": i}) for i, t in enumerate(texts)], "id int, t string, m map<string,int>")
    table = spark.createDataFrame(stops, "pattern string, rank int")
    least = {}
    for s, r in stops:
        if s and r is not None:
            least[s] = min(r, least.get(s, r))
    first = [min(((r, s) for s, r in least.items() if t and s in t), default=(None, None))[1] for t in texts]
    expected = sorted((i % 150, i, s, None if s is None else texts[i].index(s)) for i, s in enumerate(first))
    counts = {s: n for s, _ in stops if s and (n := sum(s in (t or "") for t in texts))}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for listed in (0, passages.LISTED):
            got = passages.first_stop(rows, "t", table, listed).collect()
            assert sorted((r.id, r.m["k"], r.stop, r["at"]) for r in got) == expected
            assert {r.pattern: r.texts for r in passages.texts_with(rows, "t", table, listed).collect()} == counts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(s is None for s in first) > 5 and len(set(first)) > 20 and "w" * 200 in first


def test_ten_thousand_patterns_take_one_pass(spark):
    rng = random.Random(6)
    stops = ["".join(rng.choices("abcdefghij", k=8)) for _ in range(10_000)]
    text = "".join(rng.choices("klmnop ", k=200_000)) + stops[777] + "k" + stops[5]
    r = one(spark, text, lambda c: patterns.stop_at_any(c, stops))
    assert r.stop == stops[5] and len(r.text) == 200_009
    with pytest.raises(ValueError):
        patterns.stop_at_any(F.lit("x"), ["a" * (patterns.MOST_BYTES + 1)])


def test_many_stops_of_a_token_stream_equal_one_by_one(spark, monkeypatch):
    rng = random.Random(9)
    stops = tuple(dict.fromkeys("".join(rng.choices("abé", k=rng.randint(2, 4))) for _ in range(20)))
    for _ in range(300):
        data = "".join(rng.choices("abécd", k=rng.randint(1, 30))).encode()
        pieces = [data[i : i + 2] for i in range(0, len(data), 2)]
        options = {"stop": stops, "least": rng.choice([0, 3]), "include": rng.random() < 0.5}
        many = list(detokenising.deltas(pieces, **options))
        monkeypatch.setattr(detokenising, "automaton", lambda stop: None)
        assert list(detokenising.deltas(pieces, **options)) == many
        monkeypatch.undo()
    rows = spark.createDataFrame([(1, 2, b"\xa9c"), (1, 0, b"a"), (1, 1, b"\xc3"), (2, 0, b"x")], "req int, pos int, piece binary")
    got = sorted(map(tuple, detokenising.detokenised(rows).collect()))
    assert got == [(1, 0, "a", None), (1, 1, "", None), (1, 2, "éc", None), (2, 0, "x", None)]


def test_masked_tokens_equal_word_by_word(spark):
    rng = random.Random(7)
    bad = [[rng.randrange(3) for _ in range(rng.randint(1, 4))] for _ in range(25)] + [[]]
    rows = [([rng.randrange(3) for _ in range(rng.randint(0, 6))],) for _ in range(100)] + [(None,)]
    got = spark.createDataFrame(rows, "t array<int>").select("t", patterns.masked_tokens(F.col("t"), bad).alias("m")).collect()
    for r in got:
        assert r.m == (None if r.t is None else sorted({w[-1] for w in bad if w and (len(w) == 1 or r.t[-len(w) + 1 :] == w[:-1] and len(r.t) >= len(w) - 1)}))


def test_longest_repeat_equals_trying_all(spark):
    rng = random.Random(8)
    for _ in range(3000):
        row = [rng.randrange(3) for _ in range(rng.randint(0, 25))]
        low, high = rng.choice([(1, 1), (1, 3), (2, 5), (3, 3), (2, 40)])
        want = (0, 0)
        for width in range(high, low - 1, -1):
            starts = [i for i in range(len(row) - width) if row[i : i + width] == row[len(row) - width :]]
            if starts and len(row) > width:
                want = (width, starts[0])
                break
        assert tokens.longest_repeat(row, low, high) == want, (row, low, high)
    rows = spark.createDataFrame([([1, 2, 3, 1, 2],), ([1],), (None,), ([],)], "t array<int>")
    assert [r.p for r in rows.select(tokens.ngram_proposal(F.col("t"), 1, 3, 2, 100).alias("p")).collect()] == [[3, 1], None, None, None]
    assert rows.select(tokens.ngram_proposal(F.col("t"), 1, 3, 2, 6).alias("p")).first().p == [3]


def test_block_hashes_skip_nulls(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4, 5],), ([None, 2, 3, 4],), (None,), ([],)], "t array<int>")
    got = [r.h for r in rows.select(tokens.prefix_block_hashes(F.col("t"), 2).alias("h")).collect()]
    assert [None if h is None else len(h) for h in got] == [2, 2, None, 0] and got[0][0] != got[1][0]


def test_a_shared_query_is_one_row(spark):
    docs = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "pos int, vector array<double>")
    assert scheduling.scored_pairs(docs.filter("pos = 0"), docs, shared=True).count() == 2
    with pytest.raises(Exception, match="one row"):
        scheduling.scored_pairs(docs, docs, shared=True).collect()
