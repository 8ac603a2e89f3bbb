"""Operator 4: secret scans by patterns and assignment-aware lexing."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame

from barstream.llm.common import long, sha256, string, text_rows

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # runs are taken whole, so those of fewer characters never match
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "literal")

# Parts of names and the weight each lends a literal.
SENSITIVE = {
    "password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "secret": 3, "token": 2, "apikey": 3, "accesskey": 3, "privatekey": 3,
    "credential": 3, "credentials": 3, "auth": 1, "bearer": 2, "signature": 1, "salt": 1, "cookie": 1, "session": 1, "connectionstring": 2,
    "dsn": 1, "webhook": 1, "key": 1,
}
# Parts of names that say the value is no secret, and words of placeholder values.
HARMLESS = ("public", "length", "size", "count", "limit", "field", "label", "name", "file", "path", "url", "type", "min", "max", "expiry", "ttl")
PLACEHOLDER = re.compile(r"(?i)^(?:x{4,}|\*{3,}|\.{3,}|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s|changeme|change_me|example|placeholder|redacted|dummy|test|none|null|true|false|your[-_ ].*|todo)$")

OPERATOR = re.compile(r":=|=>|[:=]")
NAME_BEFORE = re.compile(r"""([A-Za-z_][A-Za-z0-9_.\-]{0,63})(?P<quote>["']?)\]?[ \t]*(?::[ \t]*[A-Za-z_][A-Za-z0-9_\[\]]{0,31}[ \t]*)?$""")
# Python's prefixes; triple quotes before single ones, and over lines.
STRING = re.compile(r'''(?:[bBfFrRuU]{1,2}(?=["']))?(?:"""((?s:(?:[^\\]|\\.)*?))"""|\'\'\'((?s:(?:[^\\]|\\.)*?))\'\'\'|"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)''')
BARE = re.compile(r"[A-Za-z0-9+/_.=~!@$%^*-]{6,}")
WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")
BLANKS, WIDE_BLANKS, OPENED = re.compile(r"[ \t]*"), re.compile(r"[ \t\r\n]*"), re.compile(r"[ \t]*\([ \t\r\n]*(?=[bBfFrRuU]{0,2}[\"'])")
QUOTES = {'"', "'"}
PLUS = re.compile(r"""[ \t]*\+[ \t]*(?=["'`A-Za-z_])""")
REACH = 130
SCORE = 5.0
#: Characters that are kept of a value made of several parts: more change nothing in its score.
SCORED = 1_024


class Value:
    """What a name stands for: the beginning of its text, and where its literals are, shared with the values it is made of."""

    __slots__ = ("text", "span", "parts")

    def __init__(self, text: str, span: tuple[int, int] | None = None, parts: tuple[Value, ...] = ()):
        self.text, self.span, self.parts = text, span, parts


def joined_value(parts: list[Value]) -> Value:
    if len(parts) == 1:
        return parts[0]
    text = ""
    for part in parts:
        if len(text) < SCORED:
            text += part.text[:SCORED]
    return Value(text[:SCORED], parts=tuple(parts))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns: code points, end exclusive."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def assignments(text: str) -> list[tuple[str, Value]]:
    """(target name, value) of every assignment whose value is known.

    Source and configuration syntax: ``name = "x"``, ``name: x``, ``"name":
    "x"``, ``d["name"] = 'x'``, ``name := `x` ``, ``name: str = "x"``, strings with
    a prefix or triple quotes, ``name = ("x" "y")``.  A value is a chain of
    string literals and names joined by ``+``, of literals side by side, or one
    bare word; a name stands for the constant last assigned to it further up.
    A name inside its own chain ends the chain before it.
    """
    out, constants, done = [], {}, 0
    for op in OPERATOR.finditer(text):
        at = op.start()
        if at < done or text[op.end() : op.end() + 1] == "=" or text[at - 1 : at] in ("=", "!", "<", ">", ":") or text[at : at + 3] == "://":
            continue
        before = NAME_BEFORE.search(text[max(0, at - REACH) : at].rsplit("\n", 1)[-1])
        if not before:
            continue
        name, parts, end = before[1], [], op.end()
        opened = OPENED.match(text, end)
        blanks = WIDE_BLANKS if opened else BLANKS
        end = opened.end() if opened else end
        while True:
            begin = blanks.match(text, end).end()
            if literal := STRING.match(text, begin):
                group = literal.lastindex
                parts.append(Value(literal[group], literal.span(group)))
                end = literal.end()
                after = blanks.match(text, end).end()
                if text[after : after + 1] in QUOTES:
                    continue
            elif (word := WORD.match(text, begin)) and word[0] in constants and word[0] != name:
                parts.append(constants[word[0]])
                end = word.end()
            elif not parts and not opened and (bare := BARE.match(text, begin)):
                parts, end = [Value(bare[0], bare.span())], bare.end()
                break
            else:
                break
            plus = PLUS.match(text, blanks.match(text, end).end())
            if not plus:
                break
            end = plus.end()
        if parts:
            constants[name] = joined_value(parts)
            out.append((name, constants[name]))
            done = end
    return out


def name_weight(name: str) -> float:
    """How sensitive a target name is: the heaviest of its parts, less what its harmless parts take."""
    parts = [p.lower() for p in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    weight = max((SENSITIVE.get(p, 0) for p in joined), default=0)
    return weight - 2 * sum(p in HARMLESS for p in parts)


def literal_score(name: str, value: str) -> float:
    """Name weight plus what the value's length, alphabet and entropy say; 0 for placeholders and insensitive names."""
    weight = name_weight(name)
    if weight <= 0 or len(value) < 6 or PLACEHOLDER.match(value) or " " in value.strip():
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return weight + min(len(value), 32) / 16 + entropy / 2 + (classes - 1) / 2


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals whose target names make them secrets; a propagated constant is marked where it is written.

    Every value is gone through once, however many others it is part of.
    """
    found = assignments(text)
    open_values = [value for name, value in found if literal_score(name, value.text) >= SCORE]
    met, places = set(), set()
    while open_values:
        value = open_values.pop()
        if id(value) not in met:
            met.add(id(value))
            places.add(value.span)
            open_values += value.parts
    return [("literal", *span) for span in places if span and span[1] > span[0]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed, then end."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def find_secrets(df: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every whole text.

    ``spans`` lists ``kind:start:end`` of base matches and of lexed literals
    (kind ``literal``).  Null and empty texts have none.  Repeated rows come
    back as they are; columns other than doc_id and text are not read.
    """

    def per_text():
        def one(text):
            text = text or ""
            base = base_spans(text)
            n = Counter(kind for kind, _, _ in base)
            more = literal_spans(text) if any(c in text for c in ":=") else []
            return n["assign"], n["access"], n["hex"], sha256(joined(base)), joined(base + more)

        return one

    return text_rows(df, ["doc_id"], [long("n_assign"), long("n_access"), long("n_hex"), string("base_sha256"), string("spans")], per_text)
