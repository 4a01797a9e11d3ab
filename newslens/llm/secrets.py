"""Secret scans: patterns of known shape, and literals by the names they are assigned to.

A small lexer reads lines with an assignment as source or configuration text: quoted
strings, names, operators, bare values. It yields pairs of name and literal, through ``=``,
``:``, ``:=`` and ``=>``, and follows names: a literal held by one name counts for every name
it is later assigned to or joined into. A literal is reported if the most sensitive of its
names, weighed with how random the literal looks, reaches a threshold.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame

from newslens.llm.common import map_texts

KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = re.compile(
    r"""(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)|(?P<name>[A-Za-z_$][A-Za-z0-9_$.\-]*)"""
    r"""|(?P<op>:=|=>|==|!=|<=|>=|[=:+])|(?P<other>[^\WA-Za-z_][\w$.\-]*|\S)"""
)
#: A value without quotes; the next parameter of a query string is not part of it.
BARE = re.compile(r"""(?:[^\s"'`,;(){}\[\]<>&]|&(?![A-Za-z_][A-Za-z0-9_.\-]*=))+""")
#: Words that may stand before another one in a type.
QUALIFIERS = frozenset("const mut dyn static readonly unsigned signed long short final".split())
PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: How sensitive a name is, by its parts; names that only speak about a secret weigh less.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8, "secret": 1.0, "credential": 0.9, "credentials": 0.9,
    "token": 0.9, "apikey": 1.0, "auth": 0.7, "authorization": 0.8, "bearer": 0.9, "private": 0.7, "signing": 0.6, "encryption": 0.6,
    "key": 0.6, "salt": 0.6, "pin": 0.5, "dsn": 0.6,
}
HARMLESS = frozenset("public count size length len max min limit name type url uri path file dir id ids index label field column expiry ttl timeout enabled prompt hint policy".split())
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|none|null|true|false|todo|changeme|change-me|example.*|sample.*|dummy.*|test|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s)$")
MIN_LITERAL = 6
MIN_SCORE = 0.45
FULL_BITS = 40
#: Letters at either end of a joined value that are looked at, and where counts of letters stop.
ENDS, MANY = 32, 1 << 40


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in code points."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in PART.findall(name)]
    weight = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    for pair in zip(parts, parts[1:]):
        if pair in (("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("client", "secret"), ("pass", "word")):
            weight = 1.0
    return weight * 0.3 if parts and parts[-1] in HARMLESS else weight


@dataclass
class Value:
    """What a name holds: its own literals, the values joined into it, and what judging it takes:
    length and letter counts, which add up, and both ends. Never the joined string itself."""

    spans: list[tuple[int, int]]
    parts: list[Value]
    length: int
    counts: Counter
    head: str
    tail: str
    reached: float = 0.0

    @classmethod
    def literal(cls, text: str, a: int, b: int) -> Value:
        return cls([(a, b)], [], b - a, Counter(text[a:b]), text[a : min(b, a + ENDS)], text[max(a, b - ENDS) : b])

    @classmethod
    def joined(cls, parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        whole = cls([], parts, 0, Counter(), "", "")
        for p in parts:
            whole.length = min(whole.length + p.length, MANY)
            for c, n in p.counts.items():
                whole.counts[c] = min(whole.counts[c] + n, MANY)
            whole.head = (whole.head + p.head)[:ENDS] if len(whole.head) < ENDS else whole.head
            whole.tail = (whole.tail + p.tail)[-ENDS:]
        return whole

    def is_placeholder(self) -> bool:
        if self.length <= ENDS:
            return bool(PLACEHOLDER.match(self.head))
        ends = self.head + self.tail
        return bool(PLACEHOLDER.match(ends)) and (len(set(ends.lower())) > 1 or len({c.lower() for c in self.counts}) == 1)

    def strength(self) -> float:
        """0 for what cannot be a secret, towards 1 the more bits its letters carry."""
        if self.length < MIN_LITERAL or self.is_placeholder() or any(c.isspace() for c in self.counts):
            return 0.0
        n = sum(self.counts.values())
        entropy = -sum(k / n * math.log2(k / n) for k in self.counts.values())
        classes = sum(any(f(c) for c in self.counts) for f in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in self.counts)
        return min(1.0, entropy * n / FULL_BITS) * (0.5 if classes < 2 else 1.0)


def targets(words: list[tuple[str, str]], end: int) -> list[str]:
    """Names that what stands before token ``end`` gives a value to; ``words`` are (kind, token)."""
    at = end - 1
    if at > 0 and words[at][1] in ("?", "!"):  # optional and definite members
        at -= 1
    if at < 0:
        return []
    kind, word = words[at]
    if kind != "other":
        return [word] if kind == "name" else [word[1:-1]] if kind == "text" else []
    if word != "]" or not at:
        return []
    kind, word = words[at - 1]
    inner = [] if word == "[" else [word[1:-1]] if kind == "text" else [word] if kind == "name" else []
    begin = at - 1 if word == "[" else at - 2
    if begin > 0 and words[begin][1] == ":":  # a symbol
        begin -= 1
    if begin < 0 or words[begin][1] != "[":
        return []
    if kind != "text" and begin and words[begin - 1][0] == "name":  # an array, or an entry under a variable's value
        inner.append(words[begin - 1][1])
    return inner


def is_type(words: list[tuple[str, str]]) -> bool:
    """Whether the tokens can be a type, as between ``name:`` and ``=``."""
    if len(words) == 1:
        return words[0][0] in ("name", "text")
    depth, word_before = 0, False
    for i, (kind, word) in enumerate(words):
        if word in ("[", "<", "("):
            depth += 1
        elif word in ("]", ">", ")"):
            depth -= 1
            if depth < 0:
                return False
        elif depth == 0:
            if kind == "name":
                if word_before:
                    return False
                word_before = word not in QUALIFIERS and (i == 0 or words[i - 1][1] != "'")
            elif word in ("|", "&", "*", "?", ".", "!", "'"):
                word_before = False
            else:
                return False
    return depth == 0 and bool(words)


def assignments(text: str) -> list[tuple[str, list[tuple[int, int]], list[str]]]:
    """(name, literals as (start, end), names referred to) of each assignment, in text order.

    A name may be a subscript's, or have its type between itself and the equals sign. What
    could be a type or the name itself counts as both.
    """
    found, at = [], 0
    for line in text.split("\n"):
        if "=" in line or ":" in line:
            tokens = [(m.lastgroup, m.start(), m.end()) for m in TOKEN.finditer(line)]
            words = [(kind, line[a:b]) for kind, a, b in tokens]
            ops = [i for i, (kind, _) in enumerate(words) if kind == "op"]
            typed: dict[int, int] = {}  # the place of = by that of its colon
            for colon, sign in zip(ops, ops[1:]):
                if words[colon][1] == ":" and words[sign][1] == "=" and sign + 1 < len(tokens) and is_type(words[colon + 1 : sign]):
                    # not the padding of a bare value
                    if words[sign + 1][0] == "text" or tokens[sign - 1][2] < tokens[sign][1] < tokens[sign][2] < tokens[sign + 1][1]:
                        typed[colon] = sign
            declared = {sign: colon for colon, sign in typed.items()}
            run, last = range(0), 0  # the bare value matched last, and its last token
            for i in ops:
                if words[i][1] not in ("=", ":", ":=", "=>") or i + 1 == len(tokens) or i in typed:
                    continue
                given = targets(words, i)
                if i in declared:
                    given += targets(words, declared[i])
                elif i > 1 and words[i - 1] == ("name", "string") and words[i - 2][0] == "name":
                    given.append(words[i - 2][1])
                if not given:
                    continue
                literals, names, j = [], [], i + 1
                while j < len(tokens):
                    kind, a, b = tokens[j]
                    if kind == "text":
                        literals.append((at + a + 1, at + b - 1))
                    elif kind in ("name", "other") and (a in run or (bare := BARE.match(line, a))):
                        if a not in run:
                            run, last = range(a, bare.end()), j
                            while last + 1 < len(tokens) and tokens[last + 1][1] < run.stop:
                                last += 1
                        (names.append(line[a : run.stop]) if kind == "name" else None)
                        literals.append((at + a, at + run.stop))
                        j = last
                    else:
                        break
                    if j + 1 < len(tokens) and words[j + 1][1] == "+":
                        j += 2
                    else:
                        break
                found += [(name, literals, names) for name in given]
        at += len(line) + 1
    return found


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals that reach the threshold by the most sensitive name they come to.

    A value refers to those joined into it, so constants that are joined over and over take no
    more room than the text; a value's score goes down to its parts, the last made first.
    """
    if "=" not in text and ":" not in text:
        return []
    held: dict[str, Value] = {}
    made: list[Value] = []
    for name, literals, names in assignments(text):
        parts = []
        for a, b in literals:
            known = held.get(text[a:b]) if text[a:b] in names else None
            if known is None:
                known = Value.literal(text, a, b)
                made.append(known)
            parts.append(known)
        value = Value.joined(parts)
        if len(parts) > 1:
            made.append(value)
        held[name] = value
        if own := sensitivity(name):
            # literals that are joined into one value are judged as one
            value.reached = max(value.reached, own * value.strength())
    score: dict[tuple[int, int], float] = {}
    for value in reversed(made):
        for part in value.parts:
            part.reached = max(part.reached, value.reached)
        for span in value.spans:
            score[span] = max(score.get(span, 0.0), value.reached)
    return [("literal", a, b) for (a, b), reached in score.items() if reached >= MIN_SCORE]


def spans(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the fixed patterns, and all spans, by start and kind. A literal inside a span
    of the patterns is not reported again."""
    text = text or ""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = sorted(base_spans(text), key=order)
    starts, furthest = [a for _, a, _ in base], list(accumulate((b for _, _, b in base), max))
    inside = lambda a, b: bool(at := bisect_right(starts, a)) and b <= furthest[at - 1]
    more = [x for x in literal_spans(text) if not inside(x[1], x[2])]
    return base, sorted(base + more, key=order)


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the number of spans of each pattern, base_sha256 and spans of every row.

    Spans are kind:start:end in code points, the end exclusive. Null counts as empty; an empty
    text has no spans, an empty table no rows. Rows are independent, repeated rows give repeated
    results, other columns are not looked at. Time and memory grow with a text's length, however
    many literals it has and however often they are joined.
    """

    def work(keys, texts):
        rows = []
        for base, every in map(spans, texts):
            n = Counter(k for k, _, _ in base)
            rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
        return [keys, *map(list, zip(*rows))]

    kind = df.schema[doc_id].dataType.simpleString()
    return map_texts(df, [doc_id, text], f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", lambda: work)
