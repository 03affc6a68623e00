"""Secrets in texts: fixed patterns, and literals that reach a sensitive name through assignments.

The lexer reads ``name = literal`` and ``name: literal`` pairs of source and configuration syntax, follows names that
are assigned to other names, before or after, and scores every literal by the names that it reaches.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame

from tillwise.llm import common

#: The base patterns, in the order in which spans that begin together are listed.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "literal")

#: How much a part of a name says that its value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 1.0,
    "credentials": 1.0, "private": 0.5, "access": 0.3, "auth": 0.6, "authorization": 0.8, "bearer": 0.9, "key": 0.4, "signature": 0.5,
    "client": 0.1, "api": 0.3, "session": 0.3, "cookie": 0.5, "salt": 0.5, "contraseña": 1.0, "passwort": 1.0, "kennwort": 1.0,
}
#: Literals that stand for a value and are none.
PLACEHOLDERS = re.compile(r"(?i)^(none|null|true|false|changeme|example|placeholder|your[_-].*|<.*>|\$\{?.*|\*+|x+|\.+)$")
#: From this product of the name's and the literal's score on, a literal counts as a secret.
THRESHOLD = 0.5

_OPERATOR = re.compile(r":=|=>|[:=]")
_QUOTED = re.compile(
    r'''[ \t]*[rbufRBUF]{0,2}(?:"""((?:[^\\]|\\.)*?)"""|\'\'\'((?:[^\\]|\\.)*?)\'\'\'|`((?:[^`\\]|\\.)*)`'''
    r'''|"((?:[^"\\\n]|\\.)*)"|\'((?:[^\'\\\n]|\\.)*)\')''',
    re.DOTALL,
)
_BARE = re.compile(r"[ \t]*([^\s\"'`,;(){}\[\]#]+)")
_IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.]*")
_PART = re.compile(r"[A-Z]?[a-zà-ÿ]+|[A-Z]+(?![a-zà-ÿ])")
#: What stands before and behind a pair that fills its line, as in configuration files.
_LINE_BEFORE = re.compile(r"""(?:^|\n)[ \t]*(?:(?:export|set|ENV)[ \t]+|-[ \t]+)?["']?$""")
_LINE_BEHIND = re.compile(r"[ \t]*[,;]?[ \t]*(?:#[^\n]*)?(?:\r?\n|$)")
_INDENT = 128


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in code points."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def name_score(name: str) -> float:
    """0 to 1: the strongest parts of a name, as camel case, dots, dashes and underscores divide it."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = [a + b for a, b in zip(parts, parts[1:])]
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


def literal_score(value: str) -> float:
    """0 to 1: how much a literal looks like a secret by its length and the variety of its signs."""
    if len(value) < 6 or PLACEHOLDERS.match(value):
        return 0.0
    n = len(value)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return min(1.0, bits / 2.5)


def name_before(text: str, end: int, floor: int) -> tuple[str, int]:
    """The whole name that ends before ``end``, without quotes and brackets around it, and its start."""
    while end > floor and text[end - 1] in "+ \t":
        end -= 1
    for signs in ("\"'", "]", "\"'"):
        if end > floor and text[end - 1] in signs:
            end -= 1
    start = end
    while start > floor and (text[start - 1].isalnum() or text[start - 1] in "_$.-"):
        start -= 1
    while start < end and not (text[start].isalpha() or text[start] in "_$"):
        start += 1
    return text[start:end], start


def pairs(text: str) -> list[tuple[str, str, int, int, bool | None]]:
    """(name, value, start, end, literal) of every assignment; a value that isn't a literal is the name it copies.

    ``literal`` is None for a bare word that fills its line with its name: a name if the text assigns it, else a literal.
    """
    out, last = [], 0
    for op in _OPERATOR.finditer(text):
        begin, end = op.span()
        if begin < last or text[end : end + 1] == "=" or (op[0] == ":" and text[end : end + 2] == "//"):
            continue  # within the last literal, a comparison, an address
        if op[0] == "=" and text[begin - 1 : begin] in tuple("!<>=") and begin:
            continue
        name, at = name_before(text, begin, last)
        if not name:
            continue
        quoted = _QUOTED.match(text, op.end())
        if quoted:
            group = quoted.lastindex
            out.append((name, quoted[group], *quoted.span(group), True))
            last = quoted.end()
        elif bare := _BARE.match(text, op.end()):
            value = bare[1].rstrip(".")
            span = (bare.start(1), bare.start(1) + len(value))
            if _IDENTIFIER.fullmatch(value) and not any(c.isdigit() for c in value):
                before = text[max(0, at - _INDENT) : at]
                filled = _LINE_BEHIND.match(text, bare.end()) and (at <= _INDENT or "\n" in before) and _LINE_BEFORE.search(before)
                out.append((name, value, *span, None if filled else False))
            else:
                # a name with digits copies what it names, if the text assigns it
                out.append((name, value, *span, True if not _IDENTIFIER.fullmatch(value) else None))
                last = span[1]
    return out


def lexed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the literals whose score reaches ``THRESHOLD`` under the most telling name that they reach.

    A bare name stands for its last assignment before, or, where there is none, for all that follow.
    """
    if ":" not in text and "=" not in text:
        return []
    found = pairs(text)
    scores = [name_score(p[0]) for p in found]
    if not any(scores):
        return []
    places: defaultdict[str, list[int]] = defaultdict(list)
    for i, (name, *_) in enumerate(found):
        places[name].append(i)
    stands: dict[int | str, list] = {}  # for an assignment: what its value names; for a name: all its assignments
    for i, (name, value, _, _, literal) in enumerate(found):
        if not literal and value in places:
            before = bisect_left(places[value], i)
            if before:
                stands[i] = [places[value][before - 1]]
            elif value != name:
                stands[i], stands[value] = [value], places[value]
    best: dict[int | str, float] = {}
    for i in sorted(range(len(found)), key=lambda i: -scores[i]):  # the highest score that reaches a place comes first
        reached = [i]
        while reached:
            x = reached.pop()
            if x not in best:
                best[x] = scores[i]
                reached += stands.get(x, ())
    return [
        ("literal", start, end)
        for i, (_, value, start, end, literal) in enumerate(found)
        if (literal or literal is None and i not in stands) and best[i] * literal_score(value) >= THRESHOLD
    ]


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans, by start and then kind as listed in ``KINDS``."""
    return sorted(base_spans(text) + lexed_spans(text), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, a digest of the base spans, and all spans of each text.

    Every row gives a row; null and empty texts have no spans (the digest is that of no bytes). Spans count code points,
    the end is exclusive.
    """

    def make():
        def of(texts: list[bytes]) -> list:
            columns = [[], [], [], [], []]
            for raw in texts:
                spans = scan(raw.decode())
                base = [s for s in spans if s[0] != "literal"]
                kinds = Counter(s[0] for s in base)
                for column, kind in zip(columns[:3], KINDS):
                    column.append(kinds[kind])
                columns[3].append(hashlib.sha256(joined(base).encode()).hexdigest())
                columns[4].append(joined(spans))
            return [pa.array(c, pa.int64()) for c in columns[:3]] + [pa.array(c, pa.string()) for c in columns[3:]]

        return of

    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return common.over_texts(common.documents(docs), make, schema)


def mask(text: str, sign: str = "[secret]") -> str:
    """The text with each secret replaced; of an assignment only its value goes, spans that overlap go as one."""
    holes = []
    for kind, start, end in scan(text):
        holes.append((ASSIGN.match(text, start).start(2) if kind == "assign" else start, end))
    out, last = [], 0
    for start, end in sorted(holes):
        if start >= last:
            out += [text[last:start], sign]
        last = max(last, end)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced in ``text``, and ``n_chars`` counted anew where there is such a column.

    Every row stays, with all its columns; null texts stay null.
    """
    return common.change_texts(docs, lambda: lambda texts: [mask(t.decode()) for t in texts])
