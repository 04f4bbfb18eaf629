"""Secret scans: three fixed patterns, and assignment-aware lexing beyond them.

The lexer reads source and configuration syntax into (name, literal) pairs: ``name = "literal"``, ``name: literal``, JSON keys,
``:=`` and ``=>``, concatenated strings. A right side that is itself a known name takes that name's literal (constants are
propagated in text order), so a harmless variable whose value later goes into a password is found where it is written. A literal is
reported when its target's name and its own looks score high enough together. Every text is one row of a map; nothing is shuffled."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "named")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}

PAIR = re.compile(r"""(?<![\w.$-])(?:"([\w.$-]++)"|'([\w.$-]++)'|([A-Za-z_$][\w.$-]*+))[ \t]*+(?::=|=>|=(?!=)|:(?![:/]))[ \t]*+""")
STRING = re.compile(r'''"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)\'''')
NAME = re.compile(r"\$?\{?([A-Za-z_][\w.-]*+)\}?")
BARE = re.compile(r"""[^\s"'<>,;{}()\[\]]++""")
PLUS = re.compile(r"(?:[ \t\r\n]|\\\r?\n)*+\+(?:[ \t\r\n]|\\\r?\n)*+")     # line breaks on either side, a backslash before them or not
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

# How much a word of a target's name speaks for a secret, and against one.
SENSITIVE = {
    "password": 4, "passwd": 4, "passphrase": 4, "pwd": 4, "pass": 2, "secret": 4, "token": 3, "apikey": 4, "credential": 3,
    "credentials": 3, "bearer": 3, "auth": 2, "key": 2, "private": 2, "access": 1, "api": 1, "signing": 1, "encryption": 1, "pin": 1,
}
HARMLESS = {"public": 3, "count": 3, "length": 3, "size": 3, "limit": 3, "file": 3, "path": 3, "url": 3, "type": 3, "field": 3, "primary": 3, "foreign": 3}
PLACEHOLDER = re.compile(r"change.?me|example|placeholder|your|dummy|x{4,}|\*{3,}", re.I)
NOTHING = re.compile(r"^(?:none|null|true|false|undefined)$", re.I)
EDGE = 16      # characters of a literal's ends that are kept: no placeholder needs more
LEAST = 5      # of both scores together
HEXES = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))


def name_score(name: str) -> int:
    words = [w.lower() for w in PARTS.findall(name)]
    return sum(SENSITIVE.get(w, 0) for w in words) - sum(HARMLESS.get(w, 0) for w in words)


class Value:
    """A literal as its own parts and the constants it refers to. What its score needs is kept, its text is not: a chain of constants
    stays linear in memory, however often it is built upon."""

    __slots__ = ("length", "chars", "held", "head", "tail", "parts")

    def __init__(self):
        self.length, self.chars, self.held, self.head, self.tail = 0, Counter(), False, "", ""
        self.parts: tuple[list, list] = [], []      # spans, and the parts of constants

    def _append(self, length, chars, held, head, tail):
        self.held = self.held or held or bool(PLACEHOLDER.search(self.tail + head))
        self.head = self.head if self.length >= EDGE else (self.head + head)[:EDGE]
        self.tail = (self.tail + tail)[-EDGE:] if length < EDGE else tail
        self.length += length
        self.chars.update(chars)

    def add_text(self, text: str, span: tuple[int, int]):
        self._append(len(text), text, bool(PLACEHOLDER.search(text)), text[:EDGE], text[-EDGE:])
        self.parts[0].append(span)

    def add(self, other: Value):
        self._append(other.length, other.chars, other.held, other.head, other.tail)
        self.parts[1].append(other.parts)

    def score(self) -> int:
        """Length, mixture and entropy speak for a secret; spaces and placeholders against."""
        if self.length < 8 or self.held or self.length <= EDGE and NOTHING.search(self.head) or any(c.isspace() for c in self.chars):
            return -9
        text = "".join(self.chars)
        classes = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
        entropy = -sum(n / self.length * math.log2(n / self.length) for n in self.chars.values() if n / self.length)
        return 1 + (classes > 1) + (classes > 2) + (entropy > 3)


def pairs(text: str):
    """(name, value) of every assignment, constants propagated in text order."""
    known: dict[str, Value] = {}
    at = 0
    while m := PAIR.search(text, at):
        at = m.end()
        name, value = m[1] or m[2] or m[3], Value()
        while True:
            if s := STRING.match(text, at):
                group = 1 if s[1] is not None else 2
                value.add_text(s[group], s.span(group))
                at = s.end()
            elif (r := NAME.match(text, at)) and (short := r[1].rpartition(".")[2]) in known:
                value.add(known[short])
                at = r.end()
            else:
                break
            if not (p := PLUS.match(text, at)):
                break
            at = p.end()
            if "\n" in p[0] and PAIR.match(text, at):     # an added line of a diff, say: the next assignment and no part
                break
        if not any(value.parts):
            if not (b := BARE.match(text, m.end())):
                continue
            value.add_text(b[0], b.span())
            at = m.end() if PAIR.match(text, m.end()) else b.end()
        known[name.rpartition(".")[2]] = value
        yield name, value


def base_spans(text: str) -> list[tuple[int, str, int, tuple[int, int]]]:
    """(start, kind, end, span of the secret itself) of the three base patterns, leftmost and non-overlapping for each."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "apikey" in low or "api_key" in low:
        out += [(m.start(), "assign", m.end(), m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= SHORTEST["access"]]
    if b"h" * SHORTEST["hex"] in text.encode("utf-8", "surrogatepass").translate(HEXES):
        out += [(m.start(), "hex", m.end(), m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= SHORTEST["hex"]]
    return out


def named_spans(text: str) -> list[tuple[int, str, int, tuple[int, int]]]:
    """Literals whose target's name marks them, each once."""
    if ":" not in text and "=" not in text:
        return []
    found, seen = set(), set()
    held = []      # keeps parts alive, so that their identities stay apart
    for name, value in pairs(text):
        n = name_score(name)
        if n >= 3 and n + value.score() >= LEAST:
            todo = [value.parts]
            while todo:
                v = todo.pop()
                if id(v) not in seen:
                    seen.add(id(v))
                    held.append(v)
                    found.update(s for s in v[0] if s[1] > s[0])
                    todo += v[1]
    return [(a, "named", b, (a, b)) for a, b in found]


def spelled(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b, _ in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_named, base, spans) for each row: counts, and spans as ``kind:start:end`` in code
    points, end exclusive, by start and kind; ``base`` has those of the fixed patterns, ``spans`` all. A null text is empty."""
    def run(batches):
        for batch in batches:
            rows = []
            for t in batch.column(1):
                t = t.as_py() or ""
                base = base_spans(t)
                named = named_spans(t)
                n = Counter(s[1] for s in base)
                rows.append((n["assign"], n["access"], n["hex"], len(named), spelled(base), spelled(base + named)))
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                                  ["id", "n_assign", "n_access", "n_hex", "n_named", "base", "spans"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("t")).mapInArrow(
        run, f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_named bigint, base string, spans string").withColumnRenamed("id", id)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with every secret found replaced; what overlaps is replaced once."""
    spans = sorted(s[3] for s in base_spans(text) + named_spans(text))
    if not spans:
        return text
    out, at, end = [], 0, -1
    for a, b in spans:
        if a >= end:
            out += [text[at:a], mark]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", chars: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with its secrets replaced by ``mark``, row for row; where the table has a column ``chars``, it is counted anew for
    changed rows. Null texts stay null."""
    at = docs.columns.index(text)
    size = docs.columns.index(chars) if chars in docs.columns else None

    def run(batches):
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [None if t is None else redacted(t, mark) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if size is not None:
                sizes = columns[size].to_pylist()
                columns[size] = pa.array([n if o == w else len(w) for o, w, n in zip(old, new, sizes)], columns[size].type)
            yield pa.record_batch(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
