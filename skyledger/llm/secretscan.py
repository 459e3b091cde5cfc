"""Secrets in texts: fixed patterns, and literals that source or configuration text assigns to names.

`literals` reads the pairs. A literal counts by its own look (length, variety of characters, no
placeholder) and by how sensitive the most sensitive name is that it reaches.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm.common import extended, ship, slices, table, with_columns
from skyledger.llm.literals import TYPES, assignments, reached

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "literal")
#: Words of names and how much they say that the value is secret.
NAME_WORDS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.8, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "signature": 0.5, "private": 0.6,
    "key": 0.4, "api": 0.4, "access": 0.3, "encryption": 0.5, "signing": 0.5, "client": 0.2, "salt": 0.5,
}
LEAST_SCORE = 1.2
LEAST_LENGTH = 8
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example|placeholder|none|null|true|false|todo|your[_-].*|<.*>|\$?\{.*\}|%\(.*\)s)$")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: What stands in every text with a sensitive target: such a word, and behind it and what the lexer skips
#: the end of a quoted name, a sign, a bracket or a type; or a quoted name of several words.
_WORDS = f"(?:{'|'.join(sorted(NAME_WORDS))})"
_SENSITIVE = re.compile(_WORDS + r"""[\w$.-]*+[^\w$"'`\\(){}\[\],;<>/=:+\n!|&-]*+(?:["'`\](>:=]|(?:""" + "|".join(sorted(TYPES)) + r")\b)", re.I | re.A)
_QUOTED = re.compile(r"""["'`]\s*+\]?\s*+[:=,]""")
_ANY_WORD = re.compile(_WORDS, re.I)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, leftmost and without overlap within a kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def name_score(name: str) -> float:
    """How sensitive a name is, from its words in any style of writing."""
    words = [w.lower() for w in _NAME_PARTS.findall(name)]
    score = sum(NAME_WORDS.get(w, 0.0) for w in set(words))
    return min(1.0, score)


def literal_score(literal: str) -> float:
    """How much a literal looks like a secret: its entropy per character and its kinds of characters."""
    n = len(literal)
    if n < LEAST_LENGTH or _PLACEHOLDER.match(literal) or literal.isspace():
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(map(bool, (re.search("[a-z]", literal), re.search("[A-Z]", literal), re.search("[0-9]", literal))))
    return min(1.0, entropy / 4) * (0.4 + 0.2 * kinds) * (0.5 if " " in literal else 1.0)


def literal_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals that sensitive names get, directly or through other names."""
    if not (_SENSITIVE.search(text) or _QUOTED.search(text) and _ANY_WORD.search(text)):
        return []
    found, spans = assignments(text), set()
    for own, score in zip(found, reached(found, name_score)):
        if score >= 0.6 and own.spans and score + literal_score("".join(text[a:b] for a, b in own.spans)) >= LEAST_SCORE:
            spans.update(s for s in own.spans if s[0] < s[1])
    return [("literal", a, b) for a, b in sorted(spans)]


def all_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of all kinds by start and then kind."""
    return sorted(base_spans(text) + literal_spans(text), key=lambda s: (s[1], KINDS.index(s[0])))


def scan(documents: DataFrame) -> DataFrame:
    """`documents` with `secrets`: array of (kind, start, end) by start and then kind.

    Places are code points of the whole text, ends exclusive. A null or empty text has none. Texts,
    names and literals of any length are read whole. An earlier column of the name is replaced; other columns and repeated
    rows stay.
    """
    ship(documents.sparkSession)
    documents = documents.drop("secrets")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batches):
        for part, texts in slices(batches):
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in all_spans(text)] for text in texts]
            yield with_columns(part, {"secrets": pa.array(rows, kind)})

    return documents.mapInArrow(find, extended(documents, "secrets array<struct<kind: string, start: int, end: int>>"))


def redacted(text: str, mark: str) -> str:
    parts, done = [], 0
    for _, a, b in all_spans(text):
        if a >= done:
            parts += [text[done:a], mark]
        done = max(done, b)
    return "".join(parts) + text[done:]


def redact(documents: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """`documents` with every secret in `text` replaced by the mark, overlapping ones by one mark.

    A null text stays null; all rows and other columns stay.
    """
    ship(documents.sparkSession)

    def replace(batches):
        for part, texts in slices(batches):
            at = part.schema.get_field_index("text")
            nulls = part.column(at).is_null().to_pylist()
            new = [None if null else redacted(text, mark) for null, text in zip(nulls, texts)]
            columns = list(part.columns)
            columns[at] = pa.array(new, part.schema.types[at])
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return documents.mapInArrow(replace, documents.schema)


def op4_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["kind"] != "literal")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts[:3], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("secrets").alias("spans"), counts[3])
