"""Name-literal pairs of source and configuration text: a lexer, an assignment list, constants carried on.

The lexer cuts a text into strings (plain, raw, byte, formatted, of several lines), names and signs. The
parser reads what each name gets: strings, strings joined by `+` or by standing side by side, another
name, or something that says nothing (a call, a number). It knows declared types, values in brackets
or on the next line, setters, keys beside values in XML attributes, and values below a key in YAML or
JSON. A literal is as sensitive as the most sensitive name that it reaches over any number of names,
whether they are defined before or after their use.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable
from dataclasses import dataclass, field

Span = tuple[int, int]

#: Nothing that a quantifier took is given back, and an escape outside a string is a token, so the time
#: stays linear.
_TOKEN = re.compile(
    r"""
    (?P<long>(?<!\w)[rbufRBUF]{0,2}(?:\"{3}(?P<l1>.*?)\"{3}|'{3}(?P<l2>.*?)'{3}))
  | (?P<string>(?<!\w)[rbufRBUF]{0,2}(?:
        "(?P<s1>[^"\\\n]*+(?:\\.[^"\\\n]*+)*+)" | '(?P<s2>[^'\\\n]*+(?:\\.[^'\\\n]*+)*+)' | `(?P<s3>[^`\\]*+(?:\\.[^`\\]*+)*+)`))
  | (?P<escape>\\.)
  | (?P<line>\n[ \t]*+(?:-[ \t]++)?)
  | (?P<name>[A-Za-z_$][\w$]*+(?:(?:\.|-(?!>))[\w$]++)*+)
  | (?P<number>[0-9][\w.]*+)
  | (?P<other>[=!<>]==?|:=|=>|->|::|\|\||&&)
  | (?P<sign>[=:+(){}\[\],;<>/])
    """,
    re.X | re.S | re.A,
)
_BARE = re.compile(r"""[^\s"'`,;#(){}\[\]<>]++""")
_PATH = re.compile(r"[A-Za-z_$][\w$]*+(?:(?:\.|->|::)[A-Za-z_$][\w$]*+)*+", re.A)
_ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)>([^<>\s]++)</", re.A)
_SETTER = re.compile(r"(?:.*[.>:])?(?:set|with|put|add)_?(\w*)", re.A | re.I)
#: Names that say nothing on their own; the key above or beside them counts.
NEUTRAL = {"value", "val", "data", "string", "text", "content", "literal", "raw", "default"}
#: Names of the part of an entry that holds its key.
KEYS = {"key", "name", "id"}
#: Types that stand between a name and its sign.
TYPES = {"string", "str", "char", "text", "bytes", "const", "auto", "any"}


@dataclass
class Assignment:
    """What a name gets at a place: the spans of its own literals, and other names."""

    name: str
    at: int
    spans: list[Span] = field(default_factory=list)
    names: list[str] = field(default_factory=list)


def _bare_name(name: str) -> str:
    return re.sub(r"^(?:self|this)\.", "", name.strip("$"))


class _Parser:
    def __init__(self, text: str):
        self.text = text
        self.kinds, self.texts, self.spans, self.starts = [], [], [], []
        for m in _TOKEN.finditer(text):
            kind, inner = m.lastgroup, 0
            if kind in ("long", "string"):
                kind, inner = "string", next(g for g in ("l1", "l2", "s1", "s2", "s3") if m[g] is not None)
            self.kinds.append(kind)
            self.texts.append(m[inner])
            self.spans.append(m.span(inner))
            self.starts.append(m.start())
        self.closed = self.brackets()
        self.found: list[Assignment] = []

    def brackets(self) -> dict[int, int]:
        """The closing token of each square or angle bracket that is closed on its line."""
        open_: list[int] = []
        out = {}
        for k, kind in enumerate(self.kinds):
            if kind == "line":
                open_.clear()
            elif self.is_(k, "[", "<"):
                open_.append(k)
            elif open_ and (self.is_(k, "]") and self.texts[open_[-1]] == "[" or self.is_(k, ">") and self.texts[open_[-1]] == "<"):
                out[open_.pop()] = k
        return out

    def is_(self, k: int, *signs: str) -> bool:
        return 0 <= k < len(self.kinds) and self.kinds[k] in ("sign", "other") and self.texts[k] in signs

    def kind(self, k: int) -> str:
        return self.kinds[k] if 0 <= k < len(self.kinds) else "end"

    def run(self) -> list[Assignment]:
        above: list[tuple[int, str]] = []  # keys by the indentation of their lines
        inside: list[str] = []  # keys of the open brackets
        waiting, beside, indent, k = "", "", 0, 0
        while k < len(self.kinds):
            kind, said = self.kinds[k], self.texts[k]
            if kind == "line":
                indent, beside = len(said) - 1, "" if not inside else beside
                while above and above[-1][0] >= indent and self.kind(k + 1) != "line":
                    above.pop()
            elif self.is_(k, "{"):
                inside.append(waiting)
                waiting = ""
            elif self.is_(k, "}"):
                beside = ""
                if inside:
                    inside.pop()
            elif kind in ("name", "string"):
                sign = self.sign_after(k)
                if sign:
                    name, own = self.target(k), said.lower()
                    outer = above[-1][1] if above else inside[-1] if inside else ""
                    if own in NEUTRAL and (beside or outer):
                        name = beside or outer
                    value = Assignment(name, self.starts[k])
                    end = self.value(sign, value)
                    if own in KEYS and len(value.spans) == 1:
                        beside = self.text[slice(*value.spans[0])]
                    if end == sign + 1 and self.kind(end) == "line":
                        above.append((indent, name))
                    waiting = name if self.is_(end, "{") else ""
                    self.found.append(value)
                    k = max(end, sign + 1)
                    continue
                if kind == "name" and self.is_(k + 1, "("):
                    self.setter(k)
            k += 1
        self.found += [Assignment(m[1], m.start(), [m.span(2)]) for m in _ELEMENT.finditer(self.text)]
        return self.found

    def target(self, k: int) -> str:
        """The name that a sign behind token k gives a value to; a type may stand between them."""
        if self.texts[k].lower() in TYPES and self.kind(k - 1) == "name" and self.kinds[k] == "name":
            k -= 1
        return _bare_name(self.texts[k])

    def sign_after(self, k: int) -> int:
        """The token of the sign that assigns to token k, or 0."""
        at = k + 1
        if self.is_(at, "]"):
            at += 1
        if self.is_(at, "=", ":=", "=>"):
            return at
        if not self.is_(at, ":") or self.is_(at + 1, "/"):
            return 0
        if self.kind(at + 1) == "name":  # perhaps a declared type before the sign
            end = self.closed.get(at + 2, at + 1) + 1
            if self.is_(end, "="):
                return end
        return at

    def value(self, sign: int, into: Assignment) -> int:
        """Reads the value behind a sign; the token after it."""
        k, depth = sign + 1, 0
        while self.is_(k, "(") or self.kind(k) == "escape" or self.kind(k) == "line" and (depth or self.next_line(sign, k)):
            depth += self.is_(k, "(")
            k += 1
        first = True
        while True:
            kind = self.kind(k)
            if kind == "string":
                into.spans.append(self.spans[k])
                k += 1
            elif kind in ("name", "number") or first and not depth and self.starts_bare(sign, k):
                k, more = self.unquoted(sign, k, into, first and not depth)
                if not more:
                    return k
            else:
                return k
            first = False
            while depth and (self.kind(k) == "line" or self.is_(k, ")")):
                depth -= self.is_(k, ")")
                k += 1
            if self.is_(k, "+"):
                k += 1
                while self.kind(k) in ("line", "escape"):
                    k += 1
            elif self.kind(k) != "string" or self.is_(sign, ":") and not depth or self.starts[k] - self.spans[k - 1][1] > 40 and not depth:
                return k

    def next_line(self, sign: int, k: int) -> bool:
        """Whether the line after the sign holds the value: a string that is no key itself."""
        return self.kind(k + 1) == "string" and not self.is_(k + 2, ":", "=", "=>")

    def starts_bare(self, sign: int, k: int) -> bool:
        gap = self.text[self.spans[sign][1] :][:1] if k >= len(self.starts) else self.text[self.spans[sign][1] : self.starts[k]]
        return bool(gap.strip()) or self.is_(k, "/", "+")

    def unquoted(self, sign: int, k: int, into: Assignment, alone: bool) -> tuple[int, bool]:
        """A name, a call or an unquoted literal from token k on: the token after it, and whether more may follow."""
        if self.kind(k) == "name" and self.is_(k + 1, "=", ":="):  # gets the same value in turn
            into.names.append(_bare_name(self.texts[k]))
            return k, False
        at = self.spans[sign][1] if alone else self.starts[k]
        while self.text[at : at + 1] in (" ", "\t"):
            at += 1
        m = _BARE.match(self.text, at)
        if not m:
            return k + 1, False
        end = bisect.bisect_left(self.starts, m.end())
        word = m[0]
        path = _PATH.match(word)
        if self.text[m.end() : m.end() + 1] in ("(", "[", "{") or self.text[m.end() : m.end() + 1] == "<" and path:
            return end, False  # a call or an entry
        if path and path.end() == len(word) and ("." in word or "::" in word or "->" in word or not re.search("[0-9]", word)):
            into.names.append(_bare_name(word))
            return end, True
        if not alone or re.fullmatch(r"[\d.,]+", word) or word.isalpha() or word.startswith(("$", "&", "@", "%")):
            return end, False
        into.spans.append(m.span())
        if path and path.end() == len(word):
            into.names.append(_bare_name(word))
        return end, False

    def setter(self, k: int) -> None:
        """`setName("literal")` and `put("name", "literal")`."""
        m = _SETTER.fullmatch(self.texts[k])
        if not m or self.kind(k + 2) != "string":
            return
        if self.is_(k + 3, ",") and self.kind(k + 4) == "string" and self.is_(k + 5, ")", ","):
            self.found.append(Assignment(self.texts[k + 2], self.starts[k], [self.spans[k + 4]]))
        elif m[1] and self.is_(k + 3, ")"):
            self.found.append(Assignment(m[1], self.starts[k], [self.spans[k + 2]]))


def assignments(text: str) -> list[Assignment]:
    """What the names of a text get, in the order of the text but for XML elements, which come last."""
    return _Parser(text).run()


def reached(found: list[Assignment], score: Callable[[str], float]) -> list[float]:
    """For each assignment the largest score of a name that its value reaches, its own included.

    A name stands for what it was given last before its use, or first after it.
    """
    places: dict[str, list[tuple[int, int]]] = {}
    for i, a in enumerate(found):
        places.setdefault(a.name, []).append((a.at, i))
    for own in places.values():
        own.sort()
    best = [score(a.name) for a in found]
    done = [False] * len(found)
    for start in sorted(range(len(found)), key=lambda i: -best[i]):
        todo = [start]
        while todo:
            i = todo.pop()
            if done[i]:
                continue
            done[i] = True
            best[i] = max(best[i], best[start])
            for name in found[i].names:
                if own := places.get(name):
                    at = bisect.bisect_left(own, (found[i].at, -1))
                    todo.append(own[max(at - 1, 0)][1])
    return best
