"""Turtle as statements: predicate and object lists, blank nodes, collections, typed and tagged literals."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd

_TOKEN = re.compile(
    r'#[^\n]*|(?P<iri><[^<>\s]*>)|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*""")|(?P<text>"(?:[^"\\\n]|\\.)*")'
    r"|(?P<type>\^\^)|(?P<tag>@[A-Za-z][\w-]*)|(?P<mark>[\[\]();,])|(?P<name>[^\s\[\]();,\"<>#^][^\s\[\]();,\"<>^]*)|(?P<bad>\S)",
    re.S,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_PLAIN = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}
_NUMBERS = [("xsd:integer", re.compile(r"[+-]?\d+")), ("xsd:decimal", re.compile(r"[+-]?\d*\.\d+")), ("xsd:double", re.compile(r"[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+")), ("xsd:boolean", re.compile("true|false"))]

Row = tuple[str, str, str, str]


def _unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _PLAIN.get(m[1], m[1]), text)


def _tokens(text: str) -> Iterator[tuple[str, str]]:
    for m in _TOKEN.finditer(text):
        kind, value = m.lastgroup, m[0]
        if kind == "name" and value.endswith("."):
            if len(value) > 1:
                yield "name", value[:-1]
            yield "mark", "."
        elif kind:
            yield kind, value
    yield "mark", "."


class _Reader:
    def __init__(self, record: str, short: Callable[[str], str]):
        self.tokens, self.short, self.rows = list(_tokens(record)), short, []
        self.at = self.blanks = 0
        self.own = hashlib.md5(record.encode()).hexdigest()[:16]

    def next(self) -> tuple[str, str]:
        if self.at == len(self.tokens):
            raise ValueError("Turtle: a statement doesn't end")
        self.at += 1
        return self.tokens[self.at - 1]

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else ""

    def blank(self) -> str:
        self.blanks += 1
        return f"_:{self.own}{self.blanks}"

    def collection(self) -> str:
        items = []
        while self.peek() != ")":
            items.append(self.term())
        self.next()
        head = "rdf:nil"
        for value, kind in reversed(items):
            node = self.blank()
            self.rows += [(node, "rdf:first", value, kind), (node, "rdf:rest", head, "_IRI")]
            head = node
        return head

    def term(self) -> tuple[str, str]:
        """An object and its datatype."""
        kind, value = self.next()
        if kind in ("text", "long"):
            cut = 3 if kind == "long" else 1
            text, datatype = _unescaped(value[cut:-cut]), "xsd:string"
            follows = self.tokens[self.at][0]
            if follows == "type":
                self.next()
                datatype = self.node(*self.next())
            elif follows == "tag":
                datatype = self.next()[1]
            return text, datatype
        if kind == "name":
            number = next((t for t, p in _NUMBERS if p.fullmatch(value)), None)
            if number:
                return value, number
        return self.node(kind, value), "_IRI"

    def node(self, kind: str, value: str) -> str:
        if kind == "iri":
            return self.short(value)
        if kind == "name":
            return value
        if value == "(":
            return self.collection()
        if value == "[":
            node = self.blank()
            if self.peek() != "]":
                self.pairs(node, "]")
            self.next()
            return node
        raise ValueError(f"Turtle: {value!r} where a term should be")

    def pairs(self, subject: str, end: str) -> None:
        while self.peek() != end:
            predicate = self.node(*self.next())
            while True:
                value, kind = self.term()
                self.rows.append((subject, "rdf:type" if predicate == "a" else predicate, value, kind))
                if self.peek() != ",":
                    break
                self.next()
            while self.peek() == ";":
                self.next()
            if self.peek() != end and self.tokens[self.at - 1][1] != ";":
                raise ValueError(f"Turtle: {self.peek()!r} after an object")

    def read(self) -> list[Row]:
        while self.at < len(self.tokens):
            kind, value = self.next()
            if value == "." and kind == "mark":
                continue
            if kind == "tag" or (kind == "name" and value.upper() in ("PREFIX", "BASE")):
                while self.next()[0] != "iri":
                    pass
                continue
            bare = value == "["
            subject = self.node(kind, value)
            if self.peek() != "." or not bare:
                self.pairs(subject, ".")
            self.next()
        return self.rows


def parse(record: str, prefixes: dict[str, str] | None = None) -> list[Row]:
    """(subject, predicate, object, datatype) of whole statements. Prefixed names stay as they are; an IRI in brackets is
    shortened by the longest of ``prefixes`` that starts it, else it keeps its brackets. Literals without a type are
    xsd:string, tagged ones have the tag ('@en') as datatype. Raises ValueError for what isn't Turtle or doesn't end."""
    bases = sorted(((iri, p) for p, iri in (prefixes or {}).items()), key=lambda x: -len(x[0]))

    def short(iri: str) -> str:
        found = next(((base, p) for base, p in bases if iri[1:].startswith(base)), None)
        return f"{found[1]}:{iri[1 + len(found[0]) : -1]}" if found else iri

    return _Reader(record, short).read()


def parser(prefixes: dict[str, str] | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([r for text in batch["value"] for r in parse(text, prefixes)], columns=["subject", "predicate", "object", "datatype"])

    return run
