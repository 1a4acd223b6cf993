"""Secret scans: base patterns, and an assignment-aware lexer over source and configuration text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _kernel, _store

KINDS = ("assign", "access", "hex", "literal")

# The base patterns.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Whatever holds a span of any kind holds this: an assignment sign, the access mark, or a hex run.
NEEDED = "[:=<]|AKIA|[0-9a-f]{%d}" % LEAST["hex"]

#: Weights of the parts of a target's name; from SCORE_LEAST with the literal's own score on, it is a secret.
NAME_PARTS = {"password": 3, "passwd": 3, "passphrase": 3, "pwd": 3, "pass": 2, "secret": 3, "token": 2, "apikey": 3, "credential": 3, "credentials": 3, "auth": 1, "bearer": 2, "private": 1, "access": 1, "api": 1, "key": 2, "dsn": 1, "signing": 1, "encryption": 1}
SCORE_LEAST = 5
LITERAL_LEAST = 8
_DULL = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me.*|example.*|your[_-].*|<.*>|\$\{.*\}|%\(.*\)s|null|none|true|false)$")
# A literal in triple quotes without a blank inside, or in quotes on one line; a letter or two may mark its kind. An escaped quote begins none.
_QUOTED = r"""(?:(?<![\w$])[bBrRuUfFL]{1,2}(?=["']))?(?<!\\)(?:\"{3}\s*+(?:[^"\\\s]|\\.)++\s*+\"{3}|'{3}\s*+(?:[^'\\\s]|\\.)++\s*+'{3}|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*`)"""
#: One token: a quoted literal, a name, an assignment sign, a line's end, or another sign.
_TOKEN = re.compile(rf"""(?P<text>{_QUOTED})|(?P<name>[A-Za-z_$][\w$-]*(?:\.[A-Za-z_$][\w$-]*)*)|(?P<set>:=|=>|=(?!=)|:(?!:))|(?P<end>[\n;,])|(?P<gap>[ \t]+)|(?P<other>[^\s])""", re.ASCII)
#: What joins a literal to the next: a sign of joining, a line's end marked as no end, or only a blank.
_JOINED = re.compile(rf"""[ \t]*+(?:(?:\+|\.\.?|&|\|\||\\(?=\r?\n))\s*+)?(?P<text>{_QUOTED})""", re.ASCII)
#: An element that holds one word, and a tag whose attributes name a value.
_ELEMENT = re.compile(r"<([A-Za-z_][\w.:-]*)(?:\s[^<>]*)?>\s*+(?:<!\[CDATA\[)?([^<>\s\]]+)(?:\]\]>)?\s*+</\1\s*>", re.ASCII)
_TAG = re.compile(r"<[A-Za-z_][\w.:-]*\s([^<>]*)>", re.ASCII)
_NAMED = re.compile(r"""(?:^|\s)(?:key|name|id)\s*=\s*["']([\w$.:-]+)["']""", re.ASCII | re.I)
_VALUE = re.compile(r"""(?:^|\s)value\s*=\s*(?:"([^"]*)"|'([^']*)')""", re.ASCII | re.I)
#: An unquoted value, after its sign: up to a blank, a quote, a comment or the line's end. Of a longer run its first 4096 characters, so that time stays in proportion.
_BARE = re.compile(r"""[^\s"'`#][^\s"'`]{0,4095}""")
#: A plain name, which in code stands for something else; a member of something; a call or an index.
_PLAIN = re.compile(r"[A-Za-z_$][A-Za-z_$.-]*")
_MEMBER = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)+", re.ASCII)
_CALL = re.compile(r"(?:new |await |not )?[A-Za-z_$][\w$.]*(?:::[\w$]+)*[(\[{]|[(\[{]", re.ASCII)
_LAST = re.compile(r"[ \t]*(?:(?<=[ \t])(?:#|//|;|--).*)?(?=\r?\n|\Z)")
_FIRST = re.compile(r"[ \t]*(?:-[ \t]+|export[ \t]+|set[ \t]+)?[\"']?[\w$.-]+[\"']?[ \t]*", re.ASCII)
#: A type between a name and its assignment: name: type = value.
_TYPED = re.compile(r":[ \t]*&?(?:'?\w+[ \t]+)?[A-Za-z_$][\w$.]*(?:\[[^\]\n=]{0,200}\]|<[^>\n=]{0,200}>){0,4}[?!]?(?:[ \t]*\|[ \t]*[\w$.]+){0,20}[ \t]*=(?![=>])", re.ASCII)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> int:
    """How strongly the parts of a target's name (snake, kebab, camel or dotted) speak of a secret."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = sum(NAME_PARTS[a + b] for a, b in zip(parts, parts[1:], strict=False) if a + b in NAME_PARTS)
    return joined + sum(NAME_PARTS.get(p, 0) for p in parts)


def literal_score(value: str) -> int:
    """0 for short, dull or spaced text; else 1 and more for mixed characters and a high entropy."""
    if len(value) < LITERAL_LEAST or _DULL.match(value) or re.search(r"\s", value):
        return 0
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())
    return 1 + (classes >= 2) + (classes >= 3) + (entropy >= 3) + (len(value) >= 20)


def _bare(text: str, sign: re.Match[str]) -> tuple[int, int] | None:
    """The span of the unquoted value after an assignment sign; None where it is code rather than a value.

    A call, an index or a bracket is code. A plain name or a member is a value
    only in a line of configuration: name=value or name: value and nothing else.
    """
    at = sign.end()
    while at < len(text) and text[at] in " \t":
        at += 1
    m = _BARE.match(text, at)
    if not m or _CALL.match(text, at):
        return None
    end = m.end()
    spare = {c: text.count(c, at, end) - text.count(o, at, end) for o, c in ("()", "[]", "{}")}
    while end > at and (text[end - 1] in ",;" or spare.get(text[end - 1], 0) > 0):
        end -= 1
        if text[end] in spare:
            spare[text[end]] -= 1
    value = text[at:end]
    if _PLAIN.fullmatch(value) or _MEMBER.fullmatch(value):
        line = text.rfind("\n", max(0, sign.start() - 400), sign.start()) + 1  # a name before it is shorter
        tight = sign[0] == ":" or (sign[0] == "=" and at == sign.end() and text[sign.start() - 1] not in " \t")
        if not tight or end != m.end() or not _FIRST.fullmatch(text, line, sign.start()) or not _LAST.match(text, end):
            return None
    return at, end


def _inside(text: str, start: int, end: int) -> tuple[int, int]:
    """The span of a quoted literal's value."""
    while text[start] not in "\"'`":
        start += 1
    quotes = 3 if end - start > 6 and text[start : start + 3] in ('"' * 3, "'" * 3) else 1
    start, end = start + quotes, end - quotes
    if quotes == 3:
        while text[start].isspace():
            start += 1
        while text[end - 1].isspace():
            end -= 1
    return start, end


def _whole(text: str, m: re.Match[str]) -> tuple[int, int, str]:
    """(start, end, value) of a literal and all those joined to it; the span reaches from the first value to the last."""
    start, end = _inside(text, *m.span("text"))
    parts = [text[start:end]]
    while m := _JOINED.match(text, m.end()):
        a, end = _inside(text, *m.span("text"))
        parts.append(text[a:end])
    return start, end, "".join(parts)


def elements(text: str) -> tuple[list[tuple[str, int, int, str]], set[tuple[int, int]]]:
    """(name, start, end, value) of elements that hold one word and of tags with a name and a value; the spans of the latter's names."""
    out = [(m[1], *m.span(2), m[2]) for m in _ELEMENT.finditer(text)]
    names = set()
    for m in _TAG.finditer(text):
        if (name := _NAMED.search(m[1])) and (value := _VALUE.search(m[1])):
            k, at = value.lastindex, m.start(1)
            out.append((name[1], at + value.start(k), at + value.end(k), value[k]))
            names.add((at + name.start(1), at + name.end(1)))
    return out, names


def assignments(text: str) -> list[tuple[str, int, int, str]]:
    """(target name, start, end, value) of each assignment in reading order.

    Targets are plain, dotted or quoted names and quoted subscripts before one of
    = : := =>. A bare name on the right stands for the literals last assigned to
    it, so constants are propagated, over any number of steps; any other unquoted
    value is a literal itself. Literals that follow each other or are joined by a
    sign are one. A target stays one across its type (name: type = value).
    """
    out: list[tuple[str, int, int, str]] = []
    known: dict[str, tuple[int, int, str]] = {}
    target, armed, typed, skip, last = "", False, "", 0, ""  # typed: what stands in a type's place, skip: where the type or a joined literal ends

    def put(span: tuple[int, int, str]) -> None:
        for name in filter(None, (typed, target)):
            known[name] = span
            out.append((name, *span))

    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "gap" or m.start() < skip:
            continue
        before, last = last, kind
        if kind == "set":
            armed = bool(target)
            if armed and m[0] == ":" and (t := _TYPED.match(text, m.start())):
                skip = t.end() - 1
                typed = t[0][1:-1].strip()
            elif armed and (span := _bare(text, m)) and (value := text[slice(*span)]) not in known:
                put((*span, value))
        elif kind == "text" and armed:
            span = _whole(text, m)
            put(span)
            target, armed, typed, skip = "", False, "", span[1]
        elif kind == "name" and armed:
            if m[0] in known:
                put(known[m[0]])
            target, armed, typed = m[0], False, ""  # a chain like a = b = "x" goes on from b
        elif kind == "text":
            inner = m[0][1:-1]
            target = inner if re.fullmatch(r"[A-Za-z_$][\w$.-]*", inner, re.ASCII) else ""
        elif kind == "name":
            target = m[0]
        elif m[0] != "]" or before != "text":  # a quoted subscript names its target
            target, armed, typed = "", False, ""
    return out


def scan(text: str, lowered: bytes | None = None, hexes: bool = True) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, in code points, by start and then by the order of KINDS.

    lowered: the text's UTF-8 bytes in lower case. hexes: whether a hex run of
    the least length may exist. Both only save time.
    """
    low = text.encode("utf-8", "surrogatepass").lower() if lowered is None else lowered
    found: list[tuple[str, int, int]] = []
    if any(k in low for k in (b"passw", b"secret", b"token", b"api")):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST["assign"]]
    if b"akia" in low:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if hexes:
        found += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    if b"=" in low or b":" in low or b"</" in low:
        tagged, names = elements(text) if b"<" in low else ([], set())
        pairs = assignments(text) + tagged
        spans = {(s, e) for name, s, e, value in pairs if (n := name_score(name)) and (v := literal_score(value)) and n + v >= SCORE_LEAST}
        found += [("literal", s, e) for s, e in spans - names]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _hex_rows(column: pa.Array) -> np.ndarray:
    """Whether each row has a run of LEAST['hex'] bytes 0-9a-f."""
    data, offsets = _kernel.buffer_of(column)
    isin = np.zeros(256, dtype=bool)
    isin[list(b"0123456789abcdef")] = True
    off = np.flatnonzero(~isin[data])
    bounds = np.concatenate([[-1], off, [len(data)]])
    long = np.flatnonzero(np.diff(bounds) > LEAST["hex"])  # a run may reach over rows: then both are looked at
    out = np.zeros(len(column) + 1, dtype=np.int64)
    first = np.searchsorted(offsets, bounds[long] + 1, side="right") - 1
    last = np.searchsorted(offsets, bounds[long + 1], side="left")
    np.add.at(out, np.clip(first, 0, len(column)), 1)
    np.add.at(out, np.clip(last, 0, len(column)), -1)
    return np.cumsum(out[:-1]) > 0


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: the id and spans, an array of (kind, start, end).

    A null or empty text has no spans. Repeated rows are scanned each for itself;
    other columns of df are not read, whatever their names.
    """
    _store.prepare(df.sparkSession)
    narrow = df.select(F.col(f"`{id_col}`").alias(id_col), _store.text_of(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hexes = _hex_rows(batch.column(1))
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t, hexes=h)] for t, h in zip(batch.column(1).to_pylist(), hexes, strict=True)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], [id_col, "spans"])

    return narrow.mapInArrow(_store.resting(run), f"`{id_col}` {narrow.schema[id_col].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact(text: str, mark: str = "[SECRET]", hexes: bool = True) -> str:
    """The text with every union of spans replaced by the mark."""
    out, at = [], 0
    for _, start, end in scan(text, hexes=hexes):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """df with every found span of its texts replaced by the mark, all columns kept in their order.

    Null and clean texts stay as they are; so do repeated rows and other columns,
    whatever their names. A text without a sign that every kind of span needs
    stays in the JVM, and of others only the text goes to Python.
    """
    _store.prepare(df.sparkSession)

    @F.arrow_udf("string")
    def cleaned(texts: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for a, b in _kernel.slices(texts):
            part = texts.slice(a, b - a)
            out += [t if t is None else redact(t, mark, h) for t, h in zip(part.to_pylist(), _hex_rows(part), strict=True)]
        return pa.array(out, pa.string())

    text = F.col(f"`{text_col}`").cast("string")
    return df.withColumn(text_col, F.coalesce(cleaned(F.when(text.rlike(NEEDED), text)), text))
