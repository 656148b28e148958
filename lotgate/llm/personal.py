"""Personal data by anchor expansion.

*Anchors* are found first: an Aho-Corasick automaton reads a block of texts once
for at-signs, plus signs, URL schemes, spelled at-signs and identifier cues, and
runs of digits are found with them. Local parsers then expand each anchor to
the left and right up to the boundaries that its kind has, and validate what
they found. Each parser reads on from its anchor only as far as its span goes.

Base kinds (leftmost, not overlapping within a kind):

* ``email``: local part, at-sign, domain of two labels or more;
* ``ip``: four numbers of at most 255 joined by dots;
* ``card``: 12 to 19 digits, single spaces or hyphens between, passing Luhn;
* ``phone``: a plus sign and 9 to 15 digits with spaces, dots, hyphens, brackets.

Added kinds (may overlap others):

* ``spelled_email``: ``name [at] host dot tld``, with the marks in brackets;
* ``login``: user and password before the host of a URL;
* ``iban``: after the cue, country and check digits passing modulo 97;
* ``account``: after a cue such as "account number" or "passport no", an
  identifier of 5 to 20 letters and digits with 5 digits or more; after "ssn",
  three groups of 3, 2 and 4 digits in the ranges that are given out;
* ``po_box``: a numbered box address.

All boundaries are ASCII, so bytes are parsed, and offsets turn into code
points at the end. No span crosses a line end or a text.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, column, text_blocks

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "spelled_email", "login", "iban", "account", "po_box")
TEXT_BYTES = 2 << 20

_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_WORD = _LOCAL[:62]
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(rb"\x20?([A-Za-z0-9-]+(?:\x20?[\[({]\x20?(?:dot|DOT|Dot)\x20?[\])}]\x20?[A-Za-z0-9-]+|\.[A-Za-z0-9-]+)+)")
_LOGIN = re.compile(rb"([A-Za-z0-9._~%!$&'*+,;=-]{1,64}:[A-Za-z0-9._~%!$&'*+,;=-]{1,64})@[A-Za-z0-9\[]")
_IBAN = re.compile(rb"(?:\x20?(?:number|no\.?|NO\.?|Number|No\.?))?[\x20:#=]{0,3}([A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]{1,4}){3,8})")
_IDENTIFIER = re.compile(rb"[\x20]?[:#=]?[\x20]?([A-Za-z0-9]+(?:[\x20-][A-Za-z0-9]*[0-9][A-Za-z0-9]*)*)")
_SSN = re.compile(rb"[\x20:#=]{0,3}([0-9]{3})[\x20-]([0-9]{2})[\x20-]([0-9]{4})")
_BOX = re.compile(rb"\x20?(?:no\.?\x20?)?#?([0-9]{1,6})")

_SPELLED_AT = ("[at]", "(at)", "{at}", "[ at ]", "( at )", "{ at }")
_ACCOUNT_CUES = ("account number", "account no", "account no.", "acct no", "acct no.", "account id", "acct", "passport no", "passport no.", "passport number",
                 "customer id", "customer number", "member id", "national id", "tax id", "driver license number", "driving licence number")
_SSN_CUES = ("ssn", "social security number", "social security no", "social security no.")
_BOX_CUES = ("p.o. box", "po box", "p.o.box")


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, cues in (("at", ("@",)), ("plus", ("+",)), ("scheme", ("://",)), ("spelled", _SPELLED_AT), ("iban", ("iban",)),
                       ("account", _ACCOUNT_CUES), ("ssn", _SSN_CUES), ("box", _BOX_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def _back(data: bytes, end: int, least: int, allowed: bytes) -> int:
    """The first place of the run of *allowed* bytes that ends before *end*."""
    width = 64
    while True:
        start = max(least, end - width)
        rest = len(data[start:end].rstrip(allowed))
        if rest or start == least:
            return start + rest
        width *= 4


def _luhn(digits: bytes) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        x -= 48
        total += x if i % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def _iban(data: bytes) -> bool:
    code = data.replace(b" ", b"").replace(b"-", b"").upper().decode()
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _digit_runs(data: np.ndarray):
    """Starts and ends of runs of digits, and the byte between neighbours that
    are one byte apart (0 if they are not)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = (data >= 48) & (data <= 57)
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    between = np.zeros(max(0, len(start) - 1), np.uint8)
    near = start[1:] - end[:-1] == 1
    between[near] = data[end[:-1][near]]
    return start, end, between


def _chains(linked: np.ndarray, n: int):
    """First and last run of each maximal chain of linked runs."""
    first = np.flatnonzero(np.append(True, ~linked)) if n else np.zeros(0, int)
    return first, np.append(first[1:], n) - 1


def _numbers(block: Block):
    data = block.bytes
    start, end, between = _digit_runs(block.data)
    first, last = _chains((between == 32) | (between == 45), len(start))
    digits = np.append(0, np.cumsum(end - start))
    size = digits[last + 1] - digits[first]
    for i in np.flatnonzero((size >= 12) & (size <= 19)).tolist():
        a, b = int(start[first[i]]), int(end[last[i]])
        if _luhn(data[a:b].replace(b" ", b"").replace(b"-", b"")):
            yield a, b, "card"
    first, last = _chains(between == 46, len(start))
    for i in np.flatnonzero(last - first >= 3).tolist():
        for j in range(int(first[i]), int(last[i]) - 2, 4):
            parts = [data[a:b].lstrip(b"0") for a, b in zip(start[j:j + 4].tolist(), end[j:j + 4].tolist())]
            if all(len(p) <= 3 and int(p or b"0") <= 255 for p in parts):
                yield int(start[j]), int(end[j + 3]), "ip"


def _cued(kind: str, data: bytes, end: int):
    """The identifier after a cue that ends at *end*."""
    if kind == "iban" and (m := _IBAN.match(data, end)):
        # Words that follow the number are no part of it: the longest valid one.
        stops = [x.end() for x in re.finditer(rb"[\x20-]|$", m[1])]
        for stop in reversed(stops):
            if _iban(part := m[1][:stop].rstrip(b" -")):
                return m.start(1), m.start(1) + len(part), "iban"
    if kind == "account" and (m := _IDENTIFIER.match(data, end)):
        digits = sum(48 <= x <= 57 for x in m[1])
        if digits >= 5 and len(m[1]) <= 24 and 5 <= sum(x not in b" -" for x in m[1]) <= 20:
            return *m.span(1), "account"
    if kind == "ssn" and (m := _SSN.match(data, end)) and m[1] not in (b"000", b"666") and m[1] < b"900" and m[2] != b"00" and m[3] != b"0000":
        if not data[m.end():m.end() + 1].isdigit():
            return m.start(1), m.end(), "account"
    if kind == "box" and (m := _BOX.match(data, end)):
        return m.end(), m.end(), "po_box"
    return None


def spans_of(block: Block) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans in the bytes of *block*."""
    data = block.bytes
    out = list(_numbers(block))
    email_end = 0
    for last, (kind, size) in _automaton().iter(data.lower().decode("latin-1")):
        at, end = last + 1 - size, last + 1
        if kind == "at":
            start = _back(data, at, email_end, _LOCAL)
            if start < at and (m := _DOMAIN.match(data, end)):
                email_end = m.end()
                out.append((start, email_end, "email"))
        elif kind == "plus":
            if (m := _PHONE.match(data, at)) and 9 <= sum(48 <= x <= 57 for x in m[0]) <= 15:
                out.append((*m.span(), "phone"))
        elif kind == "scheme":
            if _back(data, at, max(0, at - 16), _WORD) < at and (m := _LOGIN.match(data, end)):
                out.append((*m.span(1), "login"))
        elif kind == "spelled":
            stop = at - (data[at - 1:at] == b" ")
            start = _back(data, stop, max(0, stop - 64), _LOCAL)
            m = _SPELLED.match(data, end)
            if start < stop and m:
                out.append((start, m.end(1), "spelled_email"))
        elif not data[max(0, at - 1):at].isalnum() and (found := _cued(kind, data, end)):
            out.append((at, found[1], "po_box") if found[2] == "po_box" else found)
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(out), key=lambda x: (x[0], order[x[2]], x[1]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _found(batches):
    for batch, texts in text_blocks(batches, TEXT_BYTES):
        block = Block(texts)
        points = np.append(0, np.cumsum((block.data & 0xC0) != 0x80))
        lists: list[list] = [[] for _ in texts]
        spans = spans_of(block)
        if spans:
            start, end = np.array([s[0] for s in spans]), np.array([s[1] for s in spans])
            owner = np.searchsorted(block.doc_start, start, "right") - 1
            zero = points[block.doc_start[owner]]
            for i, a, b, span in zip(owner.tolist(), (points[start] - zero).tolist(), (points[end] - zero).tolist(), spans):
                lists[i].append({"kind": span[2], "start": a, "end": b})
        yield pa.RecordBatch.from_arrays([column(batch, "row"), pa.array(lists, _SPANS)], ["row", "spans"])


def personal_spans(docs: DataFrame) -> DataFrame:
    """The rows of *docs* (text, and any other columns, carried in the struct
    ``row``) with ``spans``: array<struct<kind, start, end>> by start, then kind
    in the order of ``KINDS``; code points, end exclusive.

    A null text is empty and has no spans. Each row is judged by itself:
    repeated rows and null or equal ids come back alike, and columns of any
    name are carried. An empty table gives no rows.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(row.alias("row"), F.col("text").cast("binary").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(_found, schema)
