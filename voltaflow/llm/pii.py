"""Personal data: base patterns plus offset-preserving deobfuscation.

*Base spans* are leftmost, non-overlapping matches of one pattern per kind,
with a check per kind (octets, Luhn, number of digits); a match that fails its
check is dropped and not retried. The scanners below find exactly what the
patterns find, but in linear time on any text: the e-mail scanner starts at
each ``@``, the address scanner at the first digit of a run.

*Added spans* come from small transducers. They rewrite look-alike characters,
zero-width characters, spelled digits and at/dot disguises, and remember for
every rewritten piece where it came from. The same detectors run on the
rewritten text; each hit that holds a rewritten piece is mapped back to the
characters of the source. Added spans never replace or overlap a base span of
their kind.

All offsets are code points of the whole source text, end exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches, freeing

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind: string, start: int, end: int, base: boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Cyrillic and Greek letters that look like Latin ones.
LOOK_ALIKES = dict(zip("аеорсхуіјѕԁһкмтвнАВЕКМНОРСТХІЈЅαοενικρτυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aeopcxyijsdhkmtbhABEKMHOPCTXIJSaoevikptuABEZHIKMNOPTYX"))
ZERO_WIDTH = "­​‌‍⁠﻿"
# Spelled digits.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
               "seven": "7", "eight": "8", "nine": "9"}


def _ascii_of(ch: str) -> str | None:
    """The ASCII character that ``ch`` stands for, if it is a look-alike."""
    if ch in LOOK_ALIKES:
        return LOOK_ALIKES[ch]
    plain = unicodedata.normalize("NFKC", ch)
    if len(plain) == 1 and plain.isascii() and plain.isprintable():
        return plain
    digit = unicodedata.digit(ch, None)
    return None if digit is None else str(digit)


#: By rule: every character beyond ASCII that stands for one printable ASCII character.
_ALIKE = {c: a for c in range(0x80, 0x20000) if not 0xD800 <= c < 0xE000 and (a := _ascii_of(chr(c))) is not None}


def _char_class(codes) -> str:
    """A regular-expression class of code points, as ranges."""
    out, start, last = [], None, None
    for c in [*sorted(codes), None]:
        if start is not None and (c is None or c != last + 1):
            out.append(f"{re.escape(chr(start))}-{re.escape(chr(last))}")
            start = c
        start, last = c if start is None else start, c
    return "[" + "".join(out) + "]"


_ALIKE_RE = re.compile(_char_class(_ALIKE))
_GAP = r"[\x20\t]"


def _any_case(*words: str) -> str:
    """A pattern of words in ASCII letters of any case. ``re.IGNORECASE`` would
    take other letters as well, such as a dotless i."""
    return "(?:" + "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in words) + ")"


_DIGIT, _AT, _DOT, _PLUS = _any_case(*DIGIT_WORDS), _any_case("at"), _any_case("dot"), _any_case("plus")
_TIMES = {"double": 2, "triple": 3}
_DIGITS = rf"(?:{_any_case(*_TIMES)}{_GAP})?{_DIGIT}"
_SEP = rf"(?:{_GAP}{{1,2}}|-|,{_GAP}?)"
_REWRITE = re.compile(
    rf"(?P<zero>[{ZERO_WIDTH}]+)"
    rf"|(?P<at>(?<=[A-Za-z0-9]){_GAP}{{0,2}}(?:\[{_GAP}?(?:{_AT}|@){_GAP}?\]|\({_GAP}?(?:{_AT}|@){_GAP}?\)|\{{{_GAP}?(?:{_AT}|@){_GAP}?\}}"
    rf"|<{_GAP}?(?:{_AT}|@){_GAP}?>){_GAP}{{0,2}}(?=[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9]){_GAP}{{1,2}}{_AT}{_GAP}{{1,2}}(?=[A-Za-z0-9-]{{1,63}}{_GAP}{{1,2}}{_DOT}{_GAP}{{1,2}}[A-Za-z0-9]"
    rf"|[A-Za-z0-9-]{{1,63}}{_GAP}{{0,2}}[\[({{<]{_GAP}?(?:{_DOT}|\.){_GAP}?[\])}}>]))"
    rf"|(?P<dot>(?<=[A-Za-z0-9]){_GAP}{{0,2}}(?:\[{_GAP}?(?:{_DOT}|\.){_GAP}?\]|\({_GAP}?(?:{_DOT}|\.){_GAP}?\)"
    rf"|\{{{_GAP}?(?:{_DOT}|\.){_GAP}?\}}|<{_GAP}?(?:{_DOT}|\.){_GAP}?>){_GAP}{{0,2}}(?=[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9]){_GAP}{{1,2}}{_DOT}{_GAP}{{1,2}}(?=[A-Za-z0-9]))"
    rf"|(?P<plus>\b{_PLUS}{_GAP}{{1,2}}(?={_DIGITS}\b|[0-9]))"
    rf"|(?P<digits>\b{_DIGITS}(?:{_SEP}{_DIGITS})*+\b)")
_BRACKET = re.compile(rf"[\[({{<]{_GAP}?(?:[@.]|[aA][tT]|[dD][oO][tT]){_GAP}?[\])}}>]")
_WORDS = [(w, re.compile(rf"{w}\b")) for w in ("dot", "plus", *DIGIT_WORDS)]
_RUN = re.compile(rf"(?:({_any_case(*_TIMES)}){_GAP})?({_DIGIT})\b")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        # a run that ends at an @ without a domain is not scanned again
        done = m.end() if m else at + 1
        if m:
            yield start, done
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _matches(text: str) -> Iterator[tuple[str, int, int]]:
    for a, b in _emails(text):
        yield "email", a, b
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()


def _disguised(text: str) -> bool:
    """Whether a rewriting may apply: cheap searches that start with a literal."""
    if _BRACKET.search(text) or any(c in text for c in ZERO_WIDTH):
        return True
    low = text.lower()
    return any(w in low and any(not low[m.start() - 1:m.start()].isalnum() for m in r.finditer(low))
               for w, r in _WORDS)


def _rewritten(text: str) -> tuple[str, list[tuple[int, int, int, int]]] | None:
    """The normalised text and its edits as (new start, new end, start, end)."""
    alike = [] if text.isascii() else [m.start() for m in _ALIKE_RE.finditer(text)]
    plain = text.translate(_ALIKE) if alike else text
    edits = [(k, k + 1, None) for k in alike]
    if _disguised(plain):
        for m in _REWRITE.finditer(plain):
            if m.lastgroup == "digits":
                last = None
                for d in _RUN.finditer(m[0]):  # "double five" stands for two digits
                    # commas, tabs and wide gaps between digits count as one space
                    if last is not None and m[0][last:d.start()] not in (" ", "-"):
                        edits.append((m.start() + last, m.start() + d.start(), " "))
                    put = DIGIT_WORDS[d[2].lower()] * _TIMES.get((d[1] or "").lower(), 1)
                    edits.append((m.start() + d.start(), m.start() + d.end(), put))
                    last = d.end()
            else:
                edits.append((m.start(), m.end(), {"zero": "", "at": "@", "dot": ".", "plus": "+"}[m.lastgroup]))
    if not edits:
        return None
    edits.sort(key=lambda e: (e[0], e[2] is None))
    parts, found, at, new = [], [], 0, 0
    for a, b, put in edits:
        if a < at:  # a look-alike inside a rewritten piece
            continue
        piece = plain[a:b] if put is None else put
        new += a - at
        found.append((new, new + len(piece), a, b))
        parts += [plain[at:a], piece]
        new, at = new + len(piece), b
    return "".join([*parts, plain[at:]]), found


def spans_of(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, base) by start, then kind as listed."""
    text = text or ""
    base = list(_matches(text))
    out = [(*x, True) for x in base]
    if rewritten := _rewritten(text):
        other, edits = rewritten
        new_starts, sources = [e[0] for e in edits], [e[2] for e in edits]
        taken = {k: sorted((a, b) for kind, a, b in base if kind == k) for k in KINDS}

        def source(pos: int) -> tuple[int, int]:
            """Source characters of one character of the normalised text."""
            k = bisect_right(new_starts, pos) - 1
            if k < 0:
                return pos, pos + 1
            _, b, start, end = edits[k]
            return (start, end) if pos < b else (end + pos - b, end + pos - b + 1)

        for kind, a, b in _matches(other):
            at, to = source(a)[0], source(b - 1)[1]
            k = bisect_right(sources, to - 1) - 1
            if k < 0 or edits[k][3] <= at:
                continue  # nothing was rewritten here
            j = bisect_right(taken[kind], (at, to))
            if (j and taken[kind][j - 1][1] > at) or (j < len(taken[kind]) and taken[kind][j][0] < to):
                continue
            out.append((kind, at, to, False))
    order = {k: n for n, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the
    kind of its first span in brackets."""
    out, at, n = [], 0, 0
    while n < len(spans):
        kind, a, b, _ = spans[n]
        n += 1
        while n < len(spans) and spans[n][1] < b:
            b = max(b, spans[n][2])
            n += 1
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def find(text: Column) -> Column:
    """Spans of a text column; none for a null or empty text."""
    bounded_batches()

    @F.pandas_udf(SPAN)
    @freeing
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "end", "base")
        for s in batches:
            yield pd.Series([[dict(zip(names, x)) for x in spans_of(t)] for t in s], dtype=object)
    return spans(text)


def redact(text: Column) -> Column:
    """The text with its personal data replaced; a null text stays null."""
    bounded_batches()

    @F.pandas_udf("string")
    @freeing
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: redacted(t, spans_of(t)), na_action="ignore").astype(object)
    return clean(text)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
