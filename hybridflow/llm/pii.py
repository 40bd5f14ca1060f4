"""Personal data in whole texts, plain and disguised, with exact places in the source.

Plain identifiers are found by leftmost, non-overlapping patterns per kind. For disguises the text
passes through transducers that keep, for every character they emit, the range of source characters
it stands for: a character fold (homoglyphs, wide and other digits, invisible characters), spelled
digits ("four one two", "plus one ..."), and written at and dot ("name [at] host (dot) org",
"name at host dot org"). The same patterns run over what comes out, and their spans go back to
source characters. A disguised span is added unless a plain one of its kind already covers it.

Texts are handled one at a time where they are read; nothing is shuffled. Patterns take time
proportional to the text, whatever it holds: runs are matched possessively and entered only at
their start.

Defined results: a null or empty text has no spans. Places are code points, ends exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hybridflow.llm.common import ready

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign, the local part to its left and the host to its right."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def plain_spans(text: str) -> list[Span]:
    """Identifiers as they stand, by kind and place."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(small, m.group().split(".")))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Letters of other scripts that look like ASCII ones, and digits spelled by language.
LOOKALIKES = {
    "АаВЕеКкМНОоРрСсТуХхІіЈјЅѕԁԛԝһҮҺ": "AaBEeKkMHOoPpCcTyXxIiJjSsdqwhYh",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορτυ": "ABEZHIKMNOPTYXaikvoptu",
    "ɑɡıɩℓ∙․‧·•。‐‑‒–—−": "agiil......------",
}
SPELLED = {
    "zero one two three four five six seven eight nine": "0123456789",
    "null eins zwei drei vier fünf sechs sieben acht neun": "0123456789",
    "zéro un deux trois quatre cinq six sept huit neuf": "0123456789",
    "cero uno dos tres cuatro cinco seis siete ocho nueve": "0123456789",
    "oh ein zwo": "012",
}
INVISIBLE = "­​‌‍⁠﻿"

DIGIT_OF = {w: d for words, digits in SPELLED.items() for w, d in zip(words.split(), digits, strict=True)}
_WORD = "(?:" + "|".join(sorted(DIGIT_OF, key=len, reverse=True)) + ")"
_NUM = rf"(?:\b{_WORD}\b|(?<![0-9])[0-9]++)"
_JOIN = r"(?:[\s,/-]{1,3}|\s++(?:dot|punkt|point|punto)\s++|\s*+\.\s*+)"
SPELLED_RUN = re.compile(rf"(?:\bplus\s++|\+\s*+)?{_NUM}(?:{_JOIN}{_NUM}){{2,}}", re.I)
SPELLED_ONE = re.compile(rf"\b{_WORD}\b", re.I)
PIECE = re.compile(rf"\bplus\b|\+|\b{_WORD}\b|[0-9]+|\b(?:dot|punkt|point|punto)\b|\.", re.I)

_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
BRACKET_AT = re.compile(rf"\s{{0,3}}{_OPEN}\s?(?:at|@|arroba|arobase|ät)\s?{_SHUT}\s{{0,3}}", re.I)
BRACKET_DOT = re.compile(rf"\s{{0,3}}{_OPEN}\s?(?:dot|punkt|point|punto|\.)\s?{_SHUT}\s{{0,3}}", re.I)
_NAME = r"[A-Za-z0-9_%+-]+"


def _written(at: str, dot: str) -> str:
    part = rf"(?:\s+(?:{dot})\s+|\.)"
    return (
        rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:{part}{_NAME}){{0,8}}\s+(?:{at})\s+(?!(?:the|an?|this|that)\b)[A-Za-z0-9-]+(?:{part}[A-Za-z0-9-]+){{0,8}}"
        rf"\s+(?:{dot})\s+[A-Za-z]{{2,24}}\b"
    )


#: The written at needs a written dot before the last label, or "at" would join common prose.
WRITTEN = re.compile("|".join([_written("at", "dot"), _written("arroba", "punto|dot"), _written("arobase", "point|dot"), _written("ät", "punkt|dot")]), re.I)
WRITTEN_AT = re.compile(r"\s+(?:at|arroba|arobase|ät)\s+", re.I)
WRITTEN_DOT = re.compile(r"\s+(?:dot|punto|point|punkt)\s+", re.I)
DIGIT_DOT = re.compile(r"(?<=[0-9])\s+(?:dot|punkt|point|punto)\s+(?=[0-9])", re.I)
#: Words joined by written dots, of which some hold a sign already.
DOTTED = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+@-]++(?:\s++dot\s++[A-Za-z0-9._%+@-]++)++", re.I)
HALF_WRITTEN = re.compile(r"(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])", re.I)
RARE = re.compile(r"[­·ıɐ-᳿‐-—•․‧​-‍⁠-￿\U00010000-\U0001ffff]")

_fold: dict[int, str] = {}


def fold() -> dict[int, str]:
    """One character to one character: lookalikes, wide forms, and digits of any script."""
    if not _fold:
        for c in map(chr, [*range(0x250, 0x3000), *range(0xA620, 0xA62A), *range(0xFF00, 0xFFF0), *range(0x1D400, 0x1D800)]):
            if unicodedata.category(c) == "Nd":
                _fold[ord(c)] = str(unicodedata.decimal(c))
            elif len(flat := unicodedata.normalize("NFKC", c)) == 1 and "!" <= flat <= "~":
                _fold[ord(c)] = flat
        for odd, usual in LOOKALIKES.items():
            _fold.update({ord(a): b for a, b in zip(odd, usual, strict=True)})
    return _fold


class Mapped:
    """A text with, for every character, the source range it stands for."""

    def __init__(self, text: str, start: list[int] | None = None, end: list[int] | None = None):
        self.text = text
        self.start = list(range(len(text))) if start is None else start
        self.end = list(range(1, len(text) + 1)) if end is None else end

    def rewrite(self, changes: Iterator[tuple[int, int, str]]) -> Mapped:
        """Replace ranges of this text; each new character stands for the whole range it replaces."""
        parts, start, end, done = [], [], [], 0
        for a, b, new in changes:
            parts += [self.text[done:a], new]
            start += self.start[done:a] + [self.start[a]] * len(new)
            end += self.end[done:a] + [self.end[b - 1]] * len(new)
            done = b
        parts.append(self.text[done:])
        return Mapped("".join(parts), start + self.start[done:], end + self.end[done:])


def without_invisible(m: Mapped) -> Mapped:
    return m.rewrite((x.start(), x.end(), "") for x in re.finditer(f"[{INVISIBLE}]+", m.text))


def spelled_digits(m: Mapped) -> Mapped:
    """Runs of at least three numbers of which some are spelled, as digits."""

    runs = [(run, list(PIECE.finditer(m.text, run.start(), run.end()))) for run in SPELLED_RUN.finditer(m.text)]
    runs = [(run, pieces) for run, pieces in runs if sum(p.group().lower() in DIGIT_OF for p in pieces) >= 2]

    def changes():
        for run, pieces in runs:
            done = run.start()
            for p in pieces:
                word = p.group().lower()
                new = "+" if word in ("plus", "+") else DIGIT_OF.get(word, word if word.isdigit() else ".")
                if p.start() > done:
                    yield done, p.start(), ""
                yield p.start(), p.end(), new
                done = p.end()

    return m.rewrite(changes()) if runs else m


def written_signs(m: Mapped) -> Mapped:
    """Written at and dot as signs."""
    if BRACKET_AT.search(m.text) or BRACKET_DOT.search(m.text):
        m = m.rewrite((x.start(), x.end(), "@") for x in BRACKET_AT.finditer(m.text) if x.start() and x.end() < len(m.text))
        m = m.rewrite((x.start(), x.end(), ".") for x in BRACKET_DOT.finditer(m.text) if x.start() and x.end() < len(m.text))
    m = m.rewrite((x.start(), x.end(), ".") for x in DIGIT_DOT.finditer(m.text))
    if "@" in m.text:
        joined = [x.span() for x in DOTTED.finditer(m.text) if "@" in x.group()]
        m = m.rewrite((x.start(), x.end(), ".") for a, b in joined for x in HALF_WRITTEN.finditer(m.text, a, b))

    def changes():
        for found in WRITTEN.finditer(m.text):
            signs = [(x.start(), x.end(), "@") for x in WRITTEN_AT.finditer(m.text, found.start(), found.end())]
            signs = signs[-1:]
            signs += [(x.start(), x.end(), ".") for x in WRITTEN_DOT.finditer(m.text, found.start(), found.end())]
            yield from sorted(signs)

    return m.rewrite(changes()) if WRITTEN.search(m.text) else m


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """What the transducers bring to light beyond ``plain``."""
    odd = not text.isascii() and RARE.search(text) is not None
    low = text.lower()
    signs = any(w in low for w in ("dot", "arroba", "arobase", "punkt", "punto", "point")) or BRACKET_AT.search(text) or BRACKET_DOT.search(text)
    digits = SPELLED_ONE.search(text) and SPELLED_RUN.search(text)
    if not (odd or signs or digits):
        return []
    m = Mapped(text)
    if odd:
        m = without_invisible(Mapped(text.translate(fold())))
    if digits or odd:
        m = spelled_digits(m)
    if signs or odd:
        m = written_signs(m)
    if m.text == text:
        return []
    have = {k: [(a, b) for kind, a, b in plain if kind == k] for k in KINDS}
    out = []
    for kind, a, b in plain_spans(m.text):
        start, end = m.start[a], m.end[b - 1]
        if not any(x <= start and end <= y for x, y in have[kind]):
            out.append((kind, start, end))
    return out


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans, by kind and place."""
    if not text:
        return [], []
    plain = plain_spans(text)
    order = {k: i for i, k in enumerate(KINDS)}
    every = sorted({*plain, *disguised_spans(text, plain)}, key=lambda s: (order[s[0]], s[1], s[2]))
    return plain, every


SPANS = "array<struct<kind:string,start:int,end:int>>"


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        base, spans = [], []
        for text in batch.column(1):
            for into, found in zip((base, spans), find(text.as_py() or ""), strict=True):
                into.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(spans, kind)], ["doc_id", "base", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``base`` (plain spans) and ``spans`` (all), ordered by kind and place."""
    ready(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_batches, f"doc_id long, base {SPANS}, spans {SPANS}")
