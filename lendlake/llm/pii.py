"""Personal data with offset-preserving deobfuscation (op5).

Base identifiers are found in the text as it is. Then a transducer rewrites
disguises to plain characters and notes for every piece of its output which
source characters it stands for: homoglyphs and full-width forms to ASCII,
invisible characters to nothing, runs of spelled digits (English, Spanish,
French, German) to digits, "(at)", "[dot]" and " at ... dot ..." to "@" and ".".
The same detectors run over the rewritten text; what they find that touches a
rewritten piece, and lies in no base identifier of its kind, is mapped back
to source offsets and added. Base identifiers always stay, also beside a longer
one that goes on in disguise ("+44 20 7946 zero nine five eight").

Offsets are code points, ends exclusive. A text is rewritten only if a scan
finds a disguise in it; the scans read the whole text.

Cases: a null text counts as empty; repeated documents are scanned each; a row
without doc_id is scanned like any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlake.llm.tables import id_text, map_rows, ship_code

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its start only: what fails there fails later.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Base identifiers by kind, then start."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# --- disguises -----------------------------------------------------------------

# Look-alikes of Latin letters and of punctuation.
_LOOKALIKES = str.maketrans(
    "АВЕЅІЈКМНОРСТУХабеѕіјкмнорстухԁһԛԝ"
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχ"
    "‐‑‒–−․。﹒﹫",
    "ABESIJKMHOPCTYXabesijkmhopctyxdhqw"
    "ABEZHIKMNOPTYXaiknopux"
    "-----...@",
)
_INVISIBLE = "­​‌‍⁠﻿"
# The digits spelled, and words between digits.
_SPELLED = {
    **dict.fromkeys(["zero", "cero", "zéro", "null"], "0"),
    **dict.fromkeys(["one", "uno", "un", "eins"], "1"),
    **dict.fromkeys(["two", "dos", "deux", "zwei"], "2"),
    **dict.fromkeys(["three", "tres", "trois", "drei"], "3"),
    **dict.fromkeys(["four", "cuatro", "quatre", "vier"], "4"),
    **dict.fromkeys(["five", "cinco", "cinq", "fünf"], "5"),
    **dict.fromkeys(["six", "seis", "sechs"], "6"),
    **dict.fromkeys(["seven", "siete", "sept", "sieben"], "7"),
    **dict.fromkeys(["eight", "ocho", "huit", "acht"], "8"),
    **dict.fromkeys(["nine", "nueve", "neuf", "neun"], "9"),
}
_SIGNS = {**dict.fromkeys(["dot", "point", "punto", "punkt"], "."), **dict.fromkeys(["plus", "más", "mas"], "+")}

_WORD = "|".join(sorted(_SPELLED, key=len, reverse=True))
_SIGN = "|".join(_SIGNS)
_GAP = r"[\x20\t,-]{1,3}"
#: At least four digits one after the other, two of them spelled.
_NUMBER = re.compile(
    rf"(?<!\w)(?:(?:plus|más|mas){_GAP}|\+\x20?)?(?:{_WORD}|[0-9]+)(?:{_GAP}(?:(?:{_SIGN}){_GAP})?(?:{_WORD}|[0-9]+)){{3,}}(?!\w)",
    re.IGNORECASE,
)
_TWO_SPELLED = re.compile(rf"(?<!\w)(?:{_WORD}){_GAP}(?:(?:{_SIGN}){_GAP})?(?:{_WORD})(?!\w)", re.IGNORECASE)
_TOKEN = re.compile(rf"{_WORD}|{_SIGN}|[0-9+]", re.IGNORECASE)

_BOX = r"\x20?[(\[{<]\x20?(?:%s)\x20?[)\]}>]\x20?"
_BOXED_AT, _BOXED_DOT = _BOX % "at|arroba|@", _BOX % r"dot|punto|point|punkt|\."
_DOTS = rf"(?:\.|{_BOXED_DOT}|\x20(?:dot|punto|point|punkt)\x20)"
#: An at and its domain in a disguised address: a boxed at, or a bare one whose
#: domain has a disguised dot.
_AT_DOMAIN = re.compile(
    rf"(?:{_BOXED_AT}|\x20?@\x20?)[A-Za-z0-9-]++(?:{_DOTS}[A-Za-z0-9-]++)+"
    rf"|\x20(?:at|arroba)\x20[A-Za-z0-9-]++(?:{_DOTS}[A-Za-z0-9-]++)*?"
    rf"(?:{_BOXED_DOT}|\x20(?:dot|punto|point|punkt)\x20)[A-Za-z0-9-]++(?:{_DOTS}[A-Za-z0-9-]++)*",
    re.IGNORECASE,
)
_NAME_CHARACTERS = _LOCAL - {"."}
_DOTS_BEFORE = re.compile(rf"{_DOTS}\Z", re.IGNORECASE)
#: No disguised dot is longer.
_DOTS_LENGTH = 12
_BARE_AT = re.compile(r"\x20(?:at|arroba)\x20", re.IGNORECASE)
# Endings that a bare "at ... dot ..." must have to be an address.
_TOP_LEVEL = frozenset(
    "com org net edu gov mil int info biz name io ai app dev co me tv eu de fr es it pt nl be ch at uk ie us ca mx ar br"
    " cl pe au nz in jp cn kr ru ua pl cz sk hu ro bg gr tr se no dk fi is lu example test".split()
)
_MARK = re.compile(rf"{_BOXED_AT}|{_BOXED_DOT}|\x20(?:at|arroba)\x20|\x20?@\x20?|\x20(?:dot|punto|point|punkt)\x20", re.IGNORECASE)
#: What any disguised address has: a mark that the rewriting of addresses changes, and an at.
_DISGUISED_MARK = re.compile(rf"{_BOXED_AT}|{_BOXED_DOT}|\x20@|@\x20|\x20(?:dot|punto|point|punkt)\x20", re.IGNORECASE)
_ANY_AT = re.compile(rf"@|{_BOXED_AT}|\x20(?:at|arroba)\x20", re.IGNORECASE)
#: An address whose only disguise is a space beside its at needs an ending that a domain can have.
_SPACED_AT = re.compile(r"\x20@|@\x20")
_NOT_LABEL = re.compile("[^A-Za-z0-9-]")
_ENDING = re.compile(r"(?:[a-z]{2,}|xn--[a-z0-9-]+)\Z", re.IGNORECASE)


def _plain(c: str) -> str:
    """The ASCII stand-in of a character, or itself."""
    if c in _INVISIBLE:
        return ""
    got = c.translate(_LOOKALIKES)
    if got != c:
        return got
    kind = unicodedata.category(c)
    if kind == "Nd":
        return str(unicodedata.digit(c))
    if kind == "Zs":
        return " "
    wide = unicodedata.normalize("NFKC", c) if "！" <= c <= "～" or "\U0001d400" <= c <= "\U0001d7ff" else c
    return wide if len(wide) == 1 and wide.isascii() else c


#: Characters of the Latin supplement that are never rewritten.
_ODD = re.compile("[ ­Ͱ-ӿԀ-ԯ٠-٩۰-۹०-९ -⁯−　-。﹒﹫﻿！-～\U0001d400-\U0001d7ff]")


class Rewritten:
    """A text and, for each piece of it, the source span that it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.begins = [0]  # of pieces in the text
        self.source = [(0, len(text), False)]  # from, to, rewritten

    def replace(self, changes: list[tuple[int, int, str]]) -> Rewritten:
        """Another with ``(from, to, new)`` spans of this text replaced."""
        out = Rewritten("")
        out.begins, out.source, parts, size = [], [], [], 0

        def add(s: str, a: int, b: int, new: bool) -> None:
            nonlocal size
            out.begins.append(size)
            out.source.append((a, b, new))
            parts.append(s)
            size += len(s)

        def copy(a: int, b: int) -> None:
            while a < b:
                k = bisect_right(self.begins, a) - 1
                end = min(b, self.begins[k + 1] if k + 1 < len(self.begins) else len(self.text))
                lo, hi, new = self.source[k]
                if new:
                    add(self.text[a:end], lo, hi, True)
                else:
                    add(self.text[a:end], lo + a - self.begins[k], lo + end - self.begins[k], False)
                a = end

        at = 0
        for a, b, new in changes:
            copy(at, a)
            add(new, self.back(a, a + 1)[0], self.back(b - 1, b)[1], True)
            at = b
        copy(at, len(self.text))
        out.text = "".join(parts)
        return out

    def _piece(self, at: int) -> int:
        k = bisect_right(self.begins, at) - 1
        return k

    def back(self, a: int, b: int) -> tuple[int, int]:
        """Source span of a..b."""
        i, j = self._piece(a), self._piece(b - 1)
        lo, hi, new = self.source[i]
        start = lo if new else lo + a - self.begins[i]
        lo, hi, new = self.source[j]
        return start, (hi if new else lo + b - self.begins[j])

    def touched(self, a: int, b: int) -> bool:
        return any(self.source[k][2] for k in range(self._piece(a), self._piece(b - 1) + 1))


def _spelled(m: re.Match) -> str:
    out = []
    for t in _TOKEN.findall(m.group()):
        t = t.lower()
        out.append(_SPELLED.get(t) or _SIGNS.get(t) or t)
    return "".join(out)


def _name_start(text: str, end: int, least: int) -> int | None:
    """Where the dotted name that ends at ``end`` starts, not before ``least``."""
    start, at = None, end
    while True:
        a = at
        while a > least and text[a - 1] in _NAME_CHARACTERS:
            a -= 1
        if a == at:
            return start
        if a == 0 or text[a - 1] not in _LOCAL:
            start = a
        dots = _DOTS_BEFORE.search(text, max(least, a - _DOTS_LENGTH), a)
        if not dots:
            return start
        at = dots.start()


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Spans that have the form of a disguised address, found from each at: its
    domain to the right, then the name to the left."""
    done = 0
    m = _AT_DOMAIN.search(text)
    while m:
        start = _name_start(text, m.start(), done)
        if start is None:
            m = _AT_DOMAIN.search(text, m.start() + 1)
        else:
            yield start, m.end()
            done = m.end()
            m = _AT_DOMAIN.search(text, done)


def rewrite(text: str) -> Rewritten | None:
    """The text without its disguises; None if it has none."""
    out = None
    if not text.isascii() and _ODD.search(text):
        changes = [(i, i + 1, p) for i in (m.start() for m in _ODD.finditer(text)) if (p := _plain(text[i])) != text[i]]
        if changes:
            out = Rewritten(text).replace(changes)
    now = out.text if out else text
    if _TWO_SPELLED.search(now):
        changes = [(*m.span(), _spelled(m)) for m in _NUMBER.finditer(now) if _TWO_SPELLED.search(m.group())]
        if changes:
            out = (out or Rewritten(text)).replace(changes)
            now = out.text
    if _DISGUISED_MARK.search(now) and _ANY_AT.search(now):
        changes = []
        for a, b in addresses(now):
            last = _NOT_LABEL.split(now[a:b])[-1]
            if _BARE_AT.search(now, a, b) and last.lower() not in _TOP_LEVEL:
                continue  # a sentence such as "look at the dot on it"
            if _SPACED_AT.search(now, a, b) and not _ENDING.search(last):
                continue  # a price such as "5 @ 3.50"
            for k in _MARK.finditer(now, a, b):
                sign = "@" if "@" in k.group() or re.search("at|arroba", k.group(), re.IGNORECASE) else "."
                if k.group() != sign:
                    changes.append((*k.span(), sign))
        if changes:
            out = (out or Rewritten(text)).replace(changes)
    return out


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base identifiers, all identifiers), each by kind, then start."""
    base = base_spans(text)
    plain = rewrite(text)
    if plain is None:
        return base, base
    more = []
    for kind, a, b in base_spans(plain.text):
        if plain.touched(a, b):
            start, end = plain.back(a, b)
            if not any(k == kind and s <= start and end <= e for k, s, e in base):
                more.append((kind, start, end))
    return base, sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_email, n_ip, n_card, n_phone (all
    identifiers), base_sha256, spans, n_added (found behind disguises)."""

    def found(batches: Iterator[list]) -> Iterator[list]:
        for ids, texts in batches:
            rows = []
            for i, text in zip(ids, texts):
                base, spans = all_spans(text or "")
                kinds = [s[0] for s in spans]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((i, *map(kinds.count, KINDS), digest, _joined(spans), len(spans) - len(base)))
            yield rows

    return map_rows(
        id_text(docs),
        found,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long,"
        " base_sha256 string, spans string, n_added long",
    )


def redacted(text: str) -> str:
    """The text with a mark like ``[EMAIL]`` in place of each identifier;
    overlapping identifiers share the mark of the first."""
    merged: list[list] = []
    for kind, a, b in sorted(all_spans(text)[1], key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(b, merged[-1][2])
        else:
            merged.append([kind, a, b])
    for kind, a, b in reversed(merged):
        text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
    return text


def redact(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, identifiers replaced by marks;
    null stays null."""
    ship_code(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redacted(t) for t in texts], dtype=object)

    return docs.withColumn("text", clean(docs["text"].cast("string")))
