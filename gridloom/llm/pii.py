"""Personal data in texts, also where it is disguised: offset-preserving transducers, detectors, spans of the source.

A transducer rewrites a text and keeps, for each character it gives, the span of source characters it came from.  They
are composed: look-alike characters become the ASCII ones they imitate, spelled digits become digits, at and dot
disguises become their signs.  The detectors of emails, IP addresses, card and phone numbers then run over the result,
and the spans they find are mapped back.  A span found so counts as added if a rewritten character lies in it and no
span of its kind that the plain text shows overlaps it.

Defined results: a null or empty text has no spans; repeated rows are searched each for itself; a text of any length is
searched whole, in time linear in its length; spans of one kind that begin alike are listed by their ends; an empty table gives
no rows; other columns aren't read, so their names can't clash.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import common

KINDS = ("email", "ip", "card", "phone")

IS_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A run of digits is tried from its start only: if that fails, so does every later start in it.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @ and dotted domain, found from each @ on."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in IS_LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = int(d) << (at & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def detect(text: str) -> list[list[Span]]:
    """The spans of each kind."""
    ips = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(m[0].count, "0123456789")) <= 15]
    return [list(emails(text)), ips, cards, phones]


#: Letters of other scripts that look like ASCII ones (fixed values).
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһӏАВЕКМНОРСТХІЈЅ", "aeopcyxijsdhlABEKMHOPCTXIJS", strict=True))  # Cyrillic
LOOK_ALIKES |= dict(zip("αορνικυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopvikuxABEZHIKMNOPTYX", strict=True))  # Greek
LOOK_ALIKES |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}  # full width
LOOK_ALIKES |= dict.fromkeys("‐‑‒–—−﹣", "-") | dict.fromkeys("․。｡﹒", ".") | {"﹫": "@", "﹢": "+"}
LOOK_ALIKES |= dict.fromkeys("\xa0             　", " ")
LOOK_ALIKES |= dict.fromkeys("\xad​‌‍⁠﻿", "")
LOOK_ALIKES |= {chr(c): str(unicodedata.decimal(chr(c))) for c in range(128, 0x11000) if chr(c).isdecimal()}
LOOK_ALIKE = re.compile("[" + "".join(map(re.escape, LOOK_ALIKES)) + "]")

DIGITS = {w: str(n) for n, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
SIGNS = {"plus": "+", "dash": "-", "hyphen": "-", "dot": ".", "point": "."}
_DIGIT = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
#: Blanks and a mark at most; it matches in one way only, so that long rows of blanks are read once.
_GAP = r"(?:[ \t]++(?:[,-][ \t]*+)?|[,-][ \t]*+)"
SPELLED = re.compile(rf"(?i)\b(?:plus{_GAP})?{_DIGIT}(?:(?:{_GAP}(?:dash|hyphen|dot|point))?{_GAP}(?:{_DIGIT}\b|[0-9](?![0-9A-Za-z]))){{2,}}")
SPELLED_WORD = re.compile(r"(?i)zero|oh|one|two|three|four|five|six|seven|eight|nine|plus|dash|hyphen|dot|point|[0-9]")
#: A letter that stands for a digit between digits.
DIGIT_LETTER = re.compile(r"(?<=[0-9])[OoIl|](?=[0-9])")

_AT_SIGN = r"[ \t]*(?:\[[ \t]*(?:at|@)[ \t]*\]|\([ \t]*(?:at|@)[ \t]*\)|\{[ \t]*(?:at|@)[ \t]*\}|<[ \t]*(?:at|@)[ \t]*>|(?<=[ \t])at(?=[ \t])|@)[ \t]*"
_DOT_SIGN = r"[ \t]*(?:\[[ \t]*(?:dot|\.)[ \t]*\]|\([ \t]*(?:dot|\.)[ \t]*\)|\{[ \t]*(?:dot|\.)[ \t]*\}|<[ \t]*(?:dot|\.)[ \t]*>|(?<=[ \t])dot(?=[ \t]))[ \t]*"
_LABEL = r"[A-Za-z0-9-]++"
_OF_LOCAL = "A-Za-z0-9._%+-"
#: From the at sign on; the local part before it is found by LOCAL, so that a long row of dots is read once only.
DISGUISED = re.compile(rf"(?i)(?<=[{_OF_LOCAL}])(?P<at>{_AT_SIGN}){_LABEL}(?:(?:{_DOT_SIGN}|\.){_LABEL})++")
LOCAL = re.compile(rf"(?i)(?<![{_OF_LOCAL}])[{_OF_LOCAL}]++(?:{_DOT_SIGN}[{_OF_LOCAL}]++)*+")
DOT_SIGN, ENDING = re.compile(rf"(?i){_DOT_SIGN}"), re.compile(r"[a-z]{2,}")
#: Where the at sign is a plain word and the dots are signs, the last label must be of two small letters, as all countries' endings
#: are, or one of these (fixed values), so that a sentence that ends without a blank behind it ("at noon.Then") is no address; if a dot
#: is a plain word too, any of two letters or more, unless what follows the at is a determiner ("look at the dot matrix").
ENDINGS = frozenset("com org net edu gov mil int info biz app dev online shop site tech xyz name pro museum".split())
COUNTRY = re.compile(r"[a-z]{2}")
DETERMINERS = frozenset("a an the this that these those each every any some no my your his her its our their".split())


class Rewritten:
    """A text, the source span of each of its characters, and whether it was rewritten; the latter are empty as long as nothing was."""

    def __init__(self, text: str) -> None:
        self.text, self.start, self.end, self.changed = text, [], [], bytearray()

    def apply(self, pattern: re.Pattern, rule: Callable[[re.Match], list[tuple[int, int, str]]]) -> None:
        """rule: for a match, the pieces (start, end, what takes their place) in it that are rewritten, in order."""
        pieces = [p for m in pattern.finditer(self.text) for p in rule(m)]
        if not pieces:
            return
        if not self.changed:
            self.start, self.end, self.changed = list(range(len(self.text))), list(range(1, len(self.text) + 1)), bytearray(len(self.text))
        out, start, end, changed, at = [], [], [], bytearray(), 0
        for a, b, new in pieces:
            out += (self.text[at:a], new)
            start += self.start[at:a]
            end += self.end[at:a]
            changed += self.changed[at:a]
            start += [self.start[a]] * len(new)
            end += [self.end[b - 1]] * len(new)
            changed += b"\1" * len(new)
            at = b
        out.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        changed += self.changed[at:]
        self.text, self.start, self.end, self.changed = "".join(out), start, end, changed


def look_alike(m: re.Match) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), LOOK_ALIKES[m[0]])]


def spelled(m: re.Match) -> list[tuple[int, int, str]]:
    """Digit words become digits, what stands between them goes."""
    out, at = [], m.start()
    for w in SPELLED_WORD.finditer(m[0]):
        a, b, word = m.start() + w.start(), m.start() + w.end(), w[0].lower()
        if a > at:
            out.append((at, a, ""))
        out.append((a, b, DIGITS.get(word) or SIGNS.get(word) or word))
        at = b
    return out


def digit_letter(m: re.Match) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "0" if m[0] in "Oo" else "1")]


def disguised() -> Callable[[re.Match], list[tuple[int, int, str]]]:
    """A rule for the matches of one text, in order: each local part starts behind the address before it."""
    free = 0

    def rule(m: re.Match) -> list[tuple[int, int, str]]:
        nonlocal free
        text, (a, b) = m.string, m.span("at")
        start = next((x.start() for x in LOCAL.finditer(text, free, a) if x.end() == a), None)
        free = b if start is None else m.end()
        if start is None:
            return []
        before, after = ([(x.start(), x.end(), ".") for x in DOT_SIGN.finditer(text, *span)] for span in ((start, a), (b, m.end())))
        if m["at"].strip().lower() == "at" and not re.search(r"[\[({<]", text[start : m.end()]):
            domain = text[b : m.end()]
            first, last = (re.split(r"[^a-z0-9-]", domain.lower())[k] for k in (0, -1))
            plain = last in ENDINGS or COUNTRY.fullmatch(domain[-len(last) :])
            if not plain and not ((before or after) and first not in DETERMINERS and ENDING.fullmatch(last)):
                return []
        return before + ([(a, b, "@")] if m["at"] != "@" else []) + after

    return rule


def added(text: str, base: list[list[Span]]) -> list[list[Span]]:
    """The spans of each kind that only the rewritten text shows."""
    new = Rewritten(text)
    if not text.isascii():
        new.apply(LOOK_ALIKE, look_alike)
    new.apply(DIGIT_LETTER, digit_letter)
    new.apply(SPELLED, spelled)
    new.apply(DISGUISED, disguised())
    if 1 not in new.changed:
        return [[] for _ in KINDS]
    out = []
    for plain, spans in zip(base, detect(new.text), strict=True):
        found = []
        for a, b in spans:
            if 1 in new.changed[a:b]:
                s, e = new.start[a], max(new.end[a:b])
                if not any(s < y and x < e for x, y in plain):
                    found.append((s, e))
        out.append(found)
    return out


def listed(spans: list[list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, own in zip(KINDS, spans, strict=True) for a, b in own)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base_spans, spans: of every whole text, with kind:start:end in code points, end exclusive, by kind and start."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, every = [], []
        for text in batch.column("text").to_pylist():
            plain = detect(text or "")
            more = added(text or "", plain)
            base.append(listed(plain))
            every.append(listed([sorted(a + b) for a, b in zip(plain, more, strict=True)]))
        return pa.record_batch([batch.column("doc_id"), pa.array(base, pa.string()), pa.array(every, pa.string())], ["doc_id", "base_spans", "spans"])

    return common.by_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, base_spans string, spans string")


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the spans in the plain text by kind, their digest, all spans, the number added by the transducers and that of all."""
    found = find(docs)
    many = lambda c, k: F.when(F.col(c) == "", 0).otherwise(F.size(F.filter(F.split(c, ","), lambda s: s.startswith(f"{k}:")))).cast("long")
    return found.select("doc_id", *[many("base_spans", k).alias(f"n_{k}") for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans", sum((many("spans", k) - many("base_spans", k) for k in KINDS), F.lit(0)).cast("long").alias("n_added"), sum((many("spans", k) for k in KINDS), F.lit(0)).cast("long").alias("n_found"))


def redact(docs: DataFrame) -> DataFrame:
    """doc_id, text with each found span replaced by its kind in brackets; where spans overlap, the first to start wins, of those the longest."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column("text").to_pylist():
            plain = detect(text or "")
            spans = sorted((a, -b, k) for k, x, y in zip(KINDS, plain, added(text or "", plain), strict=True) for a, b in x + y)
            parts, at = [], 0
            for a, b, kind in spans:
                if a >= at:
                    parts += ((text or "")[at:a], f"[{kind}]")
                    at = -b
            out.append("".join(parts) + (text or "")[at:])
        return pa.record_batch([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return common.by_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, text string")
