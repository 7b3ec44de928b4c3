"""Personal data in whole texts: plain patterns, and disguised identifiers found in a normalised copy.

A transducer rewrites homoglyphs, spelled digits and written-out at and dot signs, and keeps for every rewritten piece
where it came from. The plain patterns run over its output too; a span found there that holds a rewritten piece is
mapped back to the source characters and added, unless it lies within a plain span of its kind.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters of other scripts that look like ASCII ones. Compatibility forms come from Unicode itself.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "п": "n", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J",
    "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "α": "a", "ο": "o", "ν": "v", "ρ": "p",
    "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "。": ".", "․": ".", "·": ".", "‐": "-", "‑": "-",
    "‒": "-", "–": "-", "−": "-",
}
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# Digits as words of the four languages of the corpus.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5",
    "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
# Ends of host names that a written-out dot may lead to where no at sign stands before the host.
ENDINGS = frozenset("com net org edu gov mil int info biz io dev app ai co me eu de fr es it nl at ch uk us ca br mx ar cl pt pl se".split())
# Endings that are words after "at some point".
_PROSE_ENDINGS = frozenset("at it me us".split())
# Before a written-out dot they tell "look at the dot over there" from a host; no host is named so.
DETERMINERS = frozenset("the a an this that these those each every any some no one which what another its his her my your our their same".split())
# Labels of hosts that serve mail; they tell "john at gmail.com" from "she works at amazon.com".
MAIL_HOSTS = frozenset("gmail googlemail hotmail outlook live yahoo ymail aol icloud proton protonmail gmx mail email webmail correo courriel post".split())
#: Words that announce an address, with no more than two words between.
_CUE = re.compile(
    r"\b(?:e-?mails?|mail|contact|contacts?|reach|write(?:\s+to)?|address|correo|contacto|escrib\w*|courriel|adresse|[ée]cri\w*|kontakt|schreib\w*)\b"
    r"\W{1,4}(?:\w{1,12}\W{1,3}){0,2}$",
    re.IGNORECASE,
)
#: Characters in front of a local part in which a cue is looked for.
CUE_REACH = 60
#: Unicode has no compatibility form of a single ASCII character from here on.
MOST_CODE = 0x20000
#: Words without digits among them must be so many before they are read as digits; no identifier is shorter.
LEAST_SPELLED = 3

_SPELLED_WORD = "(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + ")"
_TOKEN = rf"(?:{_SPELLED_WORD}\b|[0-9]+)"
_OPEN, _CLOSE = r"(?<!\s)\s*+[(\[{<]\s*+", r"\s*+[)\]}>]\s*+"
_AT, _DOT = "(?:at|arroba|arobase|@)", "(?:dot|punto|punkt|point|\\.)"
#: What may stand for an at or a dot sign, and the signs themselves, which lead on to others.
_LINK = re.compile(
    rf"(?P<at>{_OPEN}{_AT}{_CLOSE})|(?P<dot>{_OPEN}{_DOT}{_CLOSE})"
    r"|(?<=[A-Za-z0-9])(?:\s++(?P<at_word>at|arroba|arobase)\s++|(?P<at_spaced>\s++@\s*+|\s*+@\s++)|\s++(?P<dot_word>dot|punto|punkt|point)\s++)(?=[A-Za-z0-9])"
    r"|(?P<at_plain>@)(?=[A-Za-z0-9])|(?P<dot_plain>\.)(?=[A-Za-z0-9])",
    re.IGNORECASE,
)
_LABEL = re.compile(r"[A-Za-z0-9-]*+")
_ENDING = re.compile(r"[A-Za-z]{2,}+|xn--[A-Za-z0-9-]++", re.IGNORECASE)
#: The other steps of the transducer. Sources of a rewritten piece are whole matches.
_PLUS = re.compile(rf"\bplus\s++(?={_TOKEN})", re.IGNORECASE)
_RUN = re.compile(rf"\b{_TOKEN}(?:[ ,.-]{{1,2}}{_TOKEN})+", re.IGNORECASE)
_SPELLED = re.compile(rf"\b{_SPELLED_WORD}\b", re.IGNORECASE)
#: Four numbers of an address, digit by digit, with dots as signs or as words.
_NUMBER = rf"(?:[0-9]{{1,3}}|{_SPELLED_WORD}(?:[ -]{_SPELLED_WORD}){{0,2}})"
_SPELLED_IP = re.compile(
    rf"(?<![0-9A-Za-z])({_NUMBER})" + rf"(?:\s{{1,3}}(?:dot|punto|punkt|point)\s{{1,3}}|\.\s?)({_NUMBER})" * 3 + r"(?![0-9A-Za-z])", re.IGNORECASE
)
#: Signs in a lower-cased text that a step has something to rewrite; each is sought only where its letters occur.
_SPACED = re.compile(r"\s@|@\s")
_BRACKETED = re.compile(rf"[(\[{{<]\s*(?:{_AT}|{_DOT})\s*[)\]}}>]")
_WRITTEN_DOT = re.compile(r"\s(?:dot|punto|punkt|point)\s")
_SPELLED_PAIR = re.compile(rf"{_SPELLED_WORD}[ ,.-]{{1,2}}{_TOKEN}")
_NUMBER_BEHIND_DOT = re.compile(rf"\.(?:\s?{_SPELLED_WORD}\b|(?<=[a-z]\.)\s?[0-9])")
_NUMBER_BEHIND_WORD = re.compile(rf"(?:dot|punto|punkt|point)\s{{1,3}}(?:[0-9]|{_SPELLED_WORD}\b)")
_SPELLED_BEHIND = re.compile(rf"[0-9][ ,.-]{{1,2}}{_SPELLED_WORD}\b")
_WRITTEN_AT = re.compile(r"\s(?:at|arroba|arobase)\s++[a-z0-9-]++\.[a-z0-9]")


def _spelled(text: str) -> bool:
    low = text.lower()
    return bool(_SPELLED_BEHIND.search(low) or _SPELLED_PAIR.search(low))


def _spelled_address(text: str) -> bool:
    low = text.lower()
    return bool(
        _NUMBER_BEHIND_DOT.search(low) or (any(w in low for w in ("dot", "punto", "punkt", "point")) and _NUMBER_BEHIND_WORD.search(low))
    )


def _linked(text: str) -> bool:
    low = text.lower()
    return bool(
        ("@" in low and _SPACED.search(low))
        or (any(c in low for c in "([{<") and _BRACKETED.search(low))
        or (any(w in low for w in ("dot", "punto", "punkt", "point")) and _WRITTEN_DOT.search(low))
        or _WRITTEN_AT.search(low)
    )


@cache
def homoglyphs() -> dict[int, str]:
    """Characters beyond ASCII that stand for one ASCII character, and those without width (an empty string).

    Compatibility forms and decimal digits of all scripts come from Unicode's tables; letters lie below MOST_CODE.
    """
    table = {ord(c): "" for c in INVISIBLE} | {ord(c): s for c, s in LOOKALIKES.items()}
    for code in range(0x80, MOST_CODE):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        if (digit := unicodedata.decimal(char, None)) is not None:
            table.setdefault(code, str(digit))
        elif plain != char and len(plain) == 1 and "!" <= plain <= "~":
            table.setdefault(code, plain)
    return table


@cache
def _glyph_set() -> frozenset[str]:
    return frozenset(map(chr, homoglyphs()))


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain patterns, each kind leftmost and without overlap."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            free = domain.end()
            out.append((0, start, free))
        at = text.find("@", max(at + 1, free))
    if first := _DIGIT.search(text):
        for m in _IP.finditer(text, first.start()):
            if all(len(p) < 4 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text, first.start()):
            digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() <= 37 else ""
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    out.append((3, *m.span()))
    return out


class Normalised:
    """A rewritten text and, for each rewritten piece, its places in the new and in the source text."""

    def __init__(self, source: str):
        self.parts: list[str] = []
        self.new: list[int] = []  # begin in the new text of pieces that are copied or rewritten, in turns
        self.old: list[int] = []
        self.changed: list[bool] = []
        self.length, self.source = 0, source

    def add(self, piece: str, start: int, changed: bool) -> None:
        if piece or changed:
            self.new.append(self.length), self.old.append(start), self.changed.append(changed)
            self.parts.append(piece)
            self.length += len(piece)

    def text(self) -> str:
        return "".join(self.parts)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a span of the new text, and whether it holds a rewritten piece."""
        i, j = bisect_right(self.new, start) - 1, bisect_right(self.new, end - 1) - 1
        begin = self.old[i] if self.changed[i] else self.old[i] + start - self.new[i]
        if self.changed[j]:
            stop = self.old[j + 1] if j + 1 < len(self.old) else len(self.source)
        else:
            stop = self.old[j] + end - self.new[j]
        return begin, stop, any(self.changed[i : j + 1])


def _rewritten(text: str, step: Iterable[tuple[int, int, str]]) -> Normalised:
    out, done = Normalised(text), 0
    for start, end, new in step:
        out.add(text[done:start], done, False)
        out.add(new, start, True)
        done = end
    out.add(text[done:], done, False)
    return out


def _glyphs(text: str) -> Iterator[tuple[int, int, str]]:
    table = homoglyphs()
    for m in re.finditer("[" + "".join(map(re.escape, sorted(_glyph_set() & set(text)))) + "]", text):
        yield m.start(), m.end(), table[ord(m.group())]


class _Link:
    """One match of _LINK, with the label behind it."""

    def __init__(self, m: re.Match):
        kind, _, form = m.lastgroup.partition("_")
        self.sign, self.form, self.start, self.end = "@" if kind == "at" else ".", form, m.start(), m.end()
        self.word = m.group(m.lastgroup).lower() if form == "word" else ""
        self.stop = _LABEL.match(m.string, self.end).end()
        self.label = m.string[self.end : self.stop].lower()
        # Brackets and an at sign with white space are never prose.
        self.rewritten = form in ("", "spaced")


def _listed(link: _Link, text: str) -> bool:
    """Whether a dot leads to a number or a known ending."""
    head, after = link.label.partition("-")[0], text[link.stop : link.stop + 1]
    return (head in ENDINGS or head.isdigit()) and (head != link.label or not (after.isalnum() or after == "_"))


def _ends(at: _Link, before: str, dot: _Link, disguised: bool) -> bool:
    """Whether the label behind a dot can end the host of an at sign; before is the label in front of the dot."""
    if dot.label.isdigit():
        return disguised
    if not _ENDING.fullmatch(dot.label):
        return False
    if dot.word == "point" and at.word == "at":
        return dot.label in ENDINGS - _PROSE_ENDINGS and before not in DETERMINERS
    if dot.word == "point":
        return len(dot.label) == 2 or dot.label in ENDINGS or before not in ENDINGS
    if dot.word and at.word == "at":
        return dot.label in ENDINGS or before not in DETERMINERS
    # Sites are not mail hosts: "visit us at www.example.com".
    return disguised or at.word != "at" or at.label != "www"


def _addressed(text: str, at: _Link, labels: list[str]) -> bool:
    """Whether a bare "at" before a plain host stands in an address and not in prose.

    It does if the host serves mail, if the local part is none of prose (a digit, dot, underscore, plus, percent in it), or
    if a cue announces it and the host ends as hosts do.
    """
    if not MAIL_HOSTS.isdisjoint(labels):
        return True
    start = at.start
    while start > 0 and text[start - 1] in _LOCAL:
        start -= 1
    local = text[start : at.start]
    if any(c in "._+%" or c.isdigit() for c in local.strip(".")) and any(c.isalpha() for c in local):
        return True
    return (labels[-1] in ENDINGS or len(labels[-1]) == 2) and bool(_CUE.search(text[max(0, start - CUE_REACH) : start]))


def _links(text: str) -> Iterator[tuple[int, int, str]]:
    """At and dot signs that are written out, spaced or in brackets. Every link is looked at a fixed number of times."""
    links = [_Link(m) for m in _LINK.finditer(text)]
    follows = [bool(a.label) and a.stop == b.start for a, b in zip(links, links[1:], strict=False)] + [False]
    leads = False
    for i in range(len(links) - 1, -1, -1):  # dots without an at sign before the host
        link = links[i]
        after_number = text[link.start - 1 : link.start].isdigit() or (i > 0 and follows[i - 1] and links[i - 1].label in SPELLED)
        numbers = after_number and (link.label[:1].isdigit() or link.label in SPELLED)
        leads = link.sign == "." and (numbers or _listed(link, text) or (follows[i] and leads))
        link.rewritten |= leads and (link.word != "point" or numbers)
    for i, at in enumerate(links):
        if at.sign != "@":
            continue
        last, j, disguised, chosen = i, i, False, False
        while follows[j] and links[j + 1].sign == ".":
            before, j = links[j].label, j + 1
            disguised |= links[j].form != "plain"
            if _ends(at, before, links[j], disguised):
                last, chosen = j, disguised
        if last > i and at.word == "at" and not chosen:
            ending = text[links[last].end : links[last].stop]
            if ending not in (ending.lower(), ending.upper()) or not _addressed(text, at, [k.label for k in links[i : last + 1]]):
                last = i
        if last == i and not at.rewritten and at.form != "plain":
            continue
        for link in links[i : last + 1]:
            link.rewritten = True
        j = i - 1  # dots of the local part
        while j >= 0 and links[j].sign == "." and links[j].end < links[j + 1].start and _LOCAL.issuperset(text[links[j].end : links[j + 1].start]):
            links[j].rewritten |= links[j].word != "point" or at.word != "at"
            j -= 1
    yield from ((k.start, k.end, k.sign) for k in links if k.rewritten and k.form != "plain")


def _plus(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _PLUS.finditer(text):
        yield m.start(), m.end(), "+"


def _digits(text: str, mixed: bool) -> Iterator[tuple[int, int, str]]:
    """Spelled digits of runs of spelled ones, and if mixed also of runs in which any stands among written ones."""
    for m in _RUN.finditer(text):
        words = [w for w in _SPELLED.finditer(text, *m.span()) if w.group().lower() in SPELLED]
        if len(words) >= LEAST_SPELLED or (mixed and words and _DIGIT.search(m.group())):
            yield from ((w.start(), w.end(), SPELLED[w.group().lower()]) for w in words)


def _addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """Addresses with numbers that are spelled digit by digit."""
    for m in _SPELLED_IP.finditer(text):
        numbers = [_SPELLED.sub(lambda w: SPELLED[w.group().lower()], g).replace(" ", "").replace("-", "") for g in m.groups()]
        if all(n.isdigit() for n in numbers) and any(n != g for n, g in zip(numbers, m.groups(), strict=True)):
            yield m.start(), m.end(), ".".join(numbers)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of disguised identifiers, in characters of the source; none lies within a base span of its kind.

    A base span may be the plain part of a disguised identifier; both are kept then.
    """
    steps, found, last = [], set(), text

    def collect() -> None:
        for kind, start, end in plain_spans(last):
            changed = False
            for step in reversed(steps):
                start, end, own = step.back(start, end)
                changed |= own
            if changed:
                found.add((kind, start, end))

    if not text.isascii() and not _glyph_set().isdisjoint(text):
        steps.append(_rewritten(text, _glyphs(text)))
        last = steps[-1].text()
        collect()
    if _spelled_address(last) and (changes := list(_addresses(last))):
        steps.append(_rewritten(last, changes))
        last = steps[-1].text()
        collect()
    if _linked(last) and (changes := list(_links(last))):
        steps.append(_rewritten(last, changes))
        last = steps[-1].text()
        collect()
    if changes := list(_plus(last)):
        steps.append(_rewritten(last, changes))
        last = steps[-1].text()
        collect()
    # A prose word behind an identifier can spoil it, so each way of reading digits adds what it finds.
    before, seen = last, []
    for mixed in (False, True) if _spelled(before) else ():
        changes = list(_digits(before, mixed))
        if changes != seen:
            steps.append(_rewritten(before, changes))
            last = steps[-1].text()
            collect()
            steps.pop()
        seen = changes
    # Of what lies within another span of its kind, only the other stays.
    out, taken, reach = [], [[s[1:] for s in base if s[0] == k] for k in range(len(KINDS))], [0] * len(KINDS)
    for kind, start, end in sorted(found, key=lambda s: (s[0], s[1], -s[2])):
        at = bisect_right(taken[kind], (start, len(text)))
        if end > reach[kind] and not (at and end <= taken[kind][at - 1][1]):
            out.append((kind, start, end))
        reach[kind] = max(reach[kind], end)
    return out


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end) in code points, end exclusive, by kind and start.

    kind counts in the order of KINDS. Null texts count as empty; other columns are ignored; rows may repeat.
    """
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": k, "start": s, "end": e} for k, s, e in sorted(spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, added = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                own = plain_spans(text)
                base.append(listed(own)), added.append(listed(added_spans(text, own)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, span), pa.array(added, span)], ["doc_id", "base", "added"])

    spans = "array<struct<kind: int, start: bigint, end: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {spans}, added {spans}")


def span_text(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: str) -> str:
    """The text with every span, base or disguised, replaced by the name of its kind; overlaps are merged."""
    base = plain_spans(text)
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in base + added_spans(text, base)):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]
