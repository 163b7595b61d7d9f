"""Personal data in texts, plain and disguised, as spans of the source's characters.

Four kinds are told by their form: e-mail addresses, IPv4 addresses, card numbers (13 to 19
digits that pass Luhn's check) and telephone numbers (a plus sign and 9 to 15 digits). The
``base`` spans are those in the text as it is.

Disguises are undone by a chain of transducers. Each reads the text the one before wrote, and
writes another, with the first and last source character of every character it writes:

1. invisible characters go;
2. look-alikes become what they look like: compatibility forms (full width, mathematical) and
   digits of all scripts by Unicode's own tables, letters of other alphabets, dashes and dots
   by the table below; O and l among digits become 0 and 1;
3. spelled digits, three or more in a row, among digits or as parts of an address, become
   digits (English, German, French, Spanish; double and triple too), and ``plus`` before a
   number becomes +;
4. at and dot become @ and ``.`` where an address results: in brackets; set apart by blanks; or as
   words, if the last part is a common top-level domain and something else speaks for an address
   too: a dot that is a word, a word that only means the sign, AT in capitals, or a local part
   with a letter and a digit or a point in it (*jo.34 at mail.example.com*, not *look at x.com*).

The same four forms are then told in what comes out, and what is found is mapped back: from the
first source character of its first to the last of its last. It is added unless a base span
of its kind holds it already; so base spans stay, and a longer span may lie over one.

All steps are linear in the text: forms are anchored (an address at its @, a number where
its digits begin) and repeat without backtracking, so runs of any length are safe, and whole
texts are read. Offsets are code points, ends exclusive. A null or empty text has no spans.
Rows are independent of one another: repeated rows, null ids and other columns change nothing,
an empty table gives an empty result. Spans come by kind, then start, then end.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from typeferry.llm.common import begin, ship

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
_SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]
    )
)

# The words of digits, the letters of other alphabets with their Latin twins,
# signs used for dashes and dots, and the domains that end an address spelled in words.
DIGIT_WORDS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6,
    "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6,
    "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8,
    "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7,
    "ocho": 8, "nueve": 9,
}
LOOKS_LIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "һ": "h", "ӏ": "l", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ɑ": "a",
    "ⓐ": "@", "Ⓐ": "@",
}
DASHES = "‐‑‒–—―−⁃﹘"
DOTS = "。｡·•∙⋅․۔"
ENDINGS = (
    "com", "org", "net", "edu", "gov", "mil", "info", "biz", "io", "ai", "app", "dev", "eu",
    "de", "at", "ch", "fr", "es", "it", "nl", "be", "pt", "pl", "uk", "us", "ca", "au", "jp",
    "mx", "ar", "co", "br", "ru", "in", "cn",
)

# The forms. Repeats that nothing follows are possessive: the same matches, no backtracking.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Found = list[tuple[int, int, int]]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ has at most one address: the run before it, as far as the last address reaches."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def find(text: str) -> Found:
    """Spans (number of the kind, start, end) in a text as it is."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in _IP.finditer(text) if _DOTTED.search(text) else ():
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _only_digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


# -- transducers -----------------------------------------------------------------------

Edit = tuple[int, int, str]


@dataclass
class Tape:
    """A text with the source span of each of its characters; none while nothing has moved."""

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def edited(self, edits: list[Edit]) -> Tape:
        """Spans replaced, in order and apart; what is written stems from all it replaces."""
        if not edits:
            return self
        starts = np.arange(len(self.text)) if self.starts is None else self.starts
        ends = np.arange(1, len(self.text) + 1) if self.ends is None else self.ends
        text, first, last, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            first += [starts[at:a], np.full(len(new), starts[a])]
            last += [ends[at:a], np.full(len(new), ends[b - 1])]
            at = b
        text.append(self.text[at:])
        first.append(starts[at:])
        last.append(ends[at:])
        return Tape("".join(text), np.concatenate(first), np.concatenate(last))

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])


@cache
def _characters() -> tuple[frozenset[str], dict[int, str], frozenset[str]]:
    """What is invisible; what looks like what; and all that does."""
    table: dict[int, str] = {}
    unseen = [*range(0xFE00, 0xFE10), 0x034F, 0x115F, 0x20E3, 0x3164]
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Cf":
            unseen.append(code)
        elif kind == "Nd":
            table[code] = str(unicodedata.digit(char))
        elif kind not in ("Cn", "Co", "Cs"):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and " " <= plain <= "~":
                table[code] = plain
            elif kind == "Zs":
                table[code] = " "
    table |= {ord(a): b for a, b in LOOKS_LIKE.items()}
    table |= {ord(a): "-" for a in DASHES} | {ord(a): "." for a in DOTS}
    return frozenset(map(chr, unseen)), table, frozenset(map(chr, table))


def unseen_gone(tape: Tape) -> Tape:
    if tape.text.isascii():
        return tape
    here = _characters()[0].intersection(tape.text)
    if not here:
        return tape
    some = re.compile("[" + "".join(map(re.escape, sorted(here))) + "]")
    return tape.edited([(*m.span(), "") for m in some.finditer(tape.text)])


def look_alikes(tape: Tape) -> Tape:
    if tape.text.isascii():
        return tape
    _, table, alike = _characters()
    if not alike.isdisjoint(tape.text):
        tape = Tape(tape.text.translate(table), tape.starts, tape.ends)
    return tape


# O and l in a word of digits that has one digit at least.
_NUMBER_LIKE = re.compile(r"(?<![A-Za-z0-9])(?=[OoIl|]*+[0-9])[0-9OoIl|]{2,}+(?![A-Za-z0-9@])")
_MIXED = re.compile("[0-9][OoIl|]|[OoIl|][0-9]")
_DIGIT = re.compile("[0-9]")
_DIGIT_LIKE = {ord("O"): "0", ord("o"): "0", ord("I"): "1", ord("l"): "1", ord("|"): "1"}


def digit_alikes(tape: Tape) -> Tape:
    if not _DIGIT.search(tape.text) or not _MIXED.search(tape.text):
        return tape
    edits = [
        (*m.span(), m.group().translate(_DIGIT_LIKE))
        for m in _NUMBER_LIKE.finditer(tape.text)
        if not m.group().isdigit()
    ]
    # Character by character, so that spans inside a number keep their places.
    single = [(a + i, a + i + 1, c) for a, _, new in edits for i, c in enumerate(new)]
    return tape.edited(single)


_BEFORE, _AFTER = r"(?<![^\W_])", r"(?![^\W_])"
_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=lambda w: (-len(w), w))) + ")"
_SPOKEN = rf"(?:(?:double|triple)[ -])?{_WORD}{_AFTER}"
_BETWEEN = r"[\s,-]{1,3}"
_SPELLED = re.compile(rf"{_BEFORE}{_SPOKEN}(?:{_BETWEEN}{_SPOKEN}){{2,}}+")
_AMONG_DIGITS = re.compile(
    rf"(?<=[0-9][ -]){_SPOKEN}(?:{_BETWEEN}{_SPOKEN})?+(?=[ -][0-9])"
)
_ONE_SPOKEN = re.compile(rf"(?:(double|triple)[ -])?({_WORD}){_AFTER}")

_OPEN, _SHUT = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_DOT_WORDS = ("dot", "punkt", "punto", "point", "ponto")
_DOT_WORD = f"(?:{'|'.join(_DOT_WORDS)})"
_DOT_IN = rf"{_OPEN}(?:{_DOT_WORD}|\.){_SHUT}"
_DOT_BARE = rf"(?:\s{{1,3}}{_DOT_WORD}\s{{1,3}}|_{_DOT_WORD}_)"
_DOT_APART = r"\s{1,2}\.\s{1,2}"
_HIDDEN_DOT = rf"(?:{_DOT_IN}|{_DOT_BARE})"
_DOT = re.compile(_HIDDEN_DOT)
_OCTET = rf"(?:[0-9]{{1,3}}|{_SPOKEN}(?:{_BETWEEN}{_SPOKEN}){{0,2}})"
_HIDDEN_IP = re.compile(
    rf"(?<![\w.]){_OCTET}(?:(?:\.|{_HIDDEN_DOT}){_OCTET}){{3}}(?![\w])"
)
# What a text without hidden numbers has none of, quick to tell.
_DOT_SIGN = re.compile(r"\.(?<=[^\W\d_]\.)(?=\w)|\.(?=\s{0,3}[\])}>])")
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPOKEN_WORDS = frozenset(w.encode() for w in (*DIGIT_WORDS, "double", "triple"))
_PLUS = re.compile(r"(?<!\w)plus\s{0,2}(?=[(]?[0-9])")


def _lower(text: str) -> str:
    """In lower case, with as many characters."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _as_digits(text: str, start: int, end: int) -> Iterator[Edit]:
    """Spoken digits of a span as digits; what stands between two of them goes."""
    last = None
    for m in _ONE_SPOKEN.finditer(text, start, end):
        if last is not None and re.fullmatch(_BETWEEN, text[last : m.start()]):
            yield last, m.start(), ""
        times = {"double": 2, "triple": 3}.get(m.group(1), 1)
        yield *m.span(), str(DIGIT_WORDS[m.group(2)]) * times
        last = m.end()


def _spoken(low: str) -> tuple[bool, bool]:
    """Whether a text has any words of digits, and whether it may have three in a row."""
    words = low.encode("utf-8", "replace").translate(_LETTERS).split()
    if _SPOKEN_WORDS.isdisjoint(words):
        return False, False
    last = run = 0
    for at, word in enumerate(words, 1):
        if word in _SPOKEN_WORDS:
            run = run + 1 if at == last + 1 else 1
            last = at
            if run == 3:
                return True, True
    return True, False


def spelled_digits(tape: Tape) -> Tape:
    low = _lower(tape.text)
    edits: list[Edit] = []
    some, many = _spoken(low)
    maybe = any(w in low for w in _DOT_WORDS) or _DOT_SIGN.search(low)
    for m in _HIDDEN_IP.finditer(low) if maybe else ():
        dots = [(*d.span(), ".") for d in _DOT.finditer(low, *m.span())]
        if dots or not re.fullmatch(r"[0-9.]+", m.group()):
            edits += sorted([*dots, *_as_digits(low, *m.span())])
    taken = sorted(edits)
    for m in chain(
        _SPELLED.finditer(low) if many else (), _AMONG_DIGITS.finditer(low) if some else ()
    ):
        near = bisect_left(taken, (m.end(),)) - 1  # the last edit that begins before the end
        if near < 0 or taken[near][1] <= m.start():
            edits += _as_digits(low, *m.span())
    return tape.edited(sorted(edits))


def spelled_plus(tape: Tape) -> Tape:
    low = _lower(tape.text)
    if "plus" not in low:
        return tape
    return tape.edited([(*m.span(), "+") for m in _PLUS.finditer(low)])


# The sign or a word for it; then what stands around it decides.
_AT = re.compile(r"@|at(?![^\W_])|arroba(?![^\W_])|arobase(?![^\W_])|klammeraffe(?![^\W_])")
_SHUT_AFTER, _OPEN_BEFORE = re.compile(_SHUT), re.compile(rf"{_OPEN}$")
_BLANK_AFTER, _BLANK_BEFORE = re.compile(r"\s{1,3}"), re.compile(r"\s{1,3}$")
_ANY_DOT = rf"(?:\.|{_HIDDEN_DOT}|{_DOT_APART})"
_PART = re.compile(r"[a-z0-9-]++")
_NEXT_PART = re.compile(rf"(?P<dot>{_ANY_DOT})(?P<part>[a-z0-9-]++)")
_DOT_AT_END = re.compile(rf"{_HIDDEN_DOT}$")
_NAMED = re.compile(r"[0-9]|[A-Za-z0-9][._+][A-Za-z0-9]")  # what makes a word a name
_REACH = 24  # characters that a dot in words can take


def _at_signs(low: str) -> Iterator[tuple[str, int, int]]:
    """Places that may stand for @, and how: plain, inside brackets, bare words, set apart."""
    for m in _AT.finditer(low):
        start, end = m.span()
        sign = low[start] == "@"
        before = low[start - 1] if start else ""
        if not sign and (before.isalnum() or not before):
            continue
        window = max(0, start - 7)  # two blanks of three and a bracket
        opened = _OPEN_BEFORE.search(low[window:start])
        shut = _SHUT_AFTER.match(low, end)
        if opened and shut:
            yield "inside", window + opened.start(), shut.end()
            continue
        left = _BLANK_BEFORE.search(low[window:start])
        right = _BLANK_AFTER.match(low, end)
        first = window + left.start() if left else start
        last = right.end() if right else end
        if sign:
            yield ("apart" if left or right else "plain"), first, last
        elif left and right:
            yield "bare", first, last
        elif before == "_" and low[end : end + 1] == "_":
            yield "bare", start - 1, end + 1


def hidden_addresses(tape: Tape) -> Tape:
    """@ and . for the words and the brackets in addresses."""
    low = _lower(tape.text)
    edits: list[Edit] = []
    upto = 0
    for how, at, after in _at_signs(low):
        if at <= upto or low[at - 1] not in _LOCAL:
            continue
        first = _PART.match(low, after)
        if not first:
            continue
        dots, end, ending = [], first.end(), ""
        while part := _NEXT_PART.match(low, end):
            bare = re.fullmatch(_DOT_APART, part["dot"])
            if bare and (how == "bare" or part["part"] not in ENDINGS):
                break
            if ending in ENDINGS and part["dot"] != "." and part["part"] not in ENDINGS:
                break  # the address is whole; what follows is another sentence's
            dots.append((*part.span("dot"), "."))
            end, ending = part.end(), part["part"]
        hidden = [d for d in dots if low[d[0] : d[1]] != "."]
        if not dots or (how == "plain" and not hidden):
            continue
        if how == "inside":
            good = ending.isalpha() and len(ending) >= 2
        else:
            good = ending in ENDINGS
            if how == "bare" and not hidden:
                good = good and _speaks_for_itself(tape.text, at, after, upto)
        if not good:
            continue
        before = list(_dots_before(low, at, upto))
        edits += [*before, *([] if how == "plain" else [(at, after, "@")]), *hidden]
        upto = end
    return tape.edited(edits)


def _speaks_for_itself(text: str, at: int, after: int, upto: int) -> bool:
    """Whether a word before a plain domain is more than a preposition."""
    word = text[at:after].strip().strip("_")
    if word.lower() != "at":
        return True
    start = at
    while start > upto and text[start - 1] in _LOCAL:
        start -= 1
    local = text[start:at]
    if word == "AT" and local != local.upper():
        return True
    return bool(_NAMED.search(local)) and bool(re.search("[A-Za-z]", local))


def _dots_before(low: str, at: int, upto: int) -> list[Edit]:
    """Dots in words among the parts before an @."""
    found: list[Edit] = []
    start = at
    while True:
        while start > upto and low[start - 1] in _LOCAL:
            start -= 1
        window = max(upto, start - _REACH)
        dot = _DOT_AT_END.search(low[window:start])
        if not dot or window + dot.start() <= upto:
            return found[::-1]
        if low[window + dot.start() - 1] not in _LOCAL:
            return found[::-1]
        found.append((window + dot.start(), start, "."))
        start = window + dot.start()


CHAIN: tuple[Callable[[Tape], Tape], ...] = (
    unseen_gone,
    look_alikes,
    digit_alikes,
    spelled_digits,
    spelled_plus,
    hidden_addresses,
)


def normalised(text: str) -> Tape:
    tape = Tape(text)
    for transducer in CHAIN:
        tape = transducer(tape)
    return tape


def scan(text: str | None) -> list[tuple[int, int, int, bool]]:
    """All spans (number of the kind, start, end, base) of a text, in order."""
    if not text:
        return []
    base = find(text)
    tape = normalised(text)
    added = set()
    if tape.text != text:
        held: dict[int, list[tuple[int, int]]] = {}
        for kind, a, b in base:
            held.setdefault(kind, []).append((a, b))
        for kind, a, b in find(tape.text):
            start, end = tape.source(a, b)
            if not _within(held.get(kind, []), start, end):
                added.add((kind, start, end, False))
    return sorted([*((*s, True) for s in base), *added])


def _within(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the spans, which are in order and apart, holds this one."""
    at = bisect_right(spans, start, key=lambda s: s[0])
    return at > 0 and spans[at - 1][1] >= end


# -- columns ---------------------------------------------------------------------------


def spans(docs: DataFrame, text: str = "text") -> Column:
    """The spans of each text as a column of type ``SPANS``, for a select over ``docs``."""
    ship(docs.sparkSession)

    @F.arrow_udf(SPANS)
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("pii")
        for part in texts:
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in scan(t.as_py())]
                for t in part
            ]
            yield pa.array(rows, _SPANS)

    return of(F.col(text).cast("string"))


def redacted(docs: DataFrame, text: str = "text") -> Column:
    """Each text with what was found in it replaced by the kind in brackets; null stays null."""
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("pii")
        for part in texts:
            yield pa.array([redact(t.as_py()) for t in part], pa.string())

    return of(F.col(text).cast("string"))


def redact(text: str | None) -> str | None:
    if not text:
        return text
    out, at = [], 0
    for a, b, kind in merged(scan(text)):
        out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*out, text[at:]])


def merged(found: list[tuple[int, int, int, bool]]) -> list[tuple[int, int, str]]:
    """Spans that meet put together, under the kind of the first."""
    out: list[tuple[int, int, str]] = []
    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], s[2])):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, KINDS[kind]))
    return out


def joined(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def digest(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, base spans counted by kind and hashed, and all spans."""
    found = docs.select("doc_id", spans(docs, text).alias("found"))
    base = F.filter("found", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[_count(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        (F.size("found") - F.size(base)).cast("long").alias("n_added"),
    )
