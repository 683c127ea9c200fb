"""Personal data in texts, disguised or not, with exact places in the source.

Base detectors find plain e-mail addresses, IP addresses, card and phone numbers. Then transducers
rewrite the text: homoglyphs become ASCII, spelled digits become digits, " (at) " and " dot " become
the characters they stand for, and invisible characters go. Each rewriting keeps for every output
character the source characters it stands for, so the detectors' spans in the rewritten text map
back to the source. Spans that are new are added to the base ones.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base detectors. Runs that cannot match in another way are possessive,
# and a number starts where its digits start, which leaves the matches as they are and the time linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int]


# Base detectors


def emails(text: str) -> list[Span]:
    """Leftmost matches of local@domain: at each @ the local part reaches back as far as it can."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                found.append((start, m.end()))
                end = m.end()
        at = text.find("@", max(at + 1, end))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


DETECTORS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


# Transducers


class Mapped(NamedTuple):
    """A rewritten text; character i stands for the source from ``starts[i]`` to ``ends[i]``."""

    text: str
    starts: np.ndarray
    ends: np.ndarray

    def source(self, span: Span) -> Span:
        return int(self.starts[span[0]]), int(self.ends[span[1] - 1])


def plain(text: str) -> Mapped:
    at = np.arange(len(text))
    return Mapped(text, at, at + 1)


def rewrite(mapped: Mapped, edits: list[tuple[int, int, str]]) -> Mapped:
    """Replace the parts from start to end, given in order, each by a text that stands for the whole part.
    What is replaced by nothing lies inside a span if characters on both sides do."""
    if not edits:
        return mapped
    texts, starts, ends, at = [], [], [], 0
    for low, high, new in edits:
        texts += (mapped.text[at:low], new)
        starts.append(mapped.starts[at:low])
        ends.append(mapped.ends[at:low])
        starts.append(np.full(len(new), mapped.starts[low]))
        ends.append(np.full(len(new), mapped.ends[high - 1]))
        at = high
    texts.append(mapped.text[at:])
    starts.append(mapped.starts[at:])
    ends.append(mapped.ends[at:])
    return Mapped("".join(texts), np.concatenate(starts), np.concatenate(ends))


#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x",
    "у": "y", "п": "n", "в": "b",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "З": "3",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "σ": "o",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ո": "n", "օ": "o", "ս": "u", "հ": "h", "ց": "g",
    "․": ".", "。": ".", "｡": ".", "‧": ".", "·": ".", "∙": ".", "•": ".", "٫": ".",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-", "⁃": "-",
    "﹫": "@", "＠": "@", "﹢": "+", "＋": "+", "⁺": "+",
}
_SPACES = frozenset(map(chr, (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
_INVISIBLE = frozenset(map(chr, (0xAD, 0x34F, 0x180E, *range(0x200B, 0x2010), *range(0x2060, 0x2065), 0xFEFF)))
# what can be a disguise: not the letters of Latin with accents
_ODD = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ɏ]")


def _ascii_of(char: str) -> str | None:
    """What a character stands for; "" if it is invisible, None if for itself."""
    if char in _INVISIBLE:
        return ""
    if char in _SPACES:
        return " "
    known = HOMOGLYPHS.get(char)
    if known is not None:
        return known
    digit = unicodedata.digit(char, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", char)
    return folded if folded != char and folded.isascii() and folded else None


def unmask_homoglyphs(mapped: Mapped) -> Mapped:
    edits = []
    for m in _ODD.finditer(mapped.text):
        new = _ascii_of(m[0])
        if new is not None:
            edits.append((m.start(), m.end(), new))
    return rewrite(mapped, edits)


#: Spelled digits.
DIGITS = {
    "zero": "0", "oh": "0", "null": "0", "zéro": "0", "cero": "0",
    "one": "1", "eins": "1", "un": "1", "uno": "1",
    "two": "2", "zwei": "2", "deux": "2", "dos": "2",
    "three": "3", "drei": "3", "trois": "3", "tres": "3",
    "four": "4", "vier": "4", "quatre": "4", "cuatro": "4",
    "five": "5", "fünf": "5", "cinq": "5", "cinco": "5",
    "six": "6", "sechs": "6", "seis": "6",
    "seven": "7", "sieben": "7", "sept": "7", "siete": "7",
    "eight": "8", "acht": "8", "huit": "8", "ocho": "8",
    "nine": "9", "neun": "9", "neuf": "9", "nueve": "9",
}
_NUMERAL = "|".join(sorted(DIGITS, key=len, reverse=True))
_DOT_NAMES = "dot|point|punkt|punto"
_SPELLED = re.compile(rf"(?<!\w)(?:{_NUMERAL})(?!\w)", re.I)
# letters that match an ASCII letter when case is ignored
_CASES = str.maketrans("ıİſ", "iis")
_ROW = re.compile(
    rf"(?<!\w)(?:{_NUMERAL}|\d+)(?:(?:[\s().,-]{{1,4}}|[ \t]+(?:{_DOT_NAMES})[ \t]+)(?:{_NUMERAL}|\d+))+(?!\w)", re.I
)
_PLUS = re.compile(r"(?<!\w)plus[ \t-]+(?=\d)|\+[ \t]+(?=\d)", re.I)
_POINT = re.compile(
    rf"(?<=\d)(?:[ \t]+(?:{_DOT_NAMES})[ \t]+|[ \t]*[\[({{<][ \t]*(?:{_DOT_NAMES}|\.)[ \t]*[\])}}>][ \t]*)(?=\d)",
    re.I,
)


def unmask_digits(mapped: Mapped) -> Mapped:
    """Rows of spelled digits, closed up, "plus" before digits and "dot" between them."""
    edits = []
    for row in _ROW.finditer(mapped.text):
        last = None
        for m in _SPELLED.finditer(mapped.text, *row.span()):
            if last is not None and mapped.text[last : m.start()].strip(" \t\n-") == "":
                edits.append((last, m.start(), ""))
            edits.append((*m.span(), DIGITS[m[0].translate(_CASES).lower()]))
            last = m.end()
    mapped = rewrite(mapped, edits)
    mapped = rewrite(mapped, [(*m.span(), ".") for m in _POINT.finditer(mapped.text)])
    return rewrite(mapped, [(*m.span(), "+") for m in _PLUS.finditer(mapped.text)])


_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_NAME = r"[A-Za-z0-9._%+-]"
_LABEL = r"[A-Za-z0-9-]+"
# what can only stand for "@", and what is also a word, a mark or a mention in clean prose
_AT_SURE = rf"{_OPEN}(?:at|@|ät|arroba){_CLOSE}|[ \t]+(?:@|ät|arroba)[ \t]+|@[ \t]+|@"
_AT_DOUBT = rf"{_OPEN}a{_CLOSE}|[ \t]+at[ \t]+|[ \t]+@|[ \t]*[_-]+at[_-]+[ \t]*"
_DOT_BOXED = rf"{_OPEN}(?:{_DOT_NAMES}|\.){_CLOSE}"
_DOT_WORD = rf"[ \t]+(?:{_DOT_NAMES})[ \t]+|[ \t]*[_-]+dot[_-]+[ \t]*"
#: Ends of domains that count after a doubtful "at" and a plain or a merely spelled dot; fixed values.
_TOP = r"(?:com|org|net|edu|gov|io|info|biz|co|example|test|invalid|dev|app|ai|me|de|fr|es|uk|us|eu|ch|at|it|nl)"
_HOST = rf"{_LABEL}(?:(?:{_DOT_BOXED}|{_DOT_WORD}|\.){_LABEL})*"
_DISGUISED = re.compile(
    rf"(?<![A-Za-z0-9])(?:{_NAME}+(?:{_DOT_BOXED}|{_DOT_WORD}))*{_NAME}+?(?:"
    rf"(?P<sure>{_AT_SURE}){_HOST}(?:{_DOT_BOXED}|{_DOT_WORD}|\.)[A-Za-z]{{2,}}"
    rf"|(?P<doubt>{_AT_DOUBT}){_HOST}(?:{_DOT_BOXED}[A-Za-z]{{2,}}|(?:{_DOT_WORD}|\.){_TOP})"
    r")(?![A-Za-z0-9-])",
    re.I,
)
_DOT = re.compile(rf"{_DOT_BOXED}|{_DOT_WORD}", re.I)
# what a disguised address has; the long pattern is tried only around it
_HINT = re.compile(
    rf"(?<![a-z])(?:{_DOT_NAMES})(?![a-z])|[\[({{<][ \t]*(?:at|@|a|ät|arroba|\.)[ \t]*[\])}}>]"
    rf"|[_-]at[_-]|[ \t]@|@[ \t]|[ \t](?:at|ät|arroba)[ \t]+{_LABEL}\.[A-Za-z0-9-]",
    re.I,
)
# It sees so much text around that, and more while fewer than _MARGIN words lie between it and a cut: no match
# goes over so many words that it does not contain. Addresses of some thousand characters are not looked for.
_REACH, _FARTHEST, _MARGIN = 200, 6_400, 4


def _around(text: str, bound: int, start: int, stop: int) -> list[re.Match]:
    """Disguised addresses around a hint, not before ``bound``; none is cut off by the part that is looked at."""
    reach = _REACH
    while True:
        low, high = max(bound, start - reach), min(len(text), stop + reach)
        found = list(_DISGUISED.finditer(text, low, high))
        first = min(start, found[0].start()) if found else start
        last = max(stop, found[-1].end()) if found else stop
        cut = (low > bound and len(text[low:first].split()) < _MARGIN) or (
            high < len(text) and len(text[last:high].split()) < _MARGIN
        )
        if not cut or reach >= _FARTHEST:
            return found
        reach *= 2


def unmask_addresses(mapped: Mapped) -> Mapped:
    """ "name (at) host dot org" and the like. After a bracketed "at" any end of two letters or more
    counts. A plain " at " counts only before a disguised dot or a well-known end of a domain."""
    text = mapped.text
    edits, end = [], 0
    for hint in _HINT.finditer(text):
        if hint.start() < end:
            continue
        for m in _around(text, end, *hint.span()):
            form = "sure" if m["sure"] else "doubt"
            at = m.span(form)
            new = []
            if m[form] != "@":
                new.append((*at, "@"))
            for before, after in ((m.start(), at[0]), (at[1], m.end())):
                new += [(*d.span(), ".") for d in _DOT.finditer(text, before, after)]
            edits += sorted(new)
            end = m.end()
    return rewrite(mapped, edits)


# Together


def base_spans(text: str) -> dict[str, list[Span]]:
    return {kind: detect(text) for kind, detect in DETECTORS.items()}


# Of lowered texts, what every match of the transducers contains; a search that starts with a character of
# few kinds is fast.
_DIGIT_GATE = re.compile(
    rf"(?:{_NUMERAL})(?:[\s().,-]|[ \t]+(?:{_DOT_NAMES}))[\s().,-]*(?:{_NUMERAL}|\d)"
    rf"|\d(?:[\s().,-]|[ \t]+(?:{_DOT_NAMES}))[\s().,-]*(?:{_NUMERAL})"
)
# words of texts without _ODD characters, whose letters outside ASCII are all word characters
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() or c == ord("_") else ord(" ") for c in range(256))
_DIGIT_WORDS = frozenset(name.encode() for name in DIGITS)
_POINT_GATE = re.compile(rf"\d[ \t]*(?:[\[({{<]|[ \t](?:{_DOT_NAMES}))")
_BOX_GATE = re.compile(r"[\[({<][ \t]*(?:at|@|a|ät|arroba|\.)[ \t]*[\])}>]")
_AT_GATE = re.compile(r"[ \t](?:at|ät|arroba)[ \t]+[a-z0-9-]+\.[a-z0-9-]")
_HINT_TEXTS = (*_DOT_NAMES.split("|"), "@", "_at", "-at")


def suspicious(text: str) -> bool:
    """Whether a transducer can change anything: true for every text that one changes, and for few others."""
    if not text.isascii():
        if _ODD.search(text):
            return True
        if any(c in text for c in "ıİſ"):
            text = text.translate(_CASES)
    lower = text.lower()
    words = lower.encode().translate(_WORDS).split()
    if not _DIGIT_WORDS.isdisjoint(words) and _DIGIT_GATE.search(lower):
        return True
    if _BOX_GATE.search(lower) or _AT_GATE.search(lower):
        return True
    if ("+" in lower or "plus" in lower) and _PLUS.search(text):
        return True
    if _POINT_GATE.search(lower) and _POINT.search(text):
        return True
    return any(h in lower for h in _HINT_TEXTS) and _HINT.search(text) is not None


def all_spans(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Base spans, and those in the rewritten text that do not overlap a base span of their kind."""
    if not suspicious(text):
        return base
    latin = unmask_homoglyphs(plain(text))
    digits = unmask_digits(latin)
    found = {kind: list(spans) for kind, spans in base.items()}
    for mapped in (latin, unmask_addresses(latin), digits, unmask_addresses(digits)):
        if mapped.text == text:
            continue
        for kind, detect in DETECTORS.items():
            for span in detect(mapped.text):
                low, high = mapped.source(span)
                if all(high <= a or b <= low for a, b in found[kind]):
                    found[kind].append((low, high))
    return {kind: sorted(spans) for kind, spans in found.items()}


def as_text(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each kind, the digest of the base spans and all spans, as code
    points of the source with the end excluded.

    Each text is worked on whole and alone, without a shuffle. A null or empty text has no spans.
    Repeated rows are each answered, null ids passed on, other columns not read, and an empty
    table gives no rows. A rewritten span is added unless it overlaps a base or earlier one of its kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                counts, digests, texts = [], [], []
                for text in part["text"].to_pylist():
                    base = base_spans(text)
                    spans = all_spans(text, base)
                    counts.append([len(spans[k]) for k in KINDS] + [len(base[k]) for k in KINDS])
                    digests.append(hashlib.sha256(as_text(base).encode()).hexdigest())
                    texts.append(as_text(spans))
                numbers = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], *numbers[:4], pa.array(digests), pa.array(texts), *numbers[4:]], _NAMES
                )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(run, _RESULT)


_RESULT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string,"
    " base_email bigint, base_ip bigint, base_card bigint, base_phone bigint"
)
_NAMES = [f.split()[0] for f in _RESULT.split(",")]
