"""Personal data found in disguise, with offsets in the source text.

The plain patterns run on the text as it is.  Then a chain of transducers
rewrites it: look-alike characters become ASCII and invisible ones vanish,
spelled digits become digits, and at/dot disguises become signs.  Every
character of the rewritten text knows the source characters it came from, so an
identifier found there is mapped back to a span of the source.  Such a span is
added if every plain span that it touches lies inside it and is shorter, and if
it touches no other added span.  Texts that hold nothing to rewrite skip the
chain.  Time is linear in the length of a text, whatever it holds.

Offsets count code points, the end is exclusive.  A null text is the empty text
and has no spans; texts of any length are read whole; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm import common

KINDS = ("email", "ip", "card", "phone")

# fixed values: the plain patterns
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# (a match inside a run of digits would also be one from the start of the run)
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile("[0-9]")

# look-alikes of Latin letters that no rule below gives
LOOK_ALIKES = dict(zip("авеіјкмнорсѕтухһԁԛԝАВЕЗІЈКМНОРСЅТУХαβερικνοτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡℓ",
                       "abeijkmhopcstyxhdqwABE3IJKMHOPCSTYXabepiknotuxABEZHIKMNOPTYXigl"))
INVISIBLE = "­​‌‍⁠﻿"
SIGNS = {"﹫": "@", "․": ".", "。": ".", "｡": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹣": "-",
         "﹢": "+", " ": " ", " ": " ", " ": " ", "　": " "}
# fixed values: spelled digits in English, French, German and Spanish
DIGIT_NAMES = (
    "zero oh zéro null cero", "one un une eins uno", "two deux zwei zwo dos", "three trois drei tres",
    "four quatre vier cuatro", "five cinq fünf cinco", "six sechs seis", "seven sept sieben siete",
    "eight huit acht ocho", "nine neuf neun nueve")
DIGIT_WORDS = {w: str(i) for i, names in enumerate(DIGIT_NAMES) for w in names.split()}
TIMES = {"double": 2, "triple": 3}


def _any_of(words) -> str:
    """A pattern of these words that looks at the first letter once."""
    by: dict[str, list[str]] = {}
    for w in sorted(words):
        by.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by.items()) + ")"


_word = rf"(?:(?:{'|'.join(TIMES)})[\s-])?{_any_of(DIGIT_WORDS)}(?![^\W_])"
# spelled digits in a row, digits in between allowed
SPELLED = re.compile(rf"\b(?=[{''.join(sorted({w[0] for w in (*DIGIT_WORDS, *TIMES)}))}])"
                     rf"{_word}(?:[\s,.-]{{1,3}}(?:{_word}|[0-9]+))*[\s,.-]{{1,3}}{_word}", re.I)
SPELLED_PART = re.compile(rf"{_word}|[0-9]+", re.I)
# articles and the like, a number or an hour
NOT_A_HOST = (r"(?!(?:the|an?|this|that|each|every|my|our|your|his|her|its|their|one)\b)"
              r"(?![0-9.]+(?:[ap]m)?\b(?![.-]?[A-Za-z0-9]))")
_dot = r"(?:\.|[(\[{<]\s*(?:dot|\.)\s*[)\]}>]|\bdot\b)"
_host = rf"(?=[A-Za-z0-9-]+(?:\s*{_dot}\s*[A-Za-z0-9-]+)+)"
# a bracketed, underscored or spaced at between two names; white space before a
# bracket belongs to it (see _with_space)
AT = re.compile(r"[(\[{<]\s*(?:at|@)\s*[)\]}>]\s*|(?<=[A-Za-z0-9])[_-]at[_-](?=[A-Za-z0-9])"
                r"|(?<=[A-Za-z0-9])\s+(?:at|@)\s+" + NOT_A_HOST + _host
                + r"|(?<=[A-Za-z0-9])(?:\s+@\s*|@\s+)" + _host, re.I)
DOT = re.compile(r"[(\[{<]\s*(?:dot|\.)\s*[)\]}>]\s*|(?<=[A-Za-z0-9])[_-]dot[_-](?=[A-Za-z0-9])"
                 r"|(?<=[A-Za-z0-9])\s+dot\s+(?=[A-Za-z0-9])", re.I)
_number_dot = r"(?:\.|\s*[(\[{<]\s*(?:dot|\.)\s*[)\]}>]\s*|[_-]dot[_-]|\s+dot\s+)"
# four numbers with dots between them, spoken or bracketed ones too
NUMBERS = re.compile(rf"(?<![0-9])([0-9]+)({_number_dot})([0-9]+)({_number_dot})([0-9]+)({_number_dot})([0-9]+)", re.I)
# what may stand between two dots, behind and before an at
LABELS = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+")
# holds wherever AT or DOT does
TRIGGER = re.compile(r"[(\[{<]\s*(?:at|dot|@|\.)\s*[)\]}>]|\b(?:at|dot)\b|[_-](?:at|dot)[_-]|\s@|@\s", re.I)


def _compatible() -> dict[str, str]:
    """Characters that are forms of ASCII letters, digits and signs (wide,
    mathematical, circled, ...), without raised and lowered ones."""
    out = {}
    for code in range(0x80, 0x20000):
        c = chr(code)
        form = unicodedata.decomposition(c)
        if form[:1] == "<" and not form.startswith(("<super>", "<sub>", "<fraction>")):
            new = unicodedata.normalize("NFKC", c)
            if new.isascii() and (len(new) == 1 or new.isalnum()):
                out[c] = new
        if c not in out and (digit := unicodedata.decimal(c, None)) is not None:
            out[c] = str(digit)
    return out


LIKE = _compatible() | LOOK_ALIKES | SIGNS | dict.fromkeys(INVISIBLE, "")


def _ranges(chars) -> str:
    """A character class of single characters as ranges."""
    out, codes = "", sorted(map(ord, chars))
    first = last = codes[0]
    for c in codes[1:] + [0x110000]:
        if c != last + 1:
            out += re.escape(chr(first)) + (f"-{re.escape(chr(last))}" if last > first else "")
            first = c
        last = c
    return out


ODD = re.compile("[" + _ranges(LIKE) + "]")


class Traced:
    """A text whose characters know the span of source characters they stand for."""

    def __init__(self, text: str, start: list[int] | None = None, end: list[int] | None = None):
        self.text = text
        self.start = list(range(len(text))) if start is None else start
        self.end = list(range(1, len(text) + 1)) if end is None else end

    def rewrite(self, parts: list[tuple[int, int, str]]) -> "Traced":
        """Replace ranges, given in order; a new character stands for its whole range."""
        text, start, end, at = [], [], [], 0
        for a, b, new in parts:
            text += [self.text[at:a], new]
            start += self.start[at:a] + [self.start[a]] * len(new)
            end += self.end[at:a] + [self.end[b - 1]] * len(new)
            at = b
        return Traced("".join(text) + self.text[at:], start + self.start[at:], end + self.end[at:])

    def span(self, a: int, b: int) -> tuple[int, int]:
        return self.start[a], self.end[b - 1]


def look_alikes(t: Traced) -> Traced:
    return t.rewrite([(m.start(), m.end(), LIKE[m.group()]) for m in ODD.finditer(t.text)])


def _spelled(part: str) -> str | None:
    """The digits of a digit word with or without "double" or "triple"."""
    words = re.split(r"[\s-]", part.lower())
    digit = DIGIT_WORDS.get(words[-1])
    return digit and digit * (TIMES[words[0]] if len(words) > 1 else 1)


def spelled_digits(t: Traced) -> Traced:
    """Three or more spelled digits in a row become digits without what stands
    between them."""
    parts = []
    for m in SPELLED.finditer(t.text):
        at = m.start()
        found = [(p.start(), p.end(), _spelled(p.group())) for p in SPELLED_PART.finditer(t.text, m.start(), m.end())]
        if sum(len(new or "") for _, _, new in found) < 3:
            continue
        for a, b, new in found:
            if at < a:
                parts.append((at, a, ""))
            if new is not None:
                parts.append((a, b, new))
            at = b
    return t.rewrite(parts)


def _with_space(pattern: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Matches, those that begin with a bracket with the white space before it."""
    out, end = [], 0
    for m in pattern.finditer(text):
        a = m.start()
        if text[a] in "([{<":
            while a > end and text[a - 1].isspace():
                a -= 1
        end = m.end()
        out.append((a, end))
    return out


def at_and_dot(t: Traced) -> Traced:
    """Signs for at and dot: dots only in the unbroken chain of words on either
    side of an at, and between the four numbers of an address."""
    t = t.rewrite([(a, b, "@") for a, b in _with_space(AT, t.text)])
    dots: set[tuple[int, int]] = set()
    ats = [m.start() for m in re.finditer("@", t.text)]
    found = _with_space(DOT, t.text) if ats else []
    starts = [a for a, _ in found]
    for k, at in enumerate(ats):
        before = ats[k - 1] if k else -1
        after = ats[k + 1] if k + 1 < len(ats) else len(t.text)
        first = bisect.bisect_left(starts, at + 1)
        pos, i = at + 1, first
        while i < len(found) and found[i][0] < after and LABELS.fullmatch(t.text, pos, found[i][0]):
            dots.add(found[i])
            pos, i = found[i][1], i + 1
        pos, i = at, first - 1
        while i >= 0 and before < found[i][1] < pos and LOCAL_PART.fullmatch(t.text, found[i][1], pos):
            dots.add(found[i])
            pos, i = found[i][0], i - 1
    for m in NUMBERS.finditer(t.text):
        if _is_ip(".".join(m.group(1, 3, 5, 7))):
            dots.update(m.span(i) for i in (2, 4, 6) if m.group(i) != ".")
    parts, end = [], 0
    for a, b in sorted(dots):
        if a >= end:
            parts.append((a, b, "."))
            end = b
    return t.rewrite(parts)


def normalise(text: str) -> Traced | None:
    """The rewritten text, or None if there is nothing to rewrite."""
    odd = not text.isascii() and ODD.search(text) is not None
    t = look_alikes(Traced(text)) if odd else None
    plain = t.text if odd else text
    if SPELLED.search(plain):
        t = spelled_digits(t or Traced(text))
        plain = t.text
    if TRIGGER.search(plain):
        t = at_and_dot(t or Traced(text))
    return t


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of EMAIL, found from the at signs on."""
    out, pos = [], 0
    while (at := text.find("@", pos)) >= 0:
        a = at
        while a > pos and text[a - 1] in LOCAL:
            a -= 1
        m = EMAIL.match(text, a) if a < at else None
        if m:
            out.append((a, m.end()))
        pos = m.end() if m else at + 1
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def _is_card(s: str) -> bool:
    digits = s.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(s: str) -> bool:
    return 10 <= sum("0" <= c <= "9" for c in s) <= 15


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain patterns, by start, then kind as listed."""
    out = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern, good in ((1, IP, _is_ip), (2, CARD, _is_card), (3, PHONE, _is_phone)):
            out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if good(m.group())]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


def find_all(text: str) -> tuple[list, list]:
    """Plain spans, and all spans with those found in disguise."""
    plain = find(text)
    t = normalise(text)
    if t is None:
        return plain, plain
    added: list[tuple[int, int, str]] = []
    starts, ends = [s for s, _, _ in plain], [e for _, e, _ in plain]
    reach = list(itertools.accumulate(ends, max))  # furthest end so far
    taken = 0  # end of the last added span
    for a, b, kind in sorted(find(t.text), key=lambda s: (s[0], -s[1])):
        x, y = t.span(a, b)
        if x < taken:
            continue
        i, good = bisect.bisect_left(starts, y) - 1, True
        while good and i >= 0 and reach[i] > x:  # plain spans that begin before y and may end after x
            if ends[i] > x:
                good = x <= starts[i] and ends[i] <= y and ends[i] - starts[i] < y - x
            i -= 1
        if good:
            added.append((x, y, kind))
            taken = y
    return plain, sorted(plain + added, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts and digest of the plain spans,
    number of added spans, and all spans."""
    def run(batch: pa.RecordBatch) -> dict:
        common.worker_state("personal data", dict)  # nothing to remember; drops what others did
        found = [find_all(t) for t in common.texts_of(batch)]
        out = {"doc_id": batch.column(0)}
        for k in KINDS:
            out[f"n_{k}"] = [sum(s[2] == k for s in plain) for plain, _ in found]
        out["n_added"] = [len(every) - len(plain) for plain, every in found]
        out["base_sha256"] = [hashlib.sha256(listed(plain).encode()).hexdigest() for plain, _ in found]
        out["spans"] = [listed(every) for _, every in found]
        return out

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, " + ", ".join(
        f"n_{k} long" for k in KINDS) + ", n_added long, base_sha256 string, spans string")


def mask(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind; n_chars, where it is
    a whole-number column, follows the new text.  A null text stays null."""
    def run(batch: pa.RecordBatch) -> dict:
        common.worker_state("personal data", dict)  # nothing to remember; drops what others did
        raw = batch.column(batch.schema.get_field_index("text")).to_pylist()
        new = [None if t is None else masked(t, find_all(t)[1]) for t in raw]
        return {common.OWN + "text": pa.array(new, pa.string())}

    out = common.add_columns(docs, run, common.OWN + "text string")
    types = {f.name: f.dataType for f in docs.schema.fields}
    new = F.col(common.OWN + "text")
    changed = ~new.eqNullSafe(F.col("text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(new.alias(c))
        elif c == "n_chars" and isinstance(types[c], (T.LongType, T.IntegerType)):
            columns.append(F.when(changed, F.length(new).cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)
