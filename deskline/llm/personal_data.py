"""Personal data in texts, also where it is disguised, with the places in the source.

Plain identifiers are found in the text as it is. For disguised ones, transducers rewrite
the text one after the other: look-alike characters become the ASCII they stand for, "at"
and "dot" disguises the marks, and spelled digits digits. Each keeps where every output
character came from. The same patterns then run over the rewritten text, and what they
find is led back through the transducers to code points of the source.

All steps take time in proportion to the text, whatever it holds: patterns are possessive
or bounded, and start where their first sign is.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# Texts of a batch that are decoded together.
_TOGETHER = 256

Span = tuple[int, int]

# -- plain identifiers ------------------------------------------------------------

_LOCAL = "".join(chr(c) for c in range(128) if chr(c).isalnum()) + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Runs of digits; group 1 is there where four of them make up an address.
_IP = re.compile(r"[0-9][0-9]*+(\.[0-9]++\.[0-9]++\.[0-9]++)?+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT, _NOT_DIGITS = re.compile("[0-9]"), re.compile("[^0-9]+")


def emails(text: str) -> list[Span]:
    """A match holds one "@" with the longest possible part before it, so the text is
    looked at from sign to sign."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = end + len(text[end:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        end = domain.end() if domain else at + 1
        if domain:
            found.append((start, end))
        at = text.find("@", end)
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the plain identifiers, leftmost and without overlap
    within a kind, in the order of ``start`` and then of :data:`KINDS`."""
    found = [("email", s, e) for s, e in emails(text)]
    digit = _DIGIT.search(text)
    if not digit:
        return found
    for m in _IP.finditer(text, digit.start()):
        if m[1] and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text, digit.start()):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=_order)


def _order(span: tuple) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


# -- transducers --------------------------------------------------------------------


class Edits:
    """The output of a transducer, ``text``, and the way back to its input."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        """``edits``: start, end and replacement, in order and without overlap."""
        parts, self.out, self.out_end, self.into, self.into_end = [], [], [], [], []
        done = size = 0
        for start, end, new in edits:
            parts += [source[done:start], new]
            size += start - done
            self.out.append(size)
            size += len(new)
            self.out_end.append(size)
            self.into.append(start)
            self.into_end.append(end)
            done = end
        self.text = "".join([*parts, source[done:]])

    def back(self, start: int, end: int) -> Span:
        """The characters of the input that the output from ``start`` to ``end`` is of."""
        return self._place(start)[0], self._place(end - 1)[1]

    def _place(self, at: int) -> Span:
        i = bisect_right(self.out, at) - 1
        # Of edits at one place, those without output come before the one that has some.
        if i < 0:
            return at, at + 1
        if at < self.out_end[i]:
            return self.into[i], self.into_end[i]
        at += self.into_end[i] - self.out_end[i]
        return at, at + 1


class Folded:
    """A text with every look-alike character replaced by the ASCII it stands for."""

    def __init__(self, source: str):
        alike = _look_alikes()
        self.text = source.translate(alike.table)
        self.ends = np.cumsum(alike.lengths[_codes(source)], dtype=np.int64)

    def back(self, start: int, end: int) -> Span:
        return int(np.searchsorted(self.ends, start, "right")), int(np.searchsorted(self.ends, end - 1, "right")) + 1


# Letters and marks of other scripts that look like ASCII ones. Compatibility
# forms, digits, dashes, spaces and invisible characters follow from their properties.
_HOMOGLYPHS = {
    "a": "аɑα", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡց", "h": "һ", "i": "іɩι", "j": "јϳ",
    "k": "κ", "l": "ӏ", "n": "ոη", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "τ", "u": "սυ",
    "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙӀ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν",
    "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "УΥ", "Z": "Ζ",
    ".": "。۔", "-": "−⁃",
}


def _look_alikes() -> types.ModuleType:
    """``table``: what each look-alike stands for; ``lengths``: how many characters any
    character becomes; ``alike``: whether it is one. Made once by each worker."""
    shared = sys.modules.setdefault("_deskline_look_alikes", types.ModuleType("_deskline_look_alikes"))
    if hasattr(shared, "alike"):
        return shared
    table = {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200), *range(0x1FBF0, 0x1FBFA)):
        char = chr(code)
        kind, plain = unicodedata.category(char), unicodedata.normalize("NFKC", char)
        if kind == "Cf" or 0xFE00 <= code < 0xFE10 or code == 0x34F:
            table[code] = ""
        elif kind == "Zs":
            table[code] = " "
        elif kind == "Pd":
            table[code] = "-"
        elif kind == "Nd":
            table[code] = str(unicodedata.decimal(char))
        elif plain.isascii() and plain.isprintable():
            table[code] = plain
    table.update({ord(c): plain for plain, like in _HOMOGLYPHS.items() for c in like})
    lengths, alike = np.ones(0x110000, np.uint8), np.zeros(0x110000, bool)
    for code, plain in table.items():
        lengths[code], alike[code] = len(plain), True
    shared.table, shared.lengths, shared.alike = table, lengths, alike
    return shared


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


# How "@" and "." are written out. Some are everyday words and count only
# in brackets or before the last part of a domain.
_AT_WORDS = ("at", "arroba", "arobase", "klammeraffe")
_DOT_WORDS = ("dot", "punkt", "punto", "point")
_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "eu", "uk", "us", "de", "at", "ch", "fr", "be", "es", "mx", "it", "nl", "pt", "ca")
_NO_NAMES = frozenset(
    "us me him her them it is are was were be look looking located available found online site website page meet visit here there shop"
    " read more live order now book only".split()
)

_GAP = r"[\s_-]{1,3}"
_PAD = r"\s{0,3}"
_SPACED_DOT = rf"(?:{_GAP}dot{_GAP}|{_GAP}(?:{'|'.join(_DOT_WORDS[1:])}){_GAP}(?=(?:{'|'.join(_ENDINGS)})\b|[0-9]))"
_BOXED_DOT = rf"{_PAD}[\[({{<]{_PAD}(?:\.|{'|'.join(_DOT_WORDS)}){_PAD}[\])}}>]{_PAD}"
_CODED_DOT = r"&\#0{0,5}46;|&\#x0{0,5}2e;|&period;"
_BOXED_AT = rf"{_PAD}[\[({{<]{_PAD}(?:@|{'|'.join(_AT_WORDS)}){_PAD}[\])}}>]{_PAD}"
_CODED_AT = r"&\#0{0,5}64;|&\#x0{0,5}40;|&commat;|%40"
_LABEL = "[A-Za-z0-9-]{1,63}"
_MARKS = re.compile(
    rf"""(?ix)
    (?P<dot>{_BOXED_DOT} | {_CODED_DOT} | (?<=[a-z0-9]){_SPACED_DOT}(?=[a-z0-9]))
    | (?P<at>{_BOXED_AT} | {_CODED_AT})
    | (?<=[a-z0-9])(?P<spaced>(?P<gap>{_GAP})(?P<word>{'|'.join(_AT_WORDS)}){_GAP} | \s{{1,3}}@\s{{0,3}} | @\s{{1,3}})
      (?P<domain>{_LABEL}(?:(?:\.|{_SPACED_DOT}|{_BOXED_DOT}|{_CODED_DOT}){_LABEL}){{1,9}})
    """
)
# Words, and marks with what has to be behind them, without which there is no disguise.
_MARK_WORDS = (*_DOT_WORDS, *_AT_WORDS[1:])
_MARK_SIGNS = re.compile(r"[\[({<]\s{0,3}(?:@|\.|at)|&(?:\#|commat|period)|%40|\s@|@\s")
_DISGUISED_DOT = re.compile(rf"(?i){_SPACED_DOT}|{_BOXED_DOT}|{_CODED_DOT}")
_NAME_BEFORE = re.compile(r"[A-Za-z]+$")


def marks(text: str) -> list[tuple[int, int, str]]:
    """Edits that put "@" and "." for their disguises.

    A bare "at" counts only before a domain whose dots are disguised too, and not after
    words such as "us": "look at example.com" and "visit us at example dot com" are prose.
    """
    low = text.lower()
    if not any(word in low for word in _MARK_WORDS) and not (any(sign in low for sign in "[({<&%@") and _MARK_SIGNS.search(low)):
        return []
    found, at = [], 0
    while m := _MARKS.search(text, at):
        at = m.end()
        if m["dot"] is not None:
            found.append((m.start("dot"), m.end("dot"), "."))
        elif m["at"] is not None:
            found.append((m.start("at"), m.end("at"), "@"))
        else:
            start, end = m.span("spaced")
            at = end
            if m["word"]:
                before = _NAME_BEFORE.search(text, max(0, start - 20), start)
                if not _DISGUISED_DOT.search(m["domain"]) or (before and before[0].lower() in _NO_NAMES):
                    continue
            found.append((start, end, "@"))
    return found


# The digits from 0 on, as they are spelled in English, German, French, Spanish.
_SPELLED = (
    "zero oh null zéro cero", "one eins un uno", "two zwei zwo deux dos", "three drei trois tres", "four vier quatre cuatro",
    "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
)
_DIGIT_OF = {word: str(digit) for digit, words in enumerate(_SPELLED) for word in words.split()}
_TIMES = {"double": 2, "triple": 3}
_WORD = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
_BETWEEN = r"[\s,;/_.-]{1,3}"
_ITEM = rf"(?:(?:double|triple)\s{{1,3}})?(?:{_WORD})\b"
_RUN = re.compile(rf"(?i)\b(?P<plus>plus{_BETWEEN})?(?P<items>(?:{_ITEM}|[0-9]++)(?:{_BETWEEN}(?:{_ITEM}|[0-9]++))+)")
_ONE_ITEM = re.compile(rf"(?i)(?:(?P<times>double|triple)\s{{1,3}})?(?P<word>{_WORD})\b|(?P<digits>[0-9]+)")
_MIXED = re.compile(r"[0-9](?:(?=[OoIl])|(?<=[OoIl].))")
_DIGIT_LIKE = re.compile(r"(?<![A-Za-z0-9])[0-9OoIl]++(?:[\x20.()-]{0,2}[0-9OoIl]++)*+")
_TOKEN = re.compile("[0-9OoIl]+")
_LIKE = str.maketrans("OoIl", "0011")


def _may_spell(text: str) -> bool:
    """Whether a spelled digit has another digit beside it."""
    low = text.lower()
    for mark in ",;/_.-":
        if mark in low:
            low = low.replace(mark, " ")
    words = low.split()
    if _DIGIT_OF.keys().isdisjoint(words):
        return False
    before = digit = False
    for word in words:
        now = word in _DIGIT_OF
        if before and (now or word[0].isdigit() or word in _TIMES) or now and digit:
            return True
        before, digit = now, word[-1].isdigit()
    return False


def spelled(text: str) -> list[tuple[int, int, str]]:
    """Edits that put digits for runs of spelled ones, and join them; "plus" in front
    becomes "+". A word by itself stays."""
    if not _may_spell(text):
        return []
    found = []
    for run in _RUN.finditer(text):
        items = list(_ONE_ITEM.finditer(text, run.start("items"), run.end("items")))
        if len(items) < 3 or not any(i["word"] for i in items):
            continue
        if run["plus"]:
            found.append((run.start("plus"), run.end("plus"), "+"))
        last = None
        for item in items:
            if last is not None and last.end() < item.start():
                between = text[last.end() : item.start()]
                joined = "." if "." in between else "" if item["word"] and last["word"] else " "
                if joined != between:
                    found.append((last.end(), item.start(), joined))
            if item["word"]:
                digits = _DIGIT_OF[item["word"].lower()] * _TIMES.get((item["times"] or "").lower(), 1)
                found.append((item.start(), item.end(), digits))
            last = item
    return found


def letters_for_digits(text: str) -> list[tuple[int, int, str]]:
    """Edits that put digits for the letters O and l between digits of a long number."""
    if not _MIXED.search(text):
        return []
    found = []
    for run in _DIGIT_LIKE.finditer(text):
        tokens = list(_TOKEN.finditer(text, run.start(), run.end()))
        if text[run.end() : run.end() + 1].isalnum():
            tokens.pop()  # the beginning of a word
        if sum(c.isdigit() for t in tokens for c in t[0]) < 4:
            continue
        for t in tokens:
            if any(c.isdigit() for c in t[0]) and not t[0].isdigit():
                found.append((t.start(), t.end(), t[0].translate(_LIKE)))
    return found


def disguised(text: str, plain: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, identifier)`` of what only the rewritten text shows. A span
    that meets a plain one of its kind is left out, unless it covers it and more."""
    way: list[Folded | Edits] = []
    now = text
    if not text.isascii() and _look_alikes().alike[_codes(text)].any():
        way.append(Folded(text))
        now = way[-1].text
    for transducer in (marks, letters_for_digits, spelled):
        if edits := transducer(now):
            way.append(Edits(now, edits))
            now = way[-1].text
    if not way:
        return []
    own = {kind: [(s, e) for k, s, e in plain if k == kind] for kind in KINDS}
    ends = {kind: [e for _, e in spans] for kind, spans in own.items()}
    found = []
    for kind, start, end in identifiers(now):
        value = now[start:end]
        for step in reversed(way):
            start, end = step.back(start, end)
        near = own[kind][bisect_right(ends[kind], start) :]
        met = []
        for s, e in near:
            if s >= end:
                break
            met.append((s, e))
        if not met or (all(start <= s and e <= end for s, e in met) and (start, end) != met[0]):
            found.append((kind, start, end, value))
    return found


# -- operator -----------------------------------------------------------------------

SPANS = "array<struct<kind:string,start:long,stop:long,identifier:string,plain:boolean>>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``id``, ``spans`` and ``masked``.

    A span has ``kind`` (:data:`KINDS`), ``start`` and ``stop`` (code points of the source,
    end exclusive), ``identifier`` (as the patterns saw it) and ``plain`` (found in the
    text as it is). Plain spans of one kind do not overlap. Spans are in the order of
    start, kind and stop. ``masked`` is the text with every span, or run of spans that
    overlap, replaced by the kind of the first, like ``[EMAIL]``.

    Null texts count as empty. Empty texts have no spans. Ids may be null or repeated:
    each row is looked at by itself. Other columns are not read, whatever their names. An
    empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    struct = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("identifier", pa.string()), ("plain", pa.bool_())]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(begin, _TOGETHER)
                spans, masked = [], []
                for text in part.column("text").to_pylist():
                    plain = identifiers(text)
                    both = [(k, s, e, text[s:e], True) for k, s, e in plain]
                    both += [(*span, False) for span in disguised(text, plain)]
                    both.sort(key=_order)
                    spans.append([dict(zip(("kind", "start", "stop", "identifier", "plain"), span)) for span in both])
                    masked.append(_masked(text, both))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(spans, pa.list_(struct)), pa.array(masked, pa.string())], ["id", "spans", "masked"]
                )

    return rows.mapInArrow(each, f"id {id_type}, spans {SPANS}, masked string")


def _masked(text: str, spans: list[tuple]) -> str:
    if not spans:
        return text
    edits: list[list] = []
    for kind, start, end, *_ in spans:
        if edits and start < edits[-1][1]:
            edits[-1][1] = max(edits[-1][1], end)
        else:
            edits.append([start, end, f"[{kind.upper()}]"])
    return Edits(text, [tuple(e) for e in edits]).text
