"""Personal data in texts, also disguised, at its place in the source.

Plain identifiers are found in the text as it is. Disguised ones are found in a
normalised reading of it: transducers replace homoglyphs, drop invisible characters,
turn spelled digits into digits and at/dot disguises into signs. Each transducer knows
which source characters every piece of its output came from, so a span found in the
last output is mapped back through all of them.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the first digit of its run, tested after it so that the search can skip to digits
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters that look like Latin ones, and signs that stand for plain signs.
_LOOKALIKES = {
    **dict(zip("авекмнорстухіјѕԁԛԝ", "abekmhopctyxijsdqw")),
    **dict(zip("АВЕКМНОРСТУХІЈЅ", "ABEKMHOPCTYXIJS")),
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX")),
    **dict(zip("αικνορτυχ", "aikvoptux")),
    **dict(zip("‐‑‒–—−﹣", "-------")),
    **dict(zip("․。．·", "....")),
    "﹫": "@",
}
_INVISIBLE = "­​‌‍⁠﻿"
_SPACES = "             　"
_DIGITS = dict(zip("zero one two three four five six seven eight nine oh".split(), "01234567890"))


def _plain(c: str) -> str:
    """The plain reading of one character; empty where it is invisible."""
    if c < "\x7f":
        return c
    if c in _INVISIBLE:
        return ""
    if c in _SPACES:
        return " "
    if "！" <= c <= "～":  # full-width forms lie in the order of ASCII
        return chr(ord(c) - 0xFEE0)
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.decimal(c, None)
    return c if digit is None else str(digit)


_STRANGE = re.compile(f"[{''.join(_LOOKALIKES)}{_INVISIBLE}{_SPACES}！-～]|(?![0-9])\\d")
_WRAPPED_AT = r"[ ]*(?:\[[ ]*at[ ]*\]|\([ ]*at[ ]*\)|\{[ ]*at[ ]*\}|<[ ]*at[ ]*>|\[[ ]*@[ ]*\]|\([ ]*@[ ]*\))[ ]*"
_WRAPPED_DOT = r"[ ]*(?:\[[ ]*(?:dot|\.)[ ]*\]|\([ ]*(?:dot|\.)[ ]*\)|\{[ ]*(?:dot|\.)[ ]*\}|<[ ]*dot[ ]*>)[ ]*"
_DOT = rf"(?:{_WRAPPED_DOT}|[ ]+dot[ ]+|\.)"
_NAME = r"[A-Za-z0-9_%+-]++"
_LABEL = r"[A-Za-z0-9-]++"
# A bare "at" counts only before a host with a disguised dot; a wrapped one before any host.
# A name is read to its end whether or not a host follows, so that no name is read twice.
_ADDRESS = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-]){_NAME}(?:{_DOT}{_NAME})*+"
    rf"(?P<host>(?:{_WRAPPED_AT}|[ ]*@[ ]*){_LABEL}(?:{_DOT}{_LABEL})++"
    rf"|[ ]+at[ ]+{_LABEL}(?:(?:{_WRAPPED_DOT}|[ ]+dot[ ]+){_LABEL})++)?+"
)
_DISGUISE = re.compile(rf"(?i){_WRAPPED_AT}|{_WRAPPED_DOT}|[ ]+at[ ]+|[ ]+dot[ ]+|[ ]*@[ ]*")
_DIGIT_DOT = re.compile(rf"(?i)(?<=[0-9])(?:{_WRAPPED_DOT}|[ ]+dot[ ]+)(?=[0-9])")
_WORD = "(?:zero|one|two|three|four|five|six|seven|eight|nine|oh)"
_PART = rf"(?:{_WORD}|[0-9]++)"
_BETWEEN = rf"(?:{_WRAPPED_DOT}|[ ]+dot[ ]+|[ ,.()-]{{1,3}})"
# digits of one identifier, spelled or not, with what may stand between them
_SPELLED = re.compile(rf"(?i)\b(?:plus[ ]+)?{_PART}(?:{_BETWEEN}{_PART}\b)+")
_TOKEN = re.compile(r"(?i)plus[ ]+|" + _WORD + r"|[0-9]+")
_JOINT = re.compile(r"[ ,.-]{1,2}")
_HINT = re.compile(r"[\[({<] *(?:at|dot|@|\.) *[\])}>]")
_HINT_SPELLED = re.compile(rf"{_WORD}[ ,.()\[{{<-]+(?:dot[ )\]}}>]+)?(?:[0-9]|{_WORD})|[0-9][ ,.()\[\]{{}}<>-]+{_WORD}")


def _disguised(text: str) -> bool:
    """Cheap and never wrong where it says no."""
    low = text.casefold()
    return bool(
        " dot " in low or _HINT.search(low) or " @" in low or "@ " in low or _HINT_SPELLED.search(low)
        or not text.isascii() and _STRANGE.search(text)
    )


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            yield start, done
        else:  # no match can start before the next sign and end after it
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of undisguised identifiers, by kind, then start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((3, m.start(), m.end()))
    return found


class Transducer:
    """A rewritten text whose pieces remember the source span they replace."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]) -> None:
        """edits: disjoint (start, end, replacement) in order."""
        parts, self._at, self._from = [], [0], [(0, 0)]
        done = out = 0
        for start, end, new in edits:
            out += start - done
            parts += [text[done:start], new]
            self._at += [out, out + len(new)]
            self._from += [(start, end - start), (end, 0)]
            out += len(new)
            done = end
        parts.append(text[done:])
        self.text = "".join(parts)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters of output characters start to end."""
        i = bisect.bisect_right(self._at, start) - 1
        base, replaced = self._from[i]
        first = base if replaced else base + start - self._at[i]
        j = bisect.bisect_left(self._at, end) - 1
        base, replaced = self._from[j]
        return first, base + replaced if replaced else base + end - self._at[j]

    def touched(self, start: int, end: int) -> bool:
        """Whether output characters start to end hold a replacement."""
        i = bisect.bisect_right(self._at, start) - 1
        return any(size for _, size in self._from[i : bisect.bisect_left(self._at, end)])


def _digits(found: re.Match) -> Iterator[tuple[int, int, str]]:
    """Edits that write the spelled digits of one identifier as digits, where it has three digits at least.

    Three spelled ones show that it is read out, and single digits are joined; with fewer
    only spelled ones that follow each other are, and signs between others stay.
    """
    tokens = [(t[0].casefold(), t.start() + found.start(), t.end() + found.start()) for t in _TOKEN.finditer(found[0])]
    words = sum(t[0] in _DIGITS for t in tokens)
    if not words or words + sum(len(t[0]) for t in tokens if t[0].isdigit()) < 3:
        return
    single = [t[0] in _DIGITS or len(t[0]) == 1 for t in tokens]
    text = found.string
    for i, (token, start, end) in enumerate(tokens):
        if token in _DIGITS:
            yield start, end, _DIGITS[token]
        elif not token.isdigit():
            yield start, end, "+"
        if i + 1 < len(tokens) and end < tokens[i + 1][1]:
            between = text[end : tokens[i + 1][1]]
            if not _JOINT.fullmatch(between):
                continue
            spelled = token in _DIGITS and tokens[i + 1][0] in _DIGITS
            if single[i] and single[i + 1] and (words >= 3 or spelled):
                yield end, tokens[i + 1][1], ""
            elif "," in between:
                yield end, tokens[i + 1][1], " "


def transducers(text: str) -> list[Transducer]:
    """Homoglyphs, then spelled digits, then at/dot disguises of addresses, then of dots between digits."""
    stages = [Transducer(text, [(m.start(), m.end(), n) for m in _STRANGE.finditer(text) if (n := _plain(m[0])) != m[0]])]
    now = stages[-1].text
    stages.append(Transducer(now, [e for m in _SPELLED.finditer(now) for e in _digits(m)]))
    edits = []
    now = stages[-1].text
    for address in _ADDRESS.finditer(now):
        if not address["host"]:
            continue
        for m in _DISGUISE.finditer(now, address.start(), address.end()):
            new = "@" if re.search(r"(?i)at|@", m[0]) else "."
            if new != m[0]:
                edits.append((m.start(), m.end(), new))
    stages.append(Transducer(now, edits))
    # after addresses, which may end in digits
    now = stages[-1].text
    stages.append(Transducer(now, [(m.start(), m.end(), ".") for m in _DIGIT_DOT.finditer(now)]))
    return stages


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Undisguised spans, and all spans; a disguised one is left out where a plain one of its kind covers it."""
    base = plain_spans(text)
    if not _disguised(text):
        return base, base
    stages = transducers(text)
    if stages[-1].text == text:
        return base, base
    # spans of a kind are disjoint and in order, so one of them tells whether any covers another
    taken = [[(a, b) for k, a, b in base if k == kind] for kind in range(len(KINDS))]
    added = []
    for kind, start, end in plain_spans(stages[-1].text):
        touched = False
        for stage in reversed(stages):
            touched |= stage.touched(start, end)
            start, end = stage.source(start, end)
        if touched:
            i = bisect.bisect_right(taken[kind], (start, len(text)))
            if not i or taken[kind][i - 1][1] < end:
                added.append((kind, start, end))
    return base, sorted(base + added)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: doc_id, plain and spans, arrays of (kind, start, end) in code points.

    `plain` has undisguised identifiers, `spans` those and disguised ones, each ordered
    by kind (email, ip, card, phone), then start; end is exclusive. Null and empty texts
    have none. Ids may be null or repeated; rows stay one to one and other columns are
    ignored. Time is linear in the text whatever it holds.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = ([], [])
            for value in batch.column(1):
                for column, found in zip(both, spans(value.as_py())):
                    column.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, span) for c in both]], ["doc_id", "plain", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    array = "array<struct<kind:string,start:bigint,end:bigint>>"
    return rows.mapInArrow(run, f"doc_id {kind}, plain {array}, spans {array}")


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns, with every span in the text replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. A null text stays null.
    """
    ship(docs.sparkSession)

    def clean(text: str) -> str:
        out, done = [], 0
        for kind, start, end in sorted(spans(text)[1], key=lambda s: (s[1], -s[2])):
            if start >= done:
                out += [text[done:start], f"<{KINDS[kind]}>"]
            done = max(done, end)
        return "".join(out) + text[done:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            texts = pa.array([None if t is None else clean(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, text_column, texts)

    return docs.mapInArrow(run, docs.schema)
