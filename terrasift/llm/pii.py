"""Personal data in texts, with disguises undone and every span reported in source characters.

Two passes over a whole text. The base pass finds e-mail addresses, IPv4 addresses, payment card numbers and phone
numbers as they stand. The second pass rewrites the text by small transducers, each a rule from a source span to
a replacement: look-alike letters and digits to ASCII, runs of spelled digits to digits, disguised at signs and dots
to the signs. It then detects the same kinds in the rewritten text and maps each span back through the recorded
alignment. A mapped span is added where it touches rewritten characters and doesn't lie in a span of its kind found before. A third pass
does the same with every spelled digit rewritten, however short its run; the checks of the kinds keep prose out.

Results: null text is empty and has no spans. Offsets are code points, ends exclusive. Base spans of one kind never overlap; an
added span may hold or meet one of which the disguise left a stump.
Repeated rows yield repeated results; extra columns are kept by ``redact`` and ignored by ``find``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let_go, map_rows, small

KINDS = ("email", "ip", "card", "phone")
#: Fewest spelled digits in a row that are taken for a number beside found spans; fewer may be prose and only show new ones.
SPELLED_RUN = 4

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can start at the first digit of a run only: later starts in the run would go on in the same way.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

# Letters and signs that look like ASCII ones.
LETTERS = ("АВЕКМНОРСТХасеорхуіјѕԁһΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEKMHOPCTXaceopxyijsdhABEZHIKMNOPTYXo")
SIGNS = ("＠．。﹒․٠١٢٣٤٥٦٧٨٩０１２３４５６７８９＋﹢－‐‑‒–", "@....01234567890123456789++-----")
LOOKALIKES = dict(zip("".join((LETTERS[0], SIGNS[0])), "".join((LETTERS[1], SIGNS[1])), strict=True)) | {chr(0xFEE0 + c): chr(c) for c in (*range(65, 91), *range(97, 123))}
# Spelled digits.
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_LOOKALIKE = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
_TABLE = str.maketrans(LOOKALIKES)
_DIGIT_WORD = "(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_SPELLED = re.compile(rf"(?<![^\W\d_]){_DIGIT_WORD}(?![^\W\d_])(?:(?:,\x20|\x20-\x20|[\x20,-]){_DIGIT_WORD}(?![^\W\d_]))*+", re.I)
_PLUS = re.compile(r"(?<![^\W\d_])plus\x20(?=\+?[0-9])", re.I)
_WORD = re.compile(_DIGIT_WORD, re.I)
_AT = r"(?:\x20?[\[({<]\x20?(?i:at|@)\x20?[\])}>]\x20?)"
_DOT = r"(?:\x20?[\[({<]\x20?(?i:dot|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT|Dot)\x20)"
_SIGNS = re.compile(
    rf"(?P<at>(?<=[A-Za-z0-9])(?:{_AT}(?=[A-Za-z0-9-])|\x20(?:at|AT|At)\x20(?=[A-Za-z0-9-]+{_DOT}[A-Za-z0-9-])))|(?P<dot>(?<=[A-Za-z0-9]){_DOT}(?=[A-Za-z0-9]))"
)
_SIGNS_HINT = re.compile(r"[\[({<]\x20?(?:at|dot|@|\.)\x20?[\])}>]|\x20dot\x20", re.I)

Span = tuple[str, int, int]


def _emails(text: str) -> list[tuple[int, int]]:
    """Looks around at signs only: the local part is the run of its characters before one, from the last match on."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        # The run is read backwards in doubling steps, so a text without addresses costs nothing.
        size, low = 64, max(done, at - 64)
        while low > done and not _NOT_LOCAL.search(text, low, at):
            size *= 2
            low = max(done, at - size)
        run = _LOCAL_END.search(text[low:at])
        if run and (m := _DOMAIN.match(text, at + 1)):
            out.append((low + run.start(), m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    return out


def _octet(part: str) -> bool:
    """At most 255, whatever the number of leading zeros."""
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def detect(text: str) -> list[Span]:
    """Base spans: leftmost non-overlapping matches of each kind that pass its check, by kind, then start."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


class Rewritten:
    """A text after some replacements, with the way back to source offsets."""

    def __init__(self, text: str) -> None:
        self.text = text
        #: Kept or replaced pieces: start in the text, start in the source, length here, length in the source, replaced.
        self.pieces: list[tuple[int, int, int, int, bool]] = [(0, 0, len(text), len(text), False)]

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace non-overlapping spans of the present text, given in order."""
        if not edits:
            return
        pieces, parts, at, new_at = [], [], 0, 0
        for s, e, r in [*edits, (len(self.text), len(self.text), "")]:
            for kept_s, src, n, src_n, changed in self._slice(at, s):
                pieces.append((new_at + kept_s - at, src, n, src_n, changed))
            parts += [self.text[at:s], r]
            new_at += s - at
            if e > s:
                src, src_end = self.source(s, e)
                pieces.append((new_at, src, len(r), src_end - src, True))
            new_at += len(r)
            at = e
        self.text, self.pieces = "".join(parts), pieces

    def _slice(self, s: int, e: int) -> list[tuple[int, int, int, int, bool]]:
        out = []
        i = max(0, bisect.bisect_right(self.pieces, s, key=lambda p: p[0]) - 1)
        for start, src, n, src_n, changed in self.pieces[i:]:
            if start >= e:
                break
            low, high = max(s, start), min(e, start + n)
            if low < high:
                out.append((low, src, high - low, src_n, True) if changed else (low, src + low - start, high - low, high - low, False))
        return out

    def source(self, s: int, e: int) -> tuple[int, int]:
        """Source span of a span of the present text; a replaced piece counts whole."""
        got = self._slice(s, e)
        return got[0][1], got[-1][1] + got[-1][3]

    def touched(self, s: int, e: int) -> bool:
        return any(x[4] for x in self._slice(s, e))


def rewrite(text: str, least: int = SPELLED_RUN) -> Rewritten | None:
    """The text with disguises undone, spelled digits from so many in a row on; None where no transducer applies."""
    out = Rewritten(text)
    if not text.isascii() and _LOOKALIKE.search(text):
        out.apply([(m.start(), m.end(), LOOKALIKES[m[0]]) for m in _LOOKALIKE.finditer(text)])
    spelled = [(m, found) for m in _SPELLED.finditer(out.text) if len(found := _WORD.findall(m[0])) >= least]
    if spelled:
        out.apply([(*m.span(), "".join(SPELLED[w.lower()] for w in found)) for m, found in spelled])
        out.apply([(*m.span(), "" if out.text[m.end()] == "+" else "+") for m in _PLUS.finditer(out.text)])
    elif least < SPELLED_RUN:
        return None
    if _SIGNS_HINT.search(out.text):
        out.apply([(*m.span(), "@" if m["at"] else ".") for m in _SIGNS.finditer(out.text)])
    return out if len(out.pieces) > 1 or out.pieces[0][4] else None


def _met(spans: list[tuple[int, int]], s: int, e: int) -> list[tuple[int, int]]:
    """Those of some ordered, separate spans that overlap one."""
    i = bisect.bisect_left(spans, (s, s))
    return spans[i - (i > 0 and spans[i - 1][1] > s) : bisect.bisect_left(spans, (e, e))]


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base ones and those that show, or show whole, once disguises are undone."""
    base = detect(text)
    layers = [{k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}]
    for least in (SPELLED_RUN, 1):
        if (changed := rewrite(text, least)) is None:
            continue
        layer = {k: [] for k in KINDS}
        for kind, s, e in detect(changed.text):
            if changed.touched(s, e):
                s, e = changed.source(s, e)
                met = [x for old in layers for x in _met(old[kind], s, e)]
                if any(a <= s and e <= b for a, b in met):
                    continue
                # One short spelled run beside a found span may be prose.
                sides = [x for x in (text[s : min(a for a, _ in met)], text[max(b for _, b in met) : e]) if x] if met else []
                if least == SPELLED_RUN or all(len(_WORD.findall(x)) > 1 for x in sides):
                    layer[kind].append((s, e))
        layers.append(layer)
    if len(layers) == 1:
        return base, base
    return base, [(k, s, e) for k in KINDS for s, e in sorted(x for layer in layers for x in layer[k])]


def _joined(spans: list[Span]) -> str:
    return ",".join([f"{k}:{s}:{e}" for k, s, e in spans])


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of base spans by kind, digest of the base spans, all spans (kind:start:end), number of added spans."""

    def make():
        empty = hashlib.sha256(b"").hexdigest()

        def fn(columns):
            found = [find(t) if t else ([], []) for t in columns[1]]
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
            return [columns[0], *counts, [hashlib.sha256(_joined(b).encode()).hexdigest() if b else empty for b, _ in found], [_joined(a) for _, a in found], [len(a) - len(b) for b, a in found]]

        return fn

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(texts, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long", make)


def mask(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans go together as the first of them."""
    parts, at = [], 0
    for s, e, k in sorted((s, -e, k) for k, s, e in find(text)[1]):
        if s >= at:
            parts += [text[at:s], f"<{k}>"]
        at = max(at, -e)
    return "".join([*parts, text[at:]]) if at else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with personal data masked in the text; null stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in small(batches):
            at = batch.schema.get_field_index(text_col)
            masked = pa.array([mask(t) if t else t for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), masked)

    return docs.mapInArrow(run, docs.schema)
