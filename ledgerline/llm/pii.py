"""Personal data in whole texts, also in disguise, with spans in the source."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.workers import parts, ready, release

KINDS = ("email", "ip", "card", "phone")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# Tried at the first digit of a run only: it matches there or nowhere in the run.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters that look like Latin ones, position by position; fixed values.
_LOOKALIKES = dict(zip(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТХІЈЅαορνικτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "aeopcyxijshdqwABEKMHOPCTXIJSaopviktABEZHIKMNOPTYX",
))
_MARKS = {
    "\uff20": "@", "\ufe6b": "@", "\uff0e": ".", "\u3002": ".", "\u2024": ".", "\uff0b": "+", "\uff0d": "-", "\u2010": "-",
    "\u2011": "-", "\u2013": "-", "\uff3f": "_", "\u00a0": " ", "\u2007": " ", "\u202f": " ",
}


def _substitutes() -> dict[int, str]:
    """One character for one: it keeps offsets."""
    table = {ord(k): v for k, v in {**_LOOKALIKES, **_MARKS}.items()}
    for first, width, target in ((0xFF10, 10, "0"), (0xFF21, 26, "A"), (0xFF41, 26, "a")):  # full width
        table.update({first + i: chr(ord(target) + i) for i in range(width)})
    for first in (0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6, 0x660, 0x6F0):  # mathematical, Arabic
        table.update({first + i: str(i) for i in range(10)})
    for first in range(0x1D400, 0x1D6A4, 52):  # mathematical letters, capitals then small ones
        table.update({first + i: chr((65 if i < 26 else 71) + i) for i in range(52)})
    return table


SUBSTITUTES = _substitutes()
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
# Spelled digits of the corpus languages.
DIGITS = {
    **{w: d for d, w in enumerate("zero one two three four five six seven eight nine".split())}, "oh": 0,
    **{w: d for d, w in enumerate("null eins zwei drei vier fünf sechs sieben acht neun".split())},
    **{w: d for d, w in enumerate("zéro un deux trois quatre cinq six sept huit neuf".split())},
    **{w: d for d, w in enumerate("cero uno dos tres cuatro cinco seis siete ocho nueve".split())},
}
_AT, _DOT = "at|arroba|arobase|ät", "dot|punkt|punto|point"
_WORD = "|".join(sorted(DIGITS, key=len, reverse=True))
_FEWEST = 4  # fewer spelled digits in a row are ordinary words
_GAP = r"[\s,-]{1,3}"
# Brackets and spaces are looked for from the start of a run of spaces only.
_BRACKETED_AT = rf"(?<!\s)\s*[\[({{<]\s*(?:{_AT}|@)\s*[\])}}>]\s*"
_BRACKETED_DOT = rf"(?<!\s)\s*[\[({{<]\s*(?:{_DOT}|\.)\s*[\])}}>]\s*"
_RUN = rf"(?:plus{_GAP})?(?:{_WORD})\b(?:{_GAP}(?:(?:{_AT}|{_DOT}){_GAP})?(?:{_WORD})\b)*"
_FIGURES = rf"(?:plus{_GAP})?[0-9]+"
_LINK = rf"(?:{_GAP}(?:(?:{_AT}|{_DOT}){_GAP})?|{_BRACKETED_AT}|{_BRACKETED_DOT}|[\s()-]{{1,4}}|\.)"
_INVISIBLE = re.compile(rf"[{INVISIBLE}]+")
# Spelled digits and figures, with marks in any form between them.
_CLUSTER = re.compile(rf"\b(?:{_RUN}|{_FIGURES})(?:{_LINK}(?:{_RUN}|{_FIGURES}))*", re.IGNORECASE)
_SPELLED = re.compile(rf"\b(?:{_RUN}|plus{_GAP}(?=[0-9]))", re.IGNORECASE)
_MARKED = re.compile(
    rf"(?P<at>{_BRACKETED_AT})|(?P<dot>{_BRACKETED_DOT}|(?<=[A-Za-z0-9_])\s+(?:{_DOT})\s+(?=[A-Za-z0-9])|(?<=[0-9]){_GAP}(?:{_DOT}){_GAP}(?=[0-9]))",
    re.IGNORECASE,
)
# What stands before and after a spoken at, when all dots are marks.
_SPOKEN_AT = re.compile(
    rf"(?<=[A-Za-z0-9_])\s+(?:{_AT})\s+(?=(?P<host>[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,12}}\b))", re.IGNORECASE
)
_ITEMS = re.compile(rf"plus|{_AT}|{_DOT}|{_WORD}", re.IGNORECASE)
# What tells cheaply that no rule can fire: most texts have none of this.
_SUBSTITUTED = frozenset(map(chr, SUBSTITUTES)) | frozenset(INVISIBLE)
_BRACKETED = re.compile(rf"[\[({{<]\s*(?i:{_AT}|{_DOT}|@|\.)\s*[\])}}>]")
_DOTS = frozenset(_DOT.split("|"))
_DIGIT_WORDS = frozenset(DIGITS) | {"plus"}
_RUN_WORDS = _DIGIT_WORDS | frozenset(_AT.split("|"))
_TOKEN = re.compile(r"\w+")
_FOLDED = frozenset("ſıİ\u212a")  # letters that match s, i and k where case is ignored
Edit = tuple[str, int, int]  # the new piece, and where the old one starts and ends


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that do not overlap, looked for around each @ only."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        found = _EMAIL.match(text, start) if start < at else None
        if found:
            yield found.span()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The plain identifiers of each kind."""
    spans: dict[str, list[tuple[int, int]]] = {"email": list(_emails(text)) if "@" in text else [], "ip": [], "card": [], "phone": []}
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            spans["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans["phone"].append(m.span())
    return spans


def _digit_run(run: str) -> str:
    out = []
    for m in _ITEMS.finditer(run):
        word = m[0].lower()
        out.append("+" if word == "plus" else str(DIGITS[word]) if word in DIGITS else "." if re.fullmatch(_DOT, word) else "@")
    return "".join(out)


def _without_invisible(text: str) -> Iterator[Edit]:
    for m in _INVISIBLE.finditer(text):
        yield "", m.start(), m.end()


def _spelled_digits(text: str) -> Iterator[Edit]:
    """Spelled digits among at least ``_FEWEST`` digits and marks, spelled or in figures."""
    for m in _CLUSTER.finditer(text):
        runs = list(_SPELLED.finditer(text, m.start(), m.end()))
        if not runs:
            continue
        items = sum(c in "0123456789" for c in m[0]) + sum(x[0].lower() != "plus" for r in runs for x in _ITEMS.finditer(r[0]))
        if items >= _FEWEST:
            for r in runs:
                yield _digit_run(r[0]), r.start(), r.end()


def _marks(text: str) -> Iterator[Edit]:
    """Bracketed at and dot, and spoken dots between two words."""
    for m in _MARKED.finditer(text):
        yield "@" if m.lastgroup == "at" else ".", m.start(), m.end()


def _spoken_ats(text: str, dots: list[int]) -> Iterator[Edit]:
    """Spoken ats before a host with a dot in disguise; ``dots`` are the places of those."""
    for m in _SPOKEN_AT.finditer(text):
        if bisect_left(dots, m.start("host")) < bisect_left(dots, m.end("host")):
            yield "@", m.start(), m.end()


class Normalised:
    """A text after the transducers, with the way back to the source.

    Each layer has, for each rewritten piece, its start and end in the new text and in that of
    the layer before; between pieces both run in step.
    """

    def __init__(self, source: str):
        self.text = source if source.isascii() else source.translate(SUBSTITUTES)
        self._layers: list[tuple[list[int], list[tuple[int, int, int, int]]]] = []
        self._rewrite(_without_invisible(self.text))
        self._rewrite(_spelled_digits(self.text))
        dots = [first for first, last, _, _ in self._rewrite(_marks(self.text)) if self.text[first:last] == "."]
        self._rewrite(_spoken_ats(self.text, dots))
        self.changed = self.text != source

    def _rewrite(self, edits: Iterator[Edit]) -> list[tuple[int, int, int, int]]:
        out: list[str] = []
        places: list[tuple[int, int, int, int]] = []
        at, size = 0, 0
        for new, start, end in edits:
            out += self.text[at:start], new
            size += start - at
            places.append((size, size + len(new), start, end))
            size += len(new)
            at = end
        if places:
            self.text = "".join(out) + self.text[at:]
            self._layers.append(([p[0] for p in places], places))
        return places

    def back(self, span: tuple[int, int]) -> tuple[int, int]:
        start, end = span
        for starts, places in reversed(self._layers):
            start, end = _before(starts, places, start, False), _before(starts, places, end, True)
        return start, end


def _before(starts: list[int], places: list[tuple[int, int, int, int]], at: int, end: bool) -> int:
    # The piece that holds the character at (or, for an end, before) this place.
    look = at - 1 if end else at
    i = bisect_right(starts, look) - 1
    if i < 0:
        return at
    first, last, start, stop = places[i]
    if look < last:
        return stop if end else start
    return stop + (at - last)


def _clues(text: str) -> bool:
    """Whether a transducer could change anything; true more often than needed, never less.

    Spelled digits and spoken marks are whole words. Between two linked items stands nothing but
    characters that belong to no word, or a spoken mark.
    """
    if not text.isascii() and not (_SUBSTITUTED.isdisjoint(text) and _FOLDED.isdisjoint(text)):
        return True
    if _BRACKETED.search(text):
        return True
    words = _TOKEN.findall(text.lower())
    found = set(words)
    if not _DOTS.isdisjoint(found):
        return True
    if _DIGIT_WORDS.isdisjoint(found):
        return False
    # A spelled digit stands beside another one, a mark or figures.
    last = len(words) - 1
    for i, w in enumerate(words):
        if w in _DIGIT_WORDS:
            if i < last and (words[i + 1] in _RUN_WORDS or "0" <= words[i + 1][0] <= "9"):
                return True
            if i and (words[i - 1] in _RUN_WORDS or "0" <= words[i - 1][-1] <= "9"):
                return True
    return False


def find_spans(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """The base spans by kind, and all spans: those and what the transducers uncover."""
    base = base_spans(text)
    every = [(k, s, e) for k in KINDS for s, e in base[k]]
    if _clues(text):
        plain = Normalised(text)
        if plain.changed:
            more = []
            for kind, spans in base_spans(plain.text).items():
                for span in spans:
                    s, e = plain.back(span)
                    if not any(s2 <= s and e <= e2 for s2, e2 in base[kind]):
                        more.append((kind, s, e))
            every = sorted(every + more, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return base, every


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_email, n_ip, n_card, n_phone (plain ones), base_sha256 (of the plain
    spans as ``kind:start:end``), spans (all of them, also those in disguise) and n_disguised.

    Plain identifiers are matched on the text as it is. Then transducers rewrite it: characters
    that look like Latin letters, digits or marks become those, invisible ones vanish, spelled
    digits become digits where four or more digits and marks, spelled or in figures, stand
    together, and bracketed at and dot and spoken dots between words become marks, each on its
    own. A spoken at does if a dot of the host after it was in disguise too: "at example.com" is
    ordinary prose. Forms mix freely. A number word right after a plain phone number is taken
    for its last digit ("+1 202 555 0100 un"). Identifiers in the rewritten text are mapped back to source offsets (code points, end
    exclusive) and added unless a plain one of their kind holds them, so where only part of an
    identifier is plain, both the part and the whole are listed. Whole texts are looked at; a
    text in which no rule can fire skips the rewriting, which would leave it as it is.

    Null texts count as empty. Repeated rows each give a row; null keys are kept; other columns
    play no part; an empty table gives no rows.
    """
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType)] + [T.StructField(c, T.LongType()) for c in counts]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_disguised", T.LongType())]
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                base, every = find_spans(t.as_py() or "")
                plain = [(k, s, e) for k in KINDS for s, e in base[k]]
                digest = hashlib.sha256(_joined(plain).encode()).hexdigest()
                rows.append((*[len(base[k]) for k in KINDS], digest, _joined(every), len(every) - len(plain)))
            if rows:
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return ready(docs.select(key, text)).mapInArrow(find, schema)


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    _, every = find_spans(text)
    out, at = [], 0
    for kind, start, end in sorted(every, key=lambda x: (x[1], -x[2])):
        if end <= at:
            continue
        out.append(text[at : max(start, at)])
        if start >= at:
            out.append(f"<{kind}>")
        at = end
    return "".join(out) + text[at:]


def masked_parts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches with ``text`` masked, a part of a batch at a time."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        for part in parts(batch):
            new = [None if t is None else masked(t) for t in part.column(at).to_pylist()]
            yield part.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
    release()


def mask_pii(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text``; other columns are untouched but for
    ``n_chars``, which follows the new text where the table has it. Null texts stay null."""
    out = ready(docs).mapInArrow(lambda batches: masked_parts(batches, text), docs.schema)
    if n_chars and n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(text).isNull(), F.col(n_chars)).otherwise(F.char_length(text)).cast(docs.schema[n_chars].dataType))
    return out
