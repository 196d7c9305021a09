"""Secret scans: known forms of secrets, and stretches of high entropy that no form names."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")

SHORT, WINDOW = 16, 24
"""Characters of a window: 24, and 16 in strings of 16 to 23 characters."""
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORT},}}")
LIMITS = {"hex": 3.0, "base32": 3.6, "base36": 3.75, "base64": 4.0}
"""Bits per character that a window of 24 characters must reach, by the smallest class that holds the candidate."""
SHORT_LIMITS = {"hex": 3.0, "base32": 3.3, "base36": 3.4, "base64": 3.5}
"""The same for windows of 16 characters. Short strings must also mix lower case, upper case and digits, or letters with several digits,
or change the case more often than words do."""
MIXED = re.compile(r"(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])(?=[^0-9]*[0-9])|(?=(?:[^A-Za-z]*[A-Za-z]){4})(?=(?:[^0-9]*[0-9]){2})|[A-Za-z]+$")
CLASSES = (("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+")), ("base32", re.compile(r"[A-Z2-7=]+")), ("base36", re.compile(r"[a-z0-9]+|[A-Z0-9]+")), ("base64", re.compile(r"[A-Za-z0-9+/_=-]+")))
ALLOWED = (
    re.compile(r"[0-9]+([-/_][0-9]+)*"),  # numbers and dates
    re.compile(r"(.)\1*"),
    re.compile(r"[-=_+/]+"),
)
"""Candidates that match one of these as a whole are suppressed, whatever their entropy."""
NAME = re.compile(r"[a-z]+([-_/][a-z0-9]+)+|[A-Z]+([-_/][A-Z0-9]+)+", re.A)
SEGMENT = re.compile(r"[A-Za-z]+|[0-9]{1,8}|(?P<mixed>[A-Za-z]{1,8}[0-9]{1,4}|[0-9]{1,4}[A-Za-z]{1,3}|[A-Za-z][0-9]{1,2}[A-Za-z])", re.A)
"""What a segment of a path, slug or constant name may be: a word, a short number, or a short word with a short number."""

Span = tuple[int, str, int]
TERMS = [0.0] + [n * log2(n) for n in range(1, WINDOW + 2)]  # the new character counts before the old one goes


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed forms: per kind leftmost and without overlap, failing matches dropped."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def limit_of(word: str, limits: dict[str, float] = LIMITS) -> float:
    return limits[next(name for name, form in CLASSES if form.fullmatch(word))]


def is_name(word: str) -> bool:
    """Whether a candidate is a path, a slug or a constant name: every segment looks like a word or a short number.

    Segments of letters and digits are at most half of it, and no segment has a window that reaches its own limit.
    """
    if not NAME.fullmatch(word):
        return False
    mixed = 0
    for part in re.split("[-_/]", word):
        form = SEGMENT.fullmatch(part)
        if not form or any(dense_stretches(part, limit_of(part))):
            return False
        mixed += len(part) if form["mixed"] else 0
    return 2 * mixed <= len(word)


def is_word(word: str) -> bool:
    """Whether letters alone look like words: the case changes at most once in four letters, as in CamelCase, not as in a key."""
    if not (word.isascii() and word.isalpha()):
        return False
    changes = sum(a.isupper() != b.isupper() for a, b in zip(word, word[1:]))
    return 4 * changes <= len(word)


def free_parts(start: int, stop: int, taken: list[Span], at: int) -> tuple[list[tuple[int, int]], int]:
    """What of [start, stop) no base span covers, and the first base span that ends behind ``start``; ``taken`` is disjoint and sorted."""
    while at < len(taken) and taken[at][2] <= start:
        at += 1
    parts, k = [], at
    while k < len(taken) and taken[k][0] < stop:
        if start < taken[k][0]:
            parts.append((start, taken[k][0]))
        start = max(start, taken[k][2])
        k += 1
    return (parts + [(start, stop)] if start < stop else parts), at


def entropy_spans(text: str, taken: list[Span]) -> list[Span]:
    """Stretches of candidate strings, without what base spans cover, whose windows all reach the limit of their class."""
    found, at = [], 0
    taken = merged(taken)
    for m in CANDIDATE.finditer(text):
        parts, at = free_parts(m.start(), m.end(), taken, at)
        for start, stop in parts:
            word = text[start:stop]
            if len(word) < SHORT or any(a.fullmatch(word) for a in ALLOWED) or is_word(word) or is_name(word):
                continue
            if len(word) >= WINDOW:
                stretches = dense_stretches(word, limit_of(word))
            elif MIXED.match(word):
                stretches = dense_stretches(word, limit_of(word, SHORT_LIMITS), SHORT)
            else:
                continue
            found += [(start + begin, "entropy", start + end) for begin, end in stretches]
    return found


def merged(spans: list[Span]) -> list[Span]:
    """Disjoint spans that cover the same characters, in order."""
    out: list[Span] = []
    for start, kind, end in sorted(spans, key=lambda s: (s[0], s[2])):
        if out and start < out[-1][2]:
            out[-1] = (out[-1][0], kind, max(end, out[-1][2]))
        else:
            out.append((start, kind, end))
    return out


def dense_stretches(word: str, limit: float, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Unions of overlapping windows with at least ``limit`` bits per character.

    H = log2(w) - sum(c log2 c) / w; the counts c and their sum change by two characters from one window to the next.
    """
    most = window * (log2(window) - limit) + 1e-9
    counts: dict[str, int] = {}
    total, begin, end = 0.0, -1, -1
    for i, new in enumerate(word):
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += TERMS[c + 1] - TERMS[c]
        if i >= window:
            old = word[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += TERMS[c - 1] - TERMS[c]
        if i >= window - 1 and total <= most:
            at = i - window + 1
            if begin >= 0 and at > end:
                yield begin, end
                begin = -1
            begin, end = (at if begin < 0 else begin), i + 1
    if begin >= 0:
        yield begin, end


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, by start and then kind as listed."""
    base = base_spans(text)
    every = base + entropy_spans(text, base)
    by_place = lambda s: (s[0], KINDS.index(s[1]))
    return sorted(base, key=by_place), sorted(every, key=by_place)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


SCAN_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Spans of secrets in every whole text, in code points: doc_id, counts by kind, base_sha256, spans (kind:start:end, comma-joined).

    A null or empty text has no spans (the digest is that of the empty string); null keys and repeated rows stay; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            rows = []
            for doc, own in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist()):
                base, every = find_spans(own or "")
                counts = [sum(s[1] == kind for s in every) for kind in KINDS]
                rows.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])

    return docs.select(key, text).mapInArrow(run, SCAN_SCHEMA)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", length: str | None = "n_chars") -> DataFrame:
    """The same rows with every span replaced by ``mark`` (overlapping spans by one) and ``length``, if it is a column, set anew.

    A null text stays null, and so does its length.
    """
    def run(batches: Iterator) -> Iterator:
        for texts in batches:
            yield texts.map(lambda own: own if own is None else redacted(own, mark))

    out = docs.withColumn(text, F.pandas_udf(run, "string", F.PandasUDFType.SCALAR_ITER)(F.col(text)))
    if length in docs.columns:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(F.col(text).isNotNull(), F.char_length(text).cast(kind)))
    return out


def redacted(text: str, mark: str) -> str:
    parts, at = [], 0
    for start, _, end in merged(find_spans(text)[1]):
        parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])
