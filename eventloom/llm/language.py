"""Language identification: scripts narrow the candidates, Viterbi labels the words, spans of one language come out.

A word is a run of letters and marks of one script. Its score in a language is the mean log-likelihood of its letter n-grams
there. Languages that are not written in the word's script are no candidates. The best sequence of labels, where every switch between
words costs a fixed penalty, is found for whole texts: blocks of words are summarized by their best score from each entry label to
each exit label, the blocks of a document are chained, and the labels inside follow from the entry label. All
blocks of a batch advance together, so one long text costs no more steps than its number of blocks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, text_slices

# First code points of script blocks in Unicode, and the script of each stretch.
SCRIPT_STARTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"),
    (0xFF5B, "other"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_STARTS))
SLOT_BITS = 17
"""Hash slots of letter n-grams."""
SIZES = (1, 2, 3)
SAMPLE_ROWS = 20_000
"""Labelled documents that the scores are counted on at most, chosen by a hash of their id."""
NEVER = -1e6
"""Score of a word in a language that is not written in its script."""
BLOCK = 64
"""Words that are summarized together."""
LETTERS_AT_ONCE = 1 << 20


class Viterbi(NamedTuple):
    """Cost of a switch in nats, added to every count, and the least share of a language's letters that makes a script its own."""

    penalty: float = 6.0
    smoothing: float = 0.1
    script_share: float = 0.001


class Model(NamedTuple):
    """Learned languages in order, scores (slot, language), and which language is written in which script."""

    languages: list[str]
    scores: np.ndarray
    written: np.ndarray


@lru_cache(maxsize=1)
def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, whether it continues a word (letter or mark), and its lower case."""
    letter, inside, lower = np.zeros(0x110000, bool), np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LM":
            letter[code], inside[code] = kind == "L", True
            small = chr(code).lower()
            if len(small) == 1:
                lower[code] = ord(small)
    return letter, inside, lower


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """Script number of every code point."""
    starts = [start for start, _ in SCRIPT_STARTS] + [0x110000]
    return np.repeat([SCRIPTS.index(name) for _, name in SCRIPT_STARTS], np.diff(starts)).astype(np.uint8)


class Words(NamedTuple):
    """Words of a batch of texts: their text, begin and end (code points in the text), script, and lower-cased code points in a row."""

    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    script: np.ndarray
    codes: np.ndarray
    letters: np.ndarray


def split_words(texts: list[str]) -> Words:
    """All words of whole texts in order."""
    letter, inside, lower = code_tables()
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    codes = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    taken, script = inside[codes], script_table()[codes]
    mark = taken & ~letter[codes]
    mark[starts[:-1][starts[:-1] < len(codes)]] = False
    script = script[np.maximum.accumulate(np.where(mark, 0, np.arange(len(codes))))]  # a mark belongs to the letter before it
    edge = np.ones(len(codes) + 1, bool)
    edge[1:-1] = (taken[1:] != taken[:-1]) | (script[1:] != script[:-1])
    edge[starts] = True
    cuts = np.flatnonzero(edge)
    begin, end = (cuts[:-1], cuts[1:]) if len(codes) else (cuts[:0], cuts[:0])
    some = taken[begin] & (np.concatenate([[0], np.cumsum(letter[codes])])[end] > np.concatenate([[0], np.cumsum(letter[codes])])[begin])
    begin, end = begin[some], end[some]
    text = np.searchsorted(starts, begin, side="right") - 1
    lengths = end - begin
    at = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return Words(text, begin - starts[text], end - starts[text], script[begin], lower[codes[at]], lengths)


def gram_slots(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the letter n-grams of every word, with a blank before and after it, and the word of each."""
    lengths = words.letters + 2
    stops = np.cumsum(lengths)
    padded = np.zeros(int(stops[-1]) if len(stops) else 0, np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(padded)) - np.repeat(stops - lengths, lengths)
    padded[(place > 0) & (place < lengths[owner] - 1)] = words.codes
    slots, owners = [], []
    left = lengths[owner] - place
    for size in SIZES:
        fits = np.flatnonzero((left >= size) & (place > 0) & (left > 1)) if size == 1 else np.flatnonzero(left >= size)
        mixed = np.full(len(fits), size, np.uint64)
        for k in range(size):
            mixed = (mixed * np.uint64(0x100000001B3) ^ padded[fits + k]) * np.uint64(0x9E3779B97F4A7C15)
        slots.append((mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
        owners.append(owner[fits])
    return np.concatenate(slots), np.concatenate(owners)


def train(docs: DataFrame, chosen: Column, lang: str = "lang", text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, options: Viterbi = Viterbi()) -> Model:
    """Scores counted on whole texts of at most ``sample_rows`` labelled documents that ``chosen`` (a condition on the documents) admits.

    Null labels, texts and keys take no part. The driver gets counts by slot, script and language, not rows; without labelled documents no
    language is learned.
    """
    known = docs.filter(chosen & F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull())
    ids = known.select(F.col(key).alias("id")).orderBy(F.xxhash64("id"), "id").limit(sample_rows).distinct()
    sample = known.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).join(F.broadcast(ids), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in text_slices(batches, "text"):
            words = split_words(batch.column("text").to_pylist())
            slots, owners = gram_slots(words)
            names = batch.column("lang").to_pylist()
            for name in set(names):
                if name not in counts:
                    counts[name] = np.zeros((1 << SLOT_BITS) + len(SCRIPTS), np.int64)
                mine = np.array([n == name for n in names])[words.text]
                counts[name][: 1 << SLOT_BITS] += np.bincount(slots[mine[owners]], minlength=1 << SLOT_BITS)
                counts[name][1 << SLOT_BITS :] += np.bincount(words.script[mine], words.letters[mine], len(SCRIPTS)).astype(np.int64)
        for name, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at])], names=["lang", "slot", "n"])

    partial = sample.select("text", "lang").mapInArrow(run, "lang string, slot int, n long")
    found = partial.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(found["lang"]), key=lambda name: name.encode())
    counts = np.zeros(((1 << SLOT_BITS) + len(SCRIPTS), len(languages)))
    for k, name in enumerate(languages):
        mine = found[found["lang"] == name]
        counts[mine["slot"].to_numpy(), k] = mine["n"].to_numpy()
    grams, letters = counts[: 1 << SLOT_BITS] + options.smoothing, counts[1 << SLOT_BITS :]
    scores = np.log(grams / np.maximum(grams.sum(axis=0), 1)).astype(np.float32)
    written = letters >= np.maximum(options.script_share * letters.sum(axis=0), 1)
    return Model(languages, scores, written)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Score of each word in each language; where no language is written in the script, all are equal."""
    scores = np.empty((len(words.text), len(model.languages)))
    stops = np.cumsum(words.letters)
    at = 0
    while at < len(stops):  # some words at a time: the n-grams of a very long text are never held at once
        before = stops[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(stops, before + LETTERS_AT_ONCE, side="right")))
        some = Words(*[x[at:to] for x in words[:4]], words.codes[before : stops[to - 1]], words.letters[at:to])
        slots, owners = gram_slots(some)
        for k in range(len(model.languages)):
            scores[at:to, k] = np.bincount(owners, model.scores[slots, k], to - at)
        at = to
    scores /= len(SIZES)
    written = model.written[words.script]
    return np.where(written, scores, np.where(written.any(axis=1, keepdims=True), NEVER, 0.0))


def best_labels(scores: np.ndarray, text: np.ndarray, penalty: float) -> np.ndarray:
    """The label of each word on the best path through its text; ``text`` is ascending. Of equal paths, the smaller label ends it."""
    words, labels = scores.shape
    if not words:
        return np.zeros(0, np.int64)
    _, first, count = np.unique(text, return_index=True, return_counts=True)
    per_text = -(-count // BLOCK)
    row_of = np.repeat(np.cumsum(per_text) - per_text, count) + (np.arange(words) - np.repeat(first, count)) // BLOCK
    column = (np.arange(words) - np.repeat(first, count)) % BLOCK
    padded = np.zeros((int(per_text.sum()), BLOCK, labels))  # blank words at a text's end change no path
    padded[row_of, column] = scores
    switch = penalty * (1 - np.eye(labels))
    through = np.broadcast_to(-switch, (len(padded), labels, labels)).copy()  # entry label, exit label
    for k in range(BLOCK):
        if k:
            through = np.maximum(through, through.max(axis=2, keepdims=True) - penalty)
        through += padded[:, k, None, :]
    order = np.argsort(-per_text, kind="stable")
    head = (np.cumsum(per_text) - per_text)[order]
    state = np.zeros((len(order), labels))
    entry = np.zeros((len(padded), labels), np.int64)  # best entry label of a block for each exit label
    for j in range(int(per_text.max())):
        live = int(np.searchsorted(-per_text[order], -j, side="left"))
        options = state[:live, :, None] + through[head[:live] + j]
        entry[head[:live] + j] = options.argmax(axis=1)
        state[:live] = options.max(axis=1)
    last = state.argmax(axis=1)
    exits, enters = np.zeros(len(padded), np.int64), np.zeros(len(padded), np.int64)
    for j in range(int(per_text.max()) - 1, -1, -1):
        live = int(np.searchsorted(-per_text[order], -j, side="left"))
        block = head[:live] + j
        exits[block] = last[:live]
        last[:live] = enters[block] = entry[block, last[:live]]
    rows = np.arange(len(padded))
    value = -switch[enters]
    back = np.zeros((len(padded), BLOCK, labels), np.int64)
    for k in range(BLOCK):
        if k:
            top = value.argmax(axis=1)
            jump = value[rows, top][:, None] - penalty
            back[:, k] = np.where(value >= jump, np.arange(labels), top[:, None])
            value = np.maximum(value, jump)
        value = value + padded[:, k]
    found = np.zeros((len(padded), BLOCK), np.int64)
    label = exits
    for k in range(BLOCK - 1, -1, -1):
        found[:, k] = label
        label = back[rows, k, label]
    return found[row_of, column]


def spans(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", options: Viterbi = Viterbi()) -> DataFrame:
    """doc_id, lang, score, spans: the language of most letters of each whole text, the share of letters labelled so, and all spans of one language.

    A span is lang, begin, end (code points, end exclusive) from its first word to its last. Equal shares go to the first language in code-point order.
    Null texts and texts without a letter are ``und`` with score 0 and no spans; so is every text when no language was learned. Repeated
    rows come out again, a null key stays null, other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in text_slices(batches, text, 16 * BATCH_BYTES // max(16, len(model.languages))):
            words = split_words([t or "" for t in batch.column(text).to_pylist()])
            rows, names = batch.num_rows, np.array([*model.languages, "und"], object)
            if not model.languages:
                words = Words(*[x[:0] for x in words])
            labels = best_labels(word_scores(words, model), words.text, options.penalty)
            letters = np.bincount(words.text * len(names) + labels, words.letters, rows * len(names)).reshape(rows, -1)
            total = letters.sum(axis=1)
            winner = np.where(total > 0, letters.argmax(axis=1), len(names) - 1)
            share = np.where(total > 0, letters.max(axis=1) / np.maximum(total, 1), 0.0)
            opens = np.ones(len(labels), bool)
            opens[1:] = (labels[1:] != labels[:-1]) | (words.text[1:] != words.text[:-1])
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(labels)) - 1 if len(first) else first
            flat = pa.StructArray.from_arrays([
                pa.array(names[labels[first]], pa.string()), pa.array(words.begin[first].astype(np.int64)), pa.array(words.end[last].astype(np.int64)),
            ], fields=list(span_type.value_type))
            offsets = np.searchsorted(words.text[first], np.arange(rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(key).cast(pa.int64()), pa.array(names[winner], pa.string()), pa.array(share), pa.ListArray.from_arrays(pa.array(offsets), flat, type=span_type),
            ], names=["doc_id", "lang", "score", "spans"])

    return docs.select(key, text).mapInArrow(run, "doc_id long, lang string, score double, spans array<struct<lang: string, begin: bigint, end: bigint>>")
