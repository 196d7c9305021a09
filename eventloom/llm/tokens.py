"""Token ids of whole documents, and the token table that packing and binary output start from."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import RangeHash, binary_array, store, text_slices, utf8

SPACE, LETTER, DIGIT, OTHER = range(4)
END_ID = 1
CACHED_PIECES = 1_000_000
"""Pieces a worker remembers; beyond that it forgets all and starts again."""

TABLE_SCHEMA = "part int, seq long, doc_id long, start long, n_tokens long, ids binary"


def _byte_classes() -> np.ndarray:
    classes = np.full(256, OTHER, np.uint8)
    classes[[9, 10, 11, 12, 13, 32]] = SPACE
    classes[48:58] = DIGIT
    classes[65:91] = classes[97:123] = LETTER
    classes[128:] = LETTER  # only in plain texts, where they are accented letters
    return classes


CLASSES = _byte_classes()
SHORT_TAILS = np.isin(np.arange(256), [ord(c) for c in "stmd"])
LONG_TAILS = {ord(a): ord(b) for a, b in ("re", "ve", "ll")}


class PieceEncoder:
    """Ids of many texts by a lower-casing BPE with word ends, each distinct piece encoded once.

    The tokenizer of ``word_bpe_49k.json`` splits a lower-cased text into contractions, letter runs, single digits and
    runs of other characters and encodes every piece alone. Texts of ASCII and accented Latin-1 letters
    are split here with array operations; a piece is found by a hash, its bytes are compared, and it is handed to the tokenizer when first seen.
    Texts with other characters, with the marker of a special token or with a piece whose hash belongs to another go to the tokenizer whole.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()
        self.hashes = RangeHash()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.bytes = np.zeros(0, np.uint8)
        self.byte_starts = np.zeros(0, np.int64)
        self.byte_lengths = np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more entry than texts)."""
        data, offsets = utf8(texts)
        plain = self._plain(data, offsets)
        if plain.all():
            ids, bounds, unlike = self._encode_plain(data, offsets)
            if not len(unlike):
                return ids, bounds
            plain[unlike] = False
        rows = np.flatnonzero(plain)
        ids, bounds, unlike = self._encode_plain(*utf8(texts.take(pa.array(rows))))
        plain[rows[unlike]] = False
        each: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for k, row in enumerate(rows.tolist()):
            each[row] = ids[bounds[k] : bounds[k + 1]]
        for row in np.flatnonzero(~plain):
            found = self.tokenizer.encode(texts[int(row)].as_py() or "", add_special_tokens=False).ids
            each[row] = np.array(found, np.uint32)
        return np.concatenate(each) if each else ids, np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)

    @staticmethod
    def _plain(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts of ASCII and the letters from U+00C0 to U+00FF without a special token's opening."""
        odd = np.zeros(len(data) + 1, bool)
        if len(data):
            after = np.empty_like(data)
            after[:-1], after[-1] = data[1:], 0
            lead = data >= 0xC0
            odd[:-1] = (lead & (data != 0xC3)) | (lead & ((after == 0x97) | (after == 0xB7))) | ((data == ord("<")) & (after == ord("|")))
        count = np.concatenate([[0], np.cumsum(odd)])
        return count[offsets[1:]] == count[offsets[:-1]]

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each text's begin, and the texts whose ids are wrong because a piece of theirs is unlike the one remembered."""
        begins, stops, low = split_pieces(data, offsets)
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
        keys = self.hashes.of(low, begins, stops)
        distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHED_PIECES:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        if not known.all():
            self._learn(distinct[~known], low, begins[first[~known]], stops[first[~known]])
            at = np.searchsorted(self.keys, distinct)
        slot = self.slots[at][which]
        lengths = self.lengths[slot]
        ends = np.cumsum(lengths)
        total = int(ends[-1])
        ids = self.flat[np.repeat(self.starts[slot] - (ends - lengths), lengths) + np.arange(total)]
        pieces_before = np.searchsorted(begins, offsets)
        unlike = np.unique(np.searchsorted(offsets, begins[self._unlike(low, begins, stops, slot)], side="right") - 1)
        return ids, np.concatenate([[0], ends])[pieces_before], unlike

    def _unlike(self, low: np.ndarray, begins: np.ndarray, stops: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Pieces that are not the remembered bytes of their slot."""
        lengths = stops - begins
        wrong = lengths != self.byte_lengths[slot]
        same = np.flatnonzero(~wrong)
        sizes = lengths[same]
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        differ = low[within + np.repeat(begins[same], sizes)] != self.bytes[within + np.repeat(self.byte_starts[slot[same]], sizes)]
        if differ.any():
            wrong[same[np.repeat(np.arange(len(same)), sizes)[differ]]] = True
        return np.flatnonzero(wrong)

    def _learn(self, keys: np.ndarray, low: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> None:
        raw = low.tobytes()
        pieces = [raw[a:b].decode() for a, b in zip(begins.tolist(), stops.tolist())]
        lines = [" ".join(pieces[i : i + 1000]) for i in range(0, len(pieces), 1000)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) != len(pieces):
            raise ValueError("the tokenizer does not end every piece with a word-end token")
        begin = np.concatenate([[0], stop[:-1]])
        sizes = stops - begins
        self.byte_starts = np.concatenate([self.byte_starts, len(self.bytes) + np.cumsum(sizes) - sizes])
        self.byte_lengths = np.concatenate([self.byte_lengths, sizes])
        self.bytes = np.concatenate([self.bytes, np.frombuffer("".join(pieces).encode(), np.uint8)])
        slots = np.arange(len(keys)) + len(self.starts)
        self.starts = np.concatenate([self.starts, begin + len(self.flat)])
        self.lengths = np.concatenate([self.lengths, stop - begin])
        self.flat = np.concatenate([self.flat, ids])
        place = np.searchsorted(self.keys, keys)  # both are sorted
        self.keys, self.slots = np.insert(self.keys, place, keys), np.insert(self.slots, place, slots)


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each piece of plain texts, and the lower-cased bytes."""
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:
        accented = np.zeros(len(data), bool)
        accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        low[accented] += 32
    classes = CLASSES[data]
    starts = np.zeros(len(data) + 1, bool)
    starts[0:1] = True
    starts[1:-1] = (classes[1:] != classes[:-1]) | (classes[1:] == DIGIT)
    starts[offsets] = True  # a piece never crosses a text's end
    quotes = np.flatnonzero((low == ord("'")) & starts[:-1])
    if len(quotes):
        text_end = offsets[np.searchsorted(offsets, quotes, side="right")]
        second = low[np.minimum(quotes + 1, len(low) - 1)]
        third = low[np.minimum(quotes + 2, len(low) - 1)]
        short = quotes[SHORT_TAILS[second] & (quotes + 1 < text_end)]
        tails = np.zeros(len(quotes), bool)
        for a, b in LONG_TAILS.items():
            tails |= (second == a) & (third == b)
        long = quotes[tails & (quotes + 2 < text_end)]
        for found, size in ((short, 2), (long, 3)):
            starts[found + 1] = False
            starts[found + size] = True
    edges = np.flatnonzero(starts)
    if not len(data):
        return edges[:0], edges[:0], low
    begins, stops = edges[:-1], edges[1:]
    full = classes[begins] != SPACE
    return begins[full], stops[full], low


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, kept between its tasks."""
    return PieceEncoder(path)


def id_type(path: str) -> str:
    """Smallest little-endian unsigned type that holds every id of the tokenizer."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def token_table(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", end_id: int | None = END_ID, name: str = "tokens") -> DataFrame:
    """Stored table of every document's ids: part, seq (row in its part), doc_id, start, n_tokens, ids.

    ``ids`` holds little-endian unsigned integers of ``id_type(tokenizer)``; ``start`` counts the ids before the
    document inside its part. A null text is empty; ``end_id`` is appended to each document, so no
    document is without ids (with ``end_id=None`` empty texts have none). Repeated rows stay; a null key stays null.
    """
    kind = id_type(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, start = piece_encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch in text_slices(batches, text):
            ids, bounds = encoder.encode(batch.column(text))
            if end_id is not None:
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
            n = np.diff(bounds)
            rows = batch.num_rows
            packed = binary_array(ids.astype(kind).tobytes(), bounds * np.dtype(kind).itemsize)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(rows, part, np.int32)), pa.array(seq + np.arange(rows, dtype=np.int64)), batch.column(key).cast(pa.int64()),
                pa.array(start + bounds[:-1]), pa.array(n), packed,
            ], names=["part", "seq", "doc_id", "start", "n_tokens", "ids"])
            seq, start = seq + rows, start + int(bounds[-1])

    return store(docs.select(key, text).mapInArrow(run, TABLE_SCHEMA), name)
