"""Token counts of sections: whole documents are encoded once, and every token goes to one section by its place."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

RULES = ("first", "most")
COUNT_SCHEMA = "doc_id long, section long, start long, end long, n_tokens long, n_crossing long"
OUTSIDE = -1


class ByteEncoder:
    """A byte-level BPE without special tokens, and the bytes of each of its tokens."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        self.encoding = tiktoken.Encoding("sections", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes of the UTF-8 text."""
        return np.cumsum(self.sizes[self.encoding.encode_to_numpy(text, disallowed_special=())])


@lru_cache(maxsize=2)
def byte_encoder(ranks_path: str, pattern: str) -> ByteEncoder:
    """One encoder per Python worker."""
    return ByteEncoder(ranks_path, pattern)


def allocate(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens of each section, those of them that reach beyond it, and tokens outside all sections.

    All places are byte offsets; sections are in order and do not overlap. Rule "first": a token belongs to the section that
    holds its first byte. Rule "most": to the section that holds most of its bytes, the earlier one on a tie.
    """
    begins = np.concatenate([[0], ends[:-1]])
    if not len(starts) or not len(ends):
        return np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), len(ends)
    first = np.searchsorted(starts, begins, side="right") - 1
    held = (first >= 0) & (begins < stops[first])
    section = np.where(held, first, OUTSIDE)
    if rule == "most":
        last = np.searchsorted(starts, ends - 1, side="right") - 1
        for i in np.flatnonzero((last != first) | ~held):
            span = np.arange(max(first[i], 0), last[i] + 1)
            shared = np.minimum(stops[span], ends[i]) - np.maximum(starts[span], begins[i])
            section[i] = span[np.argmax(shared)] if len(span) and shared.max() > 0 else OUTSIDE
    inside = section >= 0
    own = section[inside]
    crossing = (ends[inside] > stops[own]) | (begins[inside] < starts[own])
    return np.bincount(own, minlength=len(starts)), np.bincount(own[crossing], minlength=len(starts)), int((~inside).sum())


def join_fields(names: Sequence[str], separator: str = "\n") -> tuple[Column, Column]:
    """One text of several fields (null: empty), and its sections (start and end of each field in code points)."""
    texts = [F.coalesce(F.col(n), F.lit("")) for n in names]
    place, sections = F.lit(0), []
    for text in texts:
        end = place + F.char_length(text)
        sections.append(F.struct(place.alias("start"), end.alias("end")))
        place = end + len(separator)
    return F.concat_ws(separator, *texts), F.array(*sections)


def section_counts(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "first", sections: str | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, section (from 0), start and end (code points), n_tokens, n_crossing.

    ``sections`` is a column of ordered, disjoint (start, end) structs in code points; without it the lines are
    the sections, each with its line feed, and an empty or null text has one empty line. Tokens in no section come as section -1, in a row of
    their own with null bounds when there are any, so the counts of a document always sum to its tokens. A null list has no section; a section
    without a bound is left out, bounds are clipped to the text.
    Null keys and repeated rows stay; an empty table gives no rows. Other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(ranks_path, pattern)
        for batch in text_slices(batches, text):
            bounds = batch.column(sections).to_pylist() if sections else [None] * batch.num_rows
            out = []
            for doc, body, own in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist(), bounds):
                body = body or ""
                raw = np.frombuffer(body.encode("utf-8", "surrogatepass"), np.uint8)
                lead = (raw & 0xC0) != 0x80
                if sections is None:
                    feeds = np.flatnonzero(raw == 10) + 1
                    edges = np.concatenate([[0], feeds, [len(raw)]]) if not len(feeds) or feeds[-1] < len(raw) else np.concatenate([[0], feeds])
                    starts, stops = edges[:-1], edges[1:]
                    chars = np.concatenate([[0], np.cumsum(lead)])[edges]
                    low, high = chars[:-1], chars[1:]
                else:
                    low, high = (np.clip(np.array([s[k] for s in own or [] if s and s["start"] is not None and s["end"] is not None], np.int64), 0, len(body)) for k in ("start", "end"))
                    high = np.maximum(low, high)
                    places = np.append(np.flatnonzero(lead), len(raw))
                    starts, stops = places[low], places[high]
                tokens, crossing, outside = allocate(encoder.ends(body), starts, stops, rule)
                n = len(tokens)
                out.append(([doc] * n, np.arange(n), low, high, tokens, crossing))
                if outside:
                    out.append(([doc], [OUTSIDE], [None], [None], [outside], [0]))
            if out:
                columns = [pa.array([x for row in out for x in row[i]], pa.int64()) for i in range(6)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in COUNT_SCHEMA.split(", ")])

    return docs.select(key, text, *([sections] if sections else [])).mapInArrow(run, COUNT_SCHEMA)
