"""Packing, coded files and section counts against plain loops over the same tokenizers."""

import base64
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import path_of
from tokenizers import Tokenizer

from eventloom.llm import attribution, binary, common, packing, tokens

BPE = path_of("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(BPE)
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_tokenizer(awkward):
    t = Tokenizer.from_file(BPE)
    encoder = tokens.PieceEncoder(BPE)
    ids, bounds = encoder.encode(pa.array(awkward))
    for i, text in enumerate(awkward):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == t.encode(text or "", add_special_tokens=False).ids


def test_encoder_forgets_when_full(monkeypatch, awkward):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 5)
    test_encoder_equals_the_tokenizer(awkward)


def test_pieces_cover_every_document_once(docs_of, awkward, plain):
    rows = [*enumerate(awkward), (None, "no id here"), (0, awkward[0])]
    pieces = packing.pack(docs_of(rows), BPE, window=64).collect()
    spans = {}
    for p in pieces:
        assert 0 <= p.offset and p.offset + p.length <= 64
        spans.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in map(sorted, spans.values()):
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
    full = sorted(spans)
    assert full == list(range(len(full)))
    assert all(sum(n for _, n in spans[s]) == 64 for s in full[:-1])
    once = {d: t for d, t in rows if d not in (0, None)}
    for doc, text in once.items():
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in own]).tolist()
        assert ids == plain(text) and all(p.doc_tokens == len(ids) for p in own)
    assert sum(p.length for p in pieces if p.doc_id == 0) == 2 * len(plain(awkward[0]))
    assert sum(p.length for p in pieces if p.doc_id is None) == len(plain("no id here"))


@pytest.mark.parametrize("window", [1, 7, 64, 100_000])
def test_whole_windows_are_the_concatenation(docs_of, awkward, window):
    table = tokens.token_table(docs_of(awkward[:20]), BPE)
    kind = tokens.id_type(BPE)
    every = np.concatenate([np.frombuffer(r.ids, kind) for r in packing.with_positions(table).orderBy("position").collect()])
    windows = packing.sequences(table, kind, window).orderBy("sequence_id").collect()
    assert [w.sequence_id for w in windows] == list(range(-(-len(every) // window)))
    assert all(w.n_tokens == window for w in windows[:-1])
    assert np.concatenate([np.frombuffer(w.ids, "<u4") for w in windows]).tolist() == every.tolist()


@pytest.mark.parametrize("ranks", [[], [0], [255, 256, 65_535, 65_536, 1 << 24, (1 << 32) - 1, 3], list(range(1000))])
def test_coded_ranks_round_trip(ranks):
    control, data = binary.pack_ranks(np.array(ranks, np.uint32))
    assert binary.unpack_ranks(control, data, len(ranks)).tolist() == ranks
    assert len(control) == -(-len(ranks) // 4)


@pytest.mark.parametrize("shuffled,rows_held", [(False, 1_000_000), (True, 1_000_000), (False, 0)])
def test_coded_files_round_trip_in_key_order(spark, awkward, plain, monkeypatch, shuffled, rows_held):
    monkeypatch.setattr(binary, "BLOCK_IDS", 100)
    monkeypatch.setattr(common, "LOOKUP_ROWS", rows_held)  # 0: the table of parts is joined by a shuffle
    rows = list(enumerate(awkward))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.repartition(5) if shuffled else df.coalesce(2)
    coded = binary.write_coded(df, BPE)
    got = sorted(binary.read_coded(coded).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == list(range(len(rows)))
    at = 0
    for r, (_, text) in zip(got, rows):
        ids = plain(text)
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (at, len(ids), ids)
        at += len(ids)
    vocabulary = {r["id"]: r["rank"] for r in spark.read.parquet(f"{coded.path}/vocab").collect()}
    counts = np.bincount(np.concatenate([plain(t) for t in awkward]))
    ranked = sorted(vocabulary, key=vocabulary.get)
    assert ranked == sorted(vocabulary, key=lambda i: (-counts[i], i)) and set(ranked) == set(np.flatnonzero(counts))


def test_coded_files_of_null_and_repeated_keys_and_of_nothing(spark, plain):
    rows = [(None, "a b"), (3, "x"), (3, "x"), (1, None)]
    got = binary.read_coded(binary.write_coded(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), BPE)).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, 1, 3, 3]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert binary.read_coded(binary.write_coded(empty, BPE)).count() == 0
    assert packing.pack(empty, BPE).count() == 0


def encoding():
    import public_tokenizers

    return attribution.ByteEncoder(path_of("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def plain_lines(text, encoder):
    """Tokens of each line, each token at the line of its first byte."""
    raw = text.encode()
    lines = text.split("\n")
    lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
    bounds = np.cumsum([0] + [len(x.encode()) for x in lines])
    counts, at = [0] * len(lines), 0
    for token in encoder.encoding.encode_ordinary(text):
        counts[int(np.searchsorted(bounds[1:], at, side="right"))] += 1
        at += len(encoder.encoding.decode_single_token_bytes(token))
    assert at == len(raw)
    return [(len(x), c) for x, c in zip(lines, counts)]


def test_line_counts(docs_of, awkward):
    import public_tokenizers

    encoder = encoding()
    got = attribution.section_counts(docs_of(awkward), path_of("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    for doc, text in enumerate(awkward):
        own = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.section)
        assert [(r.end - r.start, r.n_tokens) for r in own] == plain_lines(text or "", encoder)


def test_odd_sections_are_clipped_or_left_out(spark):
    rows = [(1, "one two three", [(0, 3), (4, 99)]), (2, "one two", [(None, 3), None, (4, 7)]), (3, None, [(0, 5)]), (4, "one", [(50, 60)])]
    import public_tokenizers

    df = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start: int, end: int>>")
    got = attribution.section_counts(df, path_of("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, sections="parts").collect()
    bounds = {(r.doc_id, r.section): (r.start, r.end, r.n_tokens) for r in got}
    assert bounds[1, 0] == (0, 3, 1) and bounds[1, 1][:2] == (4, 13) and bounds[2, 0][:2] == (4, 7) and bounds[3, 0] == (0, 0, 0) and bounds[4, 0] == (3, 3, 0)


def test_fields_and_tokens_outside(spark):
    import public_tokenizers

    text, sections = attribution.join_fields(["title", "body"], " :: ")
    rows = [("Große Tiere", "viele Wörter hier"), (None, "b"), ("only", None)]
    df = spark.createDataFrame(rows, "title string, body string").selectExpr("*", "monotonically_increasing_id() as doc_id")
    df = df.select("doc_id", text.alias("text"), sections.alias("sections"))
    got = attribution.section_counts(df, path_of("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, sections="sections").collect()
    encoder = encoding()
    for r in df.collect():
        own = {g.section: g for g in got if g.doc_id == r.doc_id}
        assert sum(g.n_tokens for g in own.values()) == len(encoder.encoding.encode_ordinary(r.text))
        assert [(s.start, s.end) for s in r.sections] == [(own[i].start, own[i].end) for i in (0, 1)]


def test_rule_for_tokens_on_a_border():
    ends, starts, stops = np.array([3, 10, 12]), np.array([0, 5]), np.array([5, 12])
    assert attribution.allocate(ends, starts, stops, "first")[0].tolist() == [2, 1]
    assert attribution.allocate(ends, starts, stops, "most")[0].tolist() == [1, 2]
    tie = attribution.allocate(np.array([4]), np.array([0, 2]), np.array([2, 4]), "most")
    assert tie[0].tolist() == [1, 0] and tie[1].tolist() == [1, 0]
    gap = attribution.allocate(np.array([2, 4]), np.array([2]), np.array([4]), "first")
    assert gap[0].tolist() == [1] and gap[2] == 1


def test_ranks_file_is_read_as_text():
    with open(path_of("byte_bpe_50k.tiktoken"), "rb") as file:
        token, rank = file.readline().split()
    assert encoding().sizes[int(rank)] == len(base64.b64decode(token))


def test_pieces_that_only_look_alike_keep_their_own_ids(monkeypatch):
    halves = "a"
    for _ in range(12):
        halves += halves.translate(str.maketrans("ab", "ba"))
    words = [halves, halves.translate(str.maketrans("ab", "ba")), halves[:1024], halves[1024:2048]]
    encoder = tokens.PieceEncoder(BPE)
    whole = [encoder.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    ids, bounds = encoder.encode(pa.array(words))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == whole
    # every hash the same for pieces of one length: the bytes still decide
    monkeypatch.setattr(common.RangeHash, "of", lambda self, data, begins, stops, part=0: (stops - begins).astype(np.uint64))
    encoder = tokens.PieceEncoder(BPE)
    texts = ["one two six ten", "red and blue", "é über", None, "", "now then", "字 one"]
    whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, bounds = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == whole
