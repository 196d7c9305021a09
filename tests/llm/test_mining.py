import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences, duck_rows, spark_rows
from corpus_cases import SMALL
from eventloom.llm import language, spelling
from eventloom.llm.hard_negatives import Bucket, Mining, Pruning, mine
from eventloom.llm.queries import ORACLES, QUERIES


# ---------------------------------------------------------------- hard negatives

VEC_SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score int, bucket string"


def plain_negatives(rows, every=4, mining=Mining()):
    """Brute force in Python integers over (id, vector, label)."""
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (label, va) in best.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in best.items() if i != a and len(v) == len(va)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if best[i][0] == label][: mining.positives]:
            fits = [i for i in order if best[i][0] != label and mining.low * score[p] <= 100 * score[i] <= mining.high * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[: mining.negatives])]
    return sorted(out)


def random_vectors(n, width, seed, grain=64):
    rng = np.random.default_rng(seed)
    return [[float(x) for x in np.round(v * rng.uniform(0.1, 2) * grain) / grain] for v in rng.standard_normal((n, width))]


@pytest.mark.parametrize("width,pruning", [(3, Pruning()), (3, Pruning(focus=2, rows=40, fewest=10)), (8, Pruning(focus=3, rows=25, fewest=5)), (8, Pruning(rows=7, fewest=1))])
def test_hard_negatives_equal_brute_force(spark, width, pruning):
    vectors = random_vectors(160, width, width)
    rows = [(i, v, i * 7 % 4) for i, v in enumerate(vectors)]
    rows += [(200 + i, [1.0] + [0.5] * (width - 1), i % 2) for i in range(30)]  # equal vectors: only ids decide
    rows += [(300, None, 1), (304, [None] * width, 1), (308, [float("nan")] * width, 1), (312, [float("inf")] * width, 0), (316, vectors[0], None), (None, vectors[0], 1)]
    rows += [(320, [0.0] * width, 1), (324, [0.0] * width, 2), (328, [1.0, 2.0], 1), (332, [2.0, 2.0], 0), (336, [2.0, 1.0], 1), (340, [], 1), (344, [], 1), (348, [], 0)]
    rows += rows[:5] + [(4, vectors[9], 0), (8, vectors[3], 3)]  # repeated whole, and ids with two vectors
    df = spark.createDataFrame([(i, v, label, "x", 1, "b") for i, v, label in rows], VEC_SCHEMA).repartition(3)
    found = mine(df, F.col("vec_id") % 4 == 0, pruning=pruning).collect()
    assert sorted(tuple(r) for r in found) == plain_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VEC_SCHEMA)
    assert mine(empty, F.col("vec_id") % 4 == 0).count() == 0
    nulls = spark.createDataFrame([(1, None, None, None, None, None)], VEC_SCHEMA)
    assert mine(nulls, F.col("vec_id") % 4 == 0).count() == 0


def test_pruning_loses_no_row_and_spares_most():
    rng = np.random.default_rng(4)
    vectors = np.floor(256 * rng.standard_normal((3000, 16)) * rng.uniform(0.5, 1.5, (3000, 1)) * np.array([4, 3, 2] + [0.2] * 13)).astype(np.int64)
    bucket = Bucket(np.arange(3000), np.zeros(3000, np.int64), vectors)
    spared = []
    for k in range(40):
        scores = vectors @ vectors[k]
        least = np.sort(scores)[-20]
        found = bucket.candidates(vectors[k].astype(float), float(least), 6)
        assert set(np.flatnonzero(scores >= least)) <= set(bucket.ids[found].tolist())
        spared.append(1 - len(found) / 3000)
    assert np.mean(spared) > 0.5


def test_scores_beyond_double_precision_are_exact():
    big = np.array([[2**28 + 1, 3], [2**28 - 5, 1], [5, 2**28 + 7]], dtype=np.int64)
    bucket = Bucket(np.arange(3), np.zeros(3, np.int64), big)
    anchor = np.array([2**28 + 3, 2**28 - 9])
    assert bucket.scores(anchor, np.arange(3)).tolist() == [int(row @ anchor) for row in bucket.whole]


# ---------------------------------------------------------------- spelling

def plain_variants(words, times=10):
    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    form, out = {}, []
    close = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def drawn_words():
    rng = random.Random(8)
    words = {}
    for _ in range(220):
        base = "".join(rng.choice("aabcdeéßÿ×") for _ in range(rng.randint(7, 9)))
        words[base] = rng.choice([2, 3, 40, 900])
        for _ in range(rng.randint(0, 3)):
            at, letter = rng.randrange(len(base)), rng.choice("abcÉz")
            words[rng.choice([base[:at] + base[at + 1 :], base[:at] + letter + base[at:], base[:at] + letter + base[at + 1 :], base[1:] + base[0]])] = rng.choice([1, 2, 30, 500])
    long = "".join(rng.choice("abcde") for _ in range(3000))
    words |= {long: 5, long[:1500] + "z" + long[1501:]: 70, long[:-1]: 800, long + "a" * 1024: 3, "a" * 3000: 2, "a" * 1976: 9}
    words |= {"aaaaaaa": 20_000, "aaaaaaaa": 300, "aaaaaaaaa": 4, "abcdefg": 10, "abcdegf": 10}
    return words


@pytest.mark.parametrize("chunk", [2048, 5])
def test_variants_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    words = drawn_words()
    df = spark.createDataFrame([*words.items(), (None, 4), ("nothing", None)], "word string, n long").repartition(3)
    assert sorted((tuple(r) for r in spelling.variants(df).collect()), key=str) == sorted(plain_variants(words), key=str)


def test_vocabulary_deletes_what_the_hash_says(docs_of):
    texts = ["Überzeugung ÜBERZEUGUNG überzeugung", "abcdefgh " * 40 + "short ÷÷÷÷÷÷÷ ×××××××", None, "", "12 34", "Abcdefgh-abcdefgh_ABCDEFGHi\tĀbcdefgh"] + [f"abcdefgh longerword{'x' * (k % 4)}" for k in range(120)]
    counts = {}
    upper = str.maketrans(spelling.UPPER, spelling.UPPER.lower())
    for doc, body in enumerate(texts):
        run = ""
        for c in (body or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c
                continue
            word, run = run.translate(upper), ""
            if word:
                h = zlib.crc32(f"{doc}:{word}".encode())
                word = word[: h % len(word)] + word[h % len(word) + 1 :] if h % 31 == 0 else word
                if len(word) >= 7:
                    counts[word] = counts.get(word, 0) + 1
    found = {r.word: r.n for r in spelling.vocabulary(docs_of(texts)).collect()}
    assert found == {w: n for w, n in counts.items() if n >= 2}
    assert sum(len(w) == 7 and w in ("abcdefgh"[:k] + "abcdefgh"[k + 1 :] for k in range(8)) for w in counts) > 0


def test_spelling_of_nothing(docs_of):
    assert spelling.spelling_variants(docs_of([])).count() == 0
    assert spelling.spelling_variants(docs_of([None, "", "a b c", "onlyonce"])).count() == 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_spelling"])
def test_whole_table_equals_sql(spark, name):
    assert differences(spark_rows(QUERIES[name](spark, SMALL)), duck_rows(connect(SMALL), ORACLES[name])) is None


# ---------------------------------------------------------------- language

def plain_path(scores, penalty):
    labels = scores.shape[1]
    value, back = np.zeros(labels), []
    for row in scores:
        top = int(value.argmax())
        come = [k if value[k] >= value[top] - penalty else top for k in range(labels)]
        value = np.array([max(value[k], value[top] - penalty) + row[k] for k in range(labels)])
        back.append(come)
    path = [int(value.argmax())]
    for come in reversed(back[1:]):
        path.append(come[path[-1]])
    return path[::-1], value.max()


def path_value(path, scores, penalty):
    return sum(scores[k, label] for k, label in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("labels,penalty", [(1, 2.0), (2, 0.0), (3, 1.5), (5, 4.0)])
def test_block_paths_equal_plain_viterbi(labels, penalty):
    rng = np.random.default_rng(labels)
    lengths = [1, 3, 63, 64, 65, 128, 129, 700]
    text = np.repeat(np.array([0, 2, 3, 4, 7, 8, 9, 11]), lengths)
    scores = rng.normal(0, 2, (len(text), labels))
    found = language.best_labels(scores, text, penalty)
    at = 0
    for n in lengths:
        mine, (path, value) = scores[at : at + n], plain_path(scores[at : at + n], penalty)
        assert abs(path_value(found[at : at + n].tolist(), mine, penalty) - value) < 1e-6
        assert found[at : at + n].tolist() == path
        at += n


def test_words_are_runs_of_one_script():
    words = language.split_words(["Größe, 12 été! abcдом", "", "́x 日本ですか", "--"])
    texts = ["Größe, 12 été! abcдом", "", "́x 日本ですか", "--"]
    assert [texts[t][b:e] for t, b, e in zip(words.text, words.begin, words.end)] == ["Größe", "été", "abc", "дом", "́x", "日本", "ですか"]
    assert "".join(map(chr, words.codes)) == "größeétéabcдом́x日本ですか"


def test_spans_of_mixed_texts_and_odd_rows(docs_of, spark):
    english, german, greek = "the thing and that other thought there with", "der die das und nicht schon über zwei", "και το της αυτό που είναι"
    rows = [(f"{english} {english[k:]}", "en") for k in range(8)] + [(f"{german} {german[k:]}", "de") for k in range(8)] + [(greek, "el")] * 4
    rows = [(i, t, lang) for i, (t, lang) in enumerate(rows)] + [(90, None, "en"), (91, "wrong", None), (None, "x", "fr")]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id") < 95)
    assert model.languages == ["de", "el", "en"]
    mixed = f"{english * 3}. {german * 3}; {greek}"
    asked = [mixed, None, "", "1234 !!", english, german, greek, "Слово", "日本", german, "x " * 30_000 + german, "é" * 10]
    got = {r.doc_id: r for r in language.spans(docs_of(asked), model).collect()}
    assert [got[k].lang for k in (1, 2, 3, 4, 5, 6, 9)] == ["und", "und", "und", "en", "de", "el", "de"]
    assert [got[k].score for k in (1, 2, 3, 4)] == [0, 0, 0, 1] and got[1].spans == []
    assert [s.lang for s in got[0].spans] == ["en", "de", "el"] and 0 < got[0].score < 1
    assert mixed[got[0].spans[2].begin : got[0].spans[2].end] == greek and mixed[got[0].spans[1].begin :].startswith("der die")
    assert got[7].lang in model.languages and got[8].lang in model.languages
    none = language.train(spark.createDataFrame([], "doc_id long, text string, lang string"), F.lit(True))
    assert {(r.lang, r.score) for r in language.spans(docs_of(asked), none).collect()} == {("und", 0.0)}
    assert language.spans(docs_of([]), model).count() == 0


def test_held_out_languages_are_right(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    found = QUERIES["op13_language"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    assert found.filter("lang = lang_pred").count() >= 0.98 * found.count() > 100
