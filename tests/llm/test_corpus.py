"""Jaccard groups, mixing, nearest neighbours and the pipeline against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_cases import DOC_SCHEMA, SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import graph, jaccard, mixing, neighbours, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_sets(texts, words):
    lower = {i: i + 32 for i in range(65, 91)}
    out = {}
    for doc, text in texts.items():
        w = WORD.findall((text or "").translate(lower))
        out[doc] = {tuple(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set()
    return out


def plain_groups(texts, words, percent):
    sets = plain_sets(texts, words)
    holders, shared, parent = defaultdict(list), Counter(), {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for doc, own in sets.items():
        for token in own:
            for other in holders[token]:
                shared[other, doc] += 1
            holders[token].append(doc)
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(sets[d]), root(d)) for d in sets}


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near_corpus(seed):
    """Groups of near copies of many sizes, chains, shared passages, short texts, and one large group."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, texts = draw(60), [None, "", "a", "a", "a b", "A b", "a b c", "a b c d", "a b c d"]
    for size in (2, 3, 9, 40, 120):
        base = draw(rng.randint(60, 200))
        texts += [edited(rng, base, rng.randint(0, 4)) for _ in range(size)]
    chain = draw(150)
    for _ in range(15):
        chain = edited(rng, chain, 2).split()
        texts.append(" ".join(chain))
    texts += [" ".join(passage + draw(n)) for n in [1, 2, 3, 4, 5] * 20]
    texts += [" ".join(draw(100) + passage + draw(50)) for _ in range(30)]
    texts += [" ".join(draw(rng.randint(1, 12))) for _ in range(50)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("join", [jaccard.Join(), jaccard.Join(5, 80), jaccard.Join(combined=0), jaccard.Join(rare=2, combined=3)])
def test_groups_equal_brute_force(docs_of, join):
    texts = dict(enumerate(near_corpus(join.percent)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.group_documents(docs_of(list(texts.values())), join).collect()}
    assert got == plain_groups(texts, join.words, join.percent)


def test_groups_of_null_ids_repeated_rows_and_nothing(docs_of):
    text = "one two three four five six"
    docs = docs_of([(5, text), (5, text), (None, text), (None, None), (7, None), (3, text.upper())])
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in jaccard.group_documents(docs).collect())
    assert got == [(-1, 0, -1), (-1, 4, 3), (3, 4, 3), (5, 4, 3), (5, 4, 3), (7, 0, 7)]
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == [-1, -1, 3, 7]
    assert jaccard.group_documents(docs.limit(0)).count() == jaccard.keep_one(docs.limit(0)).count() == 0
    assert [r.doc_id for r in jaccard.keep_one(docs.filter("doc_id in (5, 7)")).orderBy("doc_id").collect()] == [5, 7]


def test_pairs_stay_few_in_a_large_group(spark, docs_of):
    """1,500 near copies: what is verified grows with the documents, not with the square of the group."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = [edited(rng, base, rng.randint(0, 2)) for _ in range(1500)]
    docs, join = docs_of(texts), jaccard.Join()
    seen, plain = [], jaccard.verify
    try:
        jaccard.verify = lambda pairs, *more: (seen.append(pairs.count()), plain(pairs, *more))[1]
        got = {r.component_id for r in jaccard.group_documents(docs, join).collect()}
    finally:
        jaccard.verify = plain
    assert got == {v[1] for v in plain_groups(dict(enumerate(texts)), 3, 90).values()}
    assert sum(seen) < 20 * len(texts)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)] + [(1, 2), (2, 1), (9, 9)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, **{i: 5 for i in range(200, 300)}, 1: 1, 2: 1}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[n] for n in free)
        full = {n for n in free if unit * weight[n] > cap * sizes[n]}
        if not full:
            return target | {n: unit * weight[n] for n in free}
        target |= {n: cap * sizes[n] for n in full}
        left -= sum(cap * sizes[n] for n in full)
        free -= full
    return target


def mixed(docs, **options):
    return mixing.taken_rows(mixing.mix(docs, **options)).collect()


def test_mix_meets_its_targets_in_whole_copies(docs_of):
    rng = random.Random(6)
    names = ["a", "B", "é", "zz", None, "\U0001f600", ""]
    texts = [" ".join(["w"] * rng.randint(0, 300)) for _ in range(900)]
    chosen = [rng.choices(names, [9, 3, 1, 1, 1, 1, 1])[0] for _ in texts]
    docs = docs_of(texts, source=lambda i: chosen[i])
    rows, again = mixed(docs), mixed(docs.repartition(7))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len(rows) == len(texts)
    assert rows != mixed(docs, seed=18)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in rows:
        name, n = chosen[r.doc_id], len(texts[r.doc_id].split())
        assert r.size == n and r.taken <= 2 * n and (n == 0 or r.taken % n == 0)
        sizes[name] += n
        taken[name] += r.taken
        longest[name] = max(longest[name], n)
    for name, target in plain_targets(sizes).items():
        assert abs(taken[name] - target) <= longest[name] / 2
        assert {(r.source_size, round(r.target, 6)) for r in rows if chosen[r.doc_id] == name} == {(sizes[name], round(target, 6))}


def test_mean_copies_are_the_wanted_fraction(docs_of):
    texts = [" ".join(["w"] * (1 + i % 37)) for i in range(120)]
    docs = docs_of(texts, source=lambda i: "ab"[i % 2]).cache()
    times = np.zeros(120)
    for seed in range(12):
        for r in mixed(docs, seed=seed, block=16):
            times[r.doc_id] += r.taken / r.size / 12
    wanted = plain_targets(Counter({"a": sum(len(t.split()) for t in texts[::2]), "b": sum(len(t.split()) for t in texts[1::2])}))
    for k, name in enumerate("ab"):
        f = wanted[name] / sum(len(t.split()) for t in texts[k::2])
        assert abs(times[k::2].mean() - f) < 0.1


def test_mix_of_nulls_repeats_and_nothing(docs_of):
    docs = docs_of([(1, "a b c"), (1, "a b c"), (1, "a b c"), (None, "d e"), (2, None), (3, "")], source=lambda i: None if i == 3 else "s")
    units = mixing.mix(docs)
    rows = mixing.taken_rows(units).collect()
    assert len(rows) == 6 and all(r.taken <= 2 * r.size for r in rows)
    out = mixing.take(docs, units)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(r.taken for r in rows)
    assert mixing.take(docs.limit(0), mixing.mix(docs.limit(0))).count() == 0


def test_mix_runs_no_python(docs_of):
    plan = mixing.taken_rows(mixing.mix(docs_of(["a b", "c"])))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


def brute_neighbours(ids, vectors, query, top):
    scores = vectors @ vectors[query]
    order = np.lexsort((ids, -scores))
    return [(int(ids[i]), scores[i]) for i in order if i != query][:top]


def answers(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("forest", [neighbours.Forest(candidates=2000), neighbours.Forest(trees=24, candidates=3000, chunk=128)])
def test_neighbours_reach_the_recall(spark, forest):
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((40, 32))
    vectors = (centers[rng.integers(0, 40, 3000)] + 0.6 * rng.standard_normal((3000, 32))).astype(np.float32)
    ids = rng.permutation(100_000)[:3000]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>").repartition(4)
    got = answers(neighbours.search(df, F.col("vec_id") % 20 == 0, forest=forest))
    exact, found, total = vectors.astype(float), 0, 0
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    for query in np.flatnonzero(ids % 20 == 0):
        want = brute_neighbours(ids, exact, query, 20)
        own = got[int(ids[query])]
        found += len({v for v, _ in own} & {v for v, _ in want})
        total += len(want)
        place = {int(i): k for k, i in enumerate(ids)}
        assert all(abs(s - exact[place[v]] @ exact[query]) < 1e-9 for v, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))
    assert found / total >= 0.9


def test_recall_stays_when_the_table_grows():
    """Production parameters on unstructured vectors, where 24,000 candidates are a small share of the rows."""
    forest, n = neighbours.Forest(), 150_000
    vectors = np.random.default_rng(8).standard_normal((n, 64), dtype=np.float32)
    hashes = np.concatenate([neighbours.hash_strings(vectors[at : at + 1024], forest) for at in range(0, n, 1024)])
    hits, asked = 0, range(0, n, 5000)
    for q in asked:
        same = [hashes >> forest.shift(length) == hashes[q] >> forest.shift(length) for length in range(1, forest.symbols + 1)]
        levels = neighbours.ascend(np.stack([s.sum(axis=0) for s in same], axis=1), forest, n)
        assert levels.all()
        found = np.any([same[level - 1][:, tree] for tree, level in enumerate(levels)], axis=0)
        scores = vectors.astype(float) @ vectors[q]
        scores[q] = -np.inf
        hits += found[np.argsort(-scores)[:20]].sum()
    assert hits / (20 * len(asked)) > 0.9


def test_query_finds_the_neighbours_of_the_table(spark, monkeypatch):
    """The registered query through the trees alone: nothing here is left to the root."""
    def no_root(*_):
        raise AssertionError("the trees found too few")

    monkeypatch.setattr(neighbours, "_deal_root", no_root)
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = answers(queries.QUERIES["op1_neighbours"](spark, "/root/testdata/sf0.01"))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = [len({v for v, _ in got[int(ids[q])]} & {v for v, _ in brute_neighbours(ids, vectors, q, 20)}) for q in np.flatnonzero(ids % 20 == 0)]
    assert np.mean(hits) / 20 >= 0.9


def test_a_query_far_from_all_is_answered_by_the_root(spark):
    rng = np.random.default_rng(4)
    near = rng.standard_normal(16) + 0.01 * rng.standard_normal((300, 16))
    alone = -near[0]
    rows = [(i + 1, v.tolist()) for i, v in enumerate(near)] + [(0, alone.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(neighbours.search(df, F.col("vec_id") == 0))
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert [v for v, _ in got[0]] == [v for v, _ in brute_neighbours(ids, vectors, len(rows) - 1, 20)]


def test_neighbours_of_equal_bad_and_few_vectors(spark):
    good = [(i, [1.0, 2.0]) for i in range(60)] + [(100, [2.0, 1.0]), (100, [2.0, 1.0])]
    bad = [(200, None), (220, [0.0, 0.0]), (240, [1.0, float("nan")]), (260, [float("inf"), 1.0]), (280, [None, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], "vec_id long, embedding array<double>, rep string, hash int")
    got = answers(neighbours.search(df, F.col("vec_id") % 20 == 0))
    assert set(got) == {0, 20, 40, 100}
    assert [v for v, _ in got[0]] == list(range(1, 21)) and [v for v, _ in got[40]] == list(range(20))
    assert [v for v, _ in got[100]] == list(range(20)) and {s for _, s in got[100]} == {4.0}
    few = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.0, -1.0])], "vec_id long, embedding array<double>")
    assert answers(neighbours.search(few, F.col("vec_id") % 20 == 0)) == {20: [(1, 0.0)]}
    assert neighbours.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_ascent_stops_at_enough_candidates():
    forest = neighbours.Forest(trees=3, symbols=2, candidates=10)
    counts = np.array([[9, 1], [9, 1], [9, 1]])
    assert neighbours.ascend(counts, forest).tolist() == [1, 2, 2]
    assert neighbours.ascend(np.array([[1, 0]] * 3), forest).tolist() == [1, 1, 1]
    assert neighbours.ascend(np.array([[2, 1]] * 3), forest).tolist() == [1, 1, 1]
    assert neighbours.ascend(np.array([[50, 20]] * 3), forest).tolist() == [2, 2, 2]


def test_deep_cells_and_short_prefixes(spark):
    """A forest whose cells are two symbols deep still answers queries that ascend above a cell."""
    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((400, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    forest = neighbours.Forest(trees=12, candidates=4000, chunk=2)
    got = answers(neighbours.search(df, F.col("vec_id") % 20 == 0, top=5, forest=forest))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in brute_neighbours(np.arange(400), vectors, q, 5)}) for q in range(0, 400, 20))
    assert hits / 100 >= 0.9


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert set(r.doc_id for r in after.collect()) == {d for d, _ in before}
            break
        assert after.columns == columns
        rows = [(r.doc_id, r.text) for r in after.collect()]
        if name == "quality_rules":
            assert set(rows) < before and all(len(WORD.findall(t)) >= 50 for _, t in rows)
        if name == "near_copies":
            groups = plain_groups(dict(before), 5, 80)
            assert sorted(d for d, _ in rows) == sorted(d for d, (n, g) in groups.items() if g == d)
        if name == "secrets":
            assert {d for d, _ in rows} == {d for d, _ in before} and not any(re.search("[0-9a-f]{32}", t) for _, t in rows)
        if name == "mixing":
            assert set(rows) <= before and max(Counter(rows).values()) <= 2
        docs = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "secrets", "mixing", "packing"]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SMALL).count() > 0


def twin_words(doublings):
    """Two words of which each half is followed by itself with a and b swapped: equal for every polynomial modulo a power of two."""
    word = "a"
    for _ in range(doublings):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_only_look_alike_share_no_shingle(docs_of):
    rows = [f"u v {w}" for d in (10, 11, 12) for w in twin_words(d)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.group_documents(docs_of(rows)).collect()}
    assert got == {i: (1, i) for i in range(len(rows))}


def test_sets_whose_ids_clash_stay_apart(spark):
    sets = spark.createDataFrame([(1, 7, 1), (2, 7, 2), (3, 7, 1), (4, 8, 5)], "doc_id long, set_id long, set_check long")
    ids = {r.doc_id: r.set_id for r in jaccard.apart(sets).collect()}
    assert ids[1] == ids[3] != ids[2] and ids[4] == 8
    assert jaccard.apart(sets.filter("doc_id > 2")).count() == 2


def test_low_thresholds_are_refused(docs_of):
    with pytest.raises(ValueError):
        jaccard.group_documents(docs_of(["a b c", "a b c d"]), jaccard.Join(percent=50))
