"""One query for each operator over its whole table; each derives the asked columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, toxicity
from .attribution import section_counts
from .binary import read_coded, write_coded
from .common import table
from .density import main_text
from .hard_negatives import mine
from .jaccard import group_documents
from .mixing import mix, taken_rows
from .neighbours import search
from .packing import pack
from .quality import Rules, assess, train
from .secret_scan import scan
from .spelling import spelling_variants

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op2_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = write_coded(table(spark, sf_dir, "documents"), TOKENIZER)
    return read_coded(coded).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_documents(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_rows(mix(table(spark, sf_dir, "documents")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.train(docs, labels, ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op9_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_counts(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = assess(docs, Rules(train(docs, labels)))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``; every seventh label is shifted by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of ``documents``, the words one edit away and the form each goes back to."""
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = language.spans(docs, language.train(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_binary_ids": op2_binary_ids,
    "op3_packing": op3_packing,
    "op4_jaccard": op4_jaccard,
    "op5_mixing": op5_mixing,
    "op6_secrets": op6_secrets,
    "op7_toxicity": op7_toxicity,
    "op8_main_text": op8_main_text,
    "op9_section_tokens": op9_section_tokens,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_language": op13_language,
}

ORACLES: dict[str, str] = {
    "op12_spelling": r"""
        WITH RECURSIVE runs AS MATERIALIZED (
            SELECT doc_id, run, length(run) AS size, count(*) AS n FROM (
                SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
                FROM documents)
            GROUP BY ALL
        ), hashed AS MATERIALIZED (
            SELECT run, size, n, 4294967295 - list_reduce(list_prepend(4294967295, list_transform(range(CAST(length(bits) AS BIGINT)),
                    lambda k: CAST(get_bit(bits, CAST(8 * (k // 8) + 7 - k % 8 AS INTEGER)) AS BIGINT))),
                lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) AS h
            FROM (SELECT run, size, n, CAST(encode(concat(doc_id, ':', run)) AS BIT) AS bits FROM runs)
        ), words AS MATERIALIZED (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT n, CASE WHEN h % 31 = 0 THEN concat(substring(run, 1, h % size), substring(run, h % size + 2)) ELSE run END AS word FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ), cut AS MATERIALIZED (
            SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), near AS MATERIALIZED (
            SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
        ), forms AS MATERIALIZED (
            SELECT w.word, w.n, count(x.near) AS n_near, max(x.near_n) AS most, arg_min(x.near, (-x.near_n, x.near)) AS best
            FROM words w LEFT JOIN near x ON x.word = w.word GROUP BY w.word, w.n
        ), judged AS MATERIALIZED (
            SELECT word, n, n_near, CASE WHEN most >= 10 * n THEN best END AS form, CASE WHEN most >= 10 * n THEN most END AS form_n FROM forms
        ), chain(word, root) AS (
            SELECT word, word FROM judged UNION ALL SELECT chain.word, judged.form FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NOT NULL
        )
        SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n FROM judged j JOIN chain c ON c.word = j.word JOIN judged e ON e.word = c.root AND e.form IS NULL
    """,
    "op11_hard_negatives": """
        WITH whole AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.id % 100 = 0 AND a.id <> b.id
        ), positives AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        ), negatives AS (
            SELECT p.anchor_id, p.positive_id, p.positive_score, s.other AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS place
            FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
                AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        )
        SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE place <= 10
    """,
    "op4_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)])) END AS shingles
            FROM words
        ), classes AS (SELECT min(doc_id) AS rep, shingles FROM sets WHERE len(shingles) > 0 GROUP BY shingles),
        tokens AS (SELECT rep, len(shingles) AS n, unnest(shingles) AS token FROM classes),
        links AS (
            SELECT a.rep AS a, b.rep AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.rep <> b.rep
            GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), reach(node, root) AS (
            SELECT rep, rep FROM classes UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node
        ), roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
        SELECT s.doc_id, len(s.shingles) AS n_shingles, coalesce(roots.component_id, s.doc_id) AS component_id
        FROM sets s LEFT JOIN classes c ON c.shingles = s.shingles LEFT JOIN roots ON roots.node = c.rep
    """,
}
