import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpus_cases import DOC_SCHEMA  # noqa: E402

from eventloom.llm.common import ship  # noqa: E402


@pytest.fixture(autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture
def docs_of(spark):
    """Documents of (doc_id, text) pairs or texts, with columns whose names the operators use themselves."""
    def make(rows, source=lambda i: f"s{i % 3}"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(d, t, "en", source(i), None if t is None else len(t), "x", 7, [1]) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOC_SCHEMA + ", ids string, size int, rows array<int>").repartition(3)

    return make


AWKWARD = [
    None, "", " \n\t ", "one", "two words", "a b c", "A B C", "é ß 字 \U0001f600 x y", "don't we'll 's 'tis !'s", "<|endoftext|> here", "x" * 3000,
    "same same same same same same", "line\nline\n\nline", "tab\x0bvert\x0cfeed\x1cfile\x85next\xa0nb", "﻿ zero​width", "İ K ſ Ⅷ",
]


@pytest.fixture
def awkward():
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta,", "it's", "42", "Ünder", "the"]
    return [*AWKWARD, *[" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(12)], *AWKWARD[:6], "long word soup " * 20_000]


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
