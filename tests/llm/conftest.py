import random

import pytest

from tablesync.llm.common import let_workers_import

WORDS = "the of and river stone light walks under quiet morning paper green seven holds about water small garden opens".split()


@pytest.fixture(autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture
def prose():
    """Random sentences, the same for the same seed."""

    def make(seed, words):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + (r.choice("abcdefgh") * r.randint(0, 2)) for _ in range(words))

    return make


#: Columns whose names operators might use inside, besides those of documents.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words int, score double, q_text string, label string, kept boolean"


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, lang, source) tuples, with clashing extra columns."""

    def make(rows):
        full = [(*r, *([None, None][len(r) - 2 :] if len(r) < 4 else []), None, 1, 0.5, "x", None, None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
