import re
from collections import Counter

import pytest

from tablesync.llm import quality_rules as rules
from tablesync.llm.quality_rules import keep_good, quality_verdicts

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(triples)
    covered = {p for i, t in enumerate(triples) if times[t] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_base_counts(documents, prose):
    texts = [
        None, "", " \t\n", "one", "a b c a b c", "x " * 400, "\n".join(["same line"] * 9 + ["", " "]), prose(1, 300) + " ## é€😀 | <b>",
        " ".join(f"w{i % 41}" for i in range(3000)), " ".join(f"w{i}" for i in range(2000)) * 2, "tab\tand\x0bfeed\x0c\r\nend x y",
        prose(2, 20_000),
    ]
    docs = documents([(i, t, ["en", None, "xx", "DE"][i % 4], "s") for i, t in enumerate(texts)])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in quality_verdicts(docs).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_unlike_documents_go_and_clean_ones_stay(documents, prose):
    common = " ".join(rules.COMMON_WORDS["en"])
    clean = [(i, f"{prose(i, 120)} {common} {prose(i + 99, 60)}", "en", "s") for i in range(60)]
    junk = [(100, " ".join(f"{w}%%%###" for w in clean[0][1].split()), "en", "s"), (101, clean[1][1].upper(), "en", "s"), (102, "short", "en", "s")]
    docs = documents([*clean, *junk, (103, None, None, None)])
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    verdict = {r.doc_id: r for r in quality_verdicts(docs).collect()}
    assert verdict[100].class_distance > 0.3 and not verdict[100].base_failed and verdict[102].class_distance is None


def test_same_rows_same_verdict_and_empty_table(documents, prose):
    docs = documents([(1, prose(5, 90), "en", "s")] * 3)
    assert len({tuple(r) for r in quality_verdicts(docs).collect()}) == 1
    assert quality_verdicts(docs.where("false")).count() == 0 and keep_good(docs.where("false")).count() == 0


def test_no_python_on_the_main_path(documents):
    plan = keep_good(documents([(1, "x", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", ["op7_quality_rules", "op1_mixing", "op5_warc", "op6_parity_jaccard_join"])
def test_queries_agree_with_their_sql(spark, name):
    from check_queries import compare
    SMALL = "/root/testdata/sf0.001"

    good, detail = compare(spark, SMALL, name)
    assert good, detail
