"""Quality rules by distribution divergence, in DataFrame expressions only.

Each document's histogram of character classes and of common words is compared with the histogram
of its language over all documents, by Jensen-Shannon distance (base 2, so 0 to 1). The references
are sums (a few rows, whatever the size of the corpus); each row is then judged by itself, without
a shuffle.

Defined results: a null text is an empty one; a text of fewer than 50 words fails the base rule; a
null or unknown language is compared with the pooled character classes of all unknown ones, and its
words are not judged; a histogram shorter than its guard is not judged; an empty table has no
references and gives no rows; repeated rows are judged alike; other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import SPACE, fresh_names, words_of, written

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on as with be by this are at from".split(),
    "fr": "de la le et les des en un une que dans pour est qui du au par sur pas ce".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo".split(),
}
OTHER = "other"
#: Counted by pattern among what is left without the plain characters. Three more classes follow:
#: further bytes of non-ASCII characters, other marks, and the plain characters of words.
PLAIN = r"[a-z\x20\x09-\x0D]+"
CLASSES = {"upper": "[A-Z]+", "symbol": "[#*$%&|<>]+"}


@dataclass(frozen=True)
class Rules:
    """Limits; the base rule is that of the contract, the rest are those of the method."""

    min_words: int = 50
    max_repeat_percent: int = 50
    class_guard: int = 200  # word characters below which character classes are not judged
    word_guard: int = 80  # words below which common words are not judged
    max_class_distance: float = 0.3
    max_word_distance: float = 0.29


def _language(lang: Column) -> Column:
    low = F.lower(lang)
    return F.when(low.isin(*COMMON_WORDS), low).otherwise(F.lit(OTHER))


def _counted(text: str, words: str, special: str) -> dict[str, Column]:
    """Character counts of a text column without nulls."""
    counts = {"word_chars": F.length(F.array_join(words, ""))}
    counts |= {k: F.length(special) - F.length(F.regexp_replace(special, p, "")) for k, p in CLASSES.items()}
    counts["special"] = F.length(special)
    counts["wide"] = F.octet_length(text) - F.length(text)
    return {k: c.cast("long") for k, c in counts.items()}


def _common_counts(words: str, language: str) -> Column:
    """Counts of the language's common words, then of all other words; null for unknown languages."""
    def counts_of(listed: list[str]) -> Column:
        found = F.filter(words, lambda w: w.isin(*listed))
        # one pass leaves the common words; then each is counted by what its removal takes away
        return F.transform(
            F.array(found),
            lambda own: F.array(
                *[(F.size(own) - F.size(F.array_remove(own, word))).cast("long") for word in listed],
                (F.size(words) - F.size(own)).cast("long"),
            ),
        )[0]

    chosen = F.lit(None).cast("array<bigint>")
    for lang, listed in COMMON_WORDS.items():
        chosen = F.when(F.col(language) == lang, counts_of(listed)).otherwise(chosen)
    return chosen


def _repeated(triples: str) -> Column:
    """Words inside 3-word windows (given by their hashes) that occur twice or more."""
    sorted_ = F.sort_array(triples)
    doubled = F.array_distinct(
        F.transform(F.array(sorted_), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))[0]
    )

    def covered(positions: Column) -> Column:
        """Words under windows that start at the ascending positions."""
        state = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            positions, state,
            lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    def by_lookup(few: Column) -> Column:
        at = F.transform(triples, lambda x, i: F.when(F.array_contains(few, x), i).otherwise(F.lit(-1)))
        return covered(F.filter(at, lambda i: i >= 0))

    def by_sorting(_: Column) -> Column:
        pairs = F.array_sort(F.transform(triples, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.transform(F.filter(s, lambda x, j: ((j > 0) & same(x, j - 1)) | same(x, j + 1)), lambda x: x["i"])

        return covered(F.sort_array(F.transform(F.array(pairs), twice)[0]))

    # the look-up is linear in the doubled windows, so many of them go the way that sorts
    return F.transform(
        F.array(doubled),
        lambda d: F.when(F.size(d) == 0, F.lit(0)).when(F.size(d) <= 32, by_lookup(d)).otherwise(by_sorting(d)),
    )[0].cast("long")


def _distance(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance between counts and a reference distribution."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def summed(n: Column) -> Column:
        terms = F.zip_with(
            counts, F.array(*[F.lit(float(x)) for x in reference]),
            lambda c, q: part(c / n, (c / n + q) / 2) + part(q, (c / n + q) / 2),
        )
        return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)

    return F.sqrt(F.greatest(summed(total) / 2, F.lit(0.0)))


def _with_counts(docs: DataFrame, text_col: str, lang_col: str) -> tuple[DataFrame, dict[str, str]]:
    names = ["text", "lang", "words", "special", "counts", "common"]
    at = dict(zip(names, fresh_names(docs, *[f"q_{n}" for n in names]), strict=True))
    df = docs.withColumns({at["text"]: F.coalesce(F.col(text_col), F.lit("")), at["lang"]: _language(F.col(lang_col))})
    df = df.withColumns({at["words"]: words_of(F.col(at["text"])), at["special"]: F.regexp_replace(at["text"], PLAIN, "")})
    counted = _counted(at["text"], at["words"], at["special"])
    df = df.withColumn(at["counts"], F.struct(*[c.alias(k) for k, c in counted.items()]))
    return df.withColumn(at["common"], _common_counts(at["words"], at["lang"])), at


def _classes(counts: str) -> list[Column]:
    of = F.col(counts)
    counted = [of[name] for name in CLASSES]
    marks = of["special"] - sum(counted[1:], counted[0])
    return [*counted, of["wide"], marks, of["word_chars"] - of["special"]]


def _references(df: DataFrame, lang: str, counts: str, common: str) -> dict[str, dict[str, list[float]]]:
    size = max(map(len, COMMON_WORDS.values())) + 1
    sums = [F.sum(c).alias(f"c{i}") for i, c in enumerate(_classes(counts))]
    sums += [F.sum(F.get(F.col(common), F.lit(i))).alias(f"w{i}") for i in range(size)]
    found: dict[str, dict[str, list[float]]] = {}
    for row in df.groupBy(F.col(lang).alias("lang")).agg(*sums).collect():
        spoken, share = row["lang"], {}
        for kind, n in (("c", len(CLASSES) + 3), ("w", len(COMMON_WORDS.get(spoken, [])) + 1)):
            values = [row[f"{kind}{i}"] or 0 for i in range(n)]
            share[kind] = [v / sum(values) for v in values] if sum(values) else []
        found[spoken] = share
    return found


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, dict[str, list[float]]]:
    """Per language, the share of each character class and of each common word over all documents.

    One row per language of COMMON_WORDS and one for the rest reach the driver."""
    df, at = _with_counts(docs.select(text_col, lang_col), text_col, lang_col)
    return _references(df, at["lang"], at["counts"], at["common"])


def _with_base(df: DataFrame, at: dict[str, str]) -> DataFrame:
    """Adds the base rule's counts."""
    more = ["hashes", "triples", "lines", "base"]
    at |= dict(zip(more, fresh_names(df, *[f"q_{n}" for n in more]), strict=True))
    words, hashes, triples, lines = at["words"], at["hashes"], at["triples"], at["lines"]
    df = df.withColumns({
        hashes: F.transform(words, lambda w: F.xxhash64(w)),
        lines: F.filter(F.split(at["text"], "\n"), lambda line: line.rlike(f"[^{SPACE[1:-1]}]")),
    })
    df = df.withColumn(triples, F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.lit(0), F.size(hashes) - 2)),
        lambda x, i: F.xxhash64(x, F.get(F.col(hashes), i + 1), F.get(F.col(hashes), i + 2)),
    ))
    return df.withColumn(at["base"], F.struct(
        F.size(words).cast("long").alias("n_words"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeated(triples).alias("n_repeat_words"),
    ))


def _verdict(df: DataFrame, at: dict[str, str], reference: dict, rules: Rules) -> dict[str, Column]:
    class_d, word_d = F.lit(None).cast("double"), F.lit(None).cast("double")
    for lang, share in reference.items():
        mine = F.col(at["lang"]) == lang
        if share["c"]:
            class_d = F.when(mine, _distance(F.array(*_classes(at["counts"])), share["c"])).otherwise(class_d)
        if share["w"] and lang in COMMON_WORDS:
            word_d = F.when(mine, _distance(F.col(at["common"]), share["w"])).otherwise(word_d)
    n, repeat = F.col(at["base"])["n_words"], F.col(at["base"])["n_repeat_words"]
    class_d = F.when(F.col(at["counts"])["word_chars"] >= rules.class_guard, class_d)
    word_d = F.when(n >= rules.word_guard, word_d)
    failed = (n < rules.min_words) | (100 * repeat > rules.max_repeat_percent * n)
    near = F.coalesce(class_d <= rules.max_class_distance, F.lit(True))
    near = near & F.coalesce(word_d <= rules.max_word_distance, F.lit(True))
    return {"class_distance": class_d, "word_distance": word_d, "base_failed": failed, "kept": ~failed & near}


def quality_verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()
) -> DataFrame:
    """Per row: id, base counts, ``base_failed``, ``kept``, and both distances (null where not judged).

    The counts are written to the shared folder once: texts are read a single time."""
    df, at = _with_counts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), "text", "lang")
    df = _with_base(df, at)
    kept = ["lang", "counts", "common", "base"]
    counted = written(df.select("id", *[F.col(at[k]).alias(k) for k in kept]), "quality")
    own = {k: k for k in kept}
    verdict = _verdict(counted, own, _references(counted, "lang", "counts", "common"), rules)
    return counted.select(
        F.col("id").alias(id_col), F.col("base.n_words"), F.col("counts.word_chars"), F.col("counts.symbol").alias("n_symbols"),
        F.col("base.n_dup_lines"), F.col("base.n_repeat_words"), *[c.alias(k) for k, c in verdict.items()],
    )


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """The rows whose text is kept, with their own columns. Reads the texts twice and moves none."""
    reference = references(docs, text_col, lang_col)
    df, at = _with_counts(docs, text_col, lang_col)
    df = _with_base(df, at)
    (kept, task) = fresh_names(df, "q_kept", "q_task")
    # the task's number keeps the filter above the columns it reads, which would else be repeated inside it
    df = df.withColumns({kept: _verdict(df, at, reference, rules)["kept"], task: F.spark_partition_id()})
    return df.where(F.col(kept) & (F.col(task) >= 0)).select(*[F.col(f"`{c}`") for c in docs.columns])
