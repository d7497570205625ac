"""Quality rules that vote, weighed by expectation-maximisation.

Every rule looks at counts of a text and votes good (1), bad (-1) or abstains
(0). No rule decides alone: from how the rules agree over the whole corpus,
expectation-maximisation estimates how often each rule is right about good and
about bad texts where it votes, and the share of good texts. A rule that calls
nearly everything good thus says little by doing so. A text is kept by its
posterior probability.

All is column expressions. The corpus is reduced to the number of texts per
pattern of votes (3 to the number of rules at most), and each EM step is one
aggregation over that small table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import staged

#: Frequent words of the four languages that running text cannot do without.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "a",
    "der", "die", "das", "und", "den", "von", "zu", "ein",
    "le", "la", "les", "de", "et", "des", "un", "une",
    "el", "los", "que", "y", "en", "del", "una", "por",
]

EM_STEPS = 60
#: Where EM starts: accuracy on good texts, accuracy on bad texts, share of good texts.
START = (0.9, 0.6, 0.8)
#: Votes each rule is credited with in advance at the start's accuracies, so that none becomes 0 or 1.
CREDIT = 5.0
#: The accuracies of a rule add up to this at least: 1 would be chance.
BETTER = 1.02

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _covered(starts: Column) -> Column:
    """Words covered by the three-word windows that begin at the sorted ``starts``."""
    last = F.size(starts) - 1
    return F.when(last < 0, 0).otherwise(
        F.aggregate(
            F.transform(starts, lambda at, k: F.when(k < last, F.least(F.lit(3), F.get(starts, k + 1) - at)).otherwise(3)),
            F.lit(0), lambda total, n: total + n))


def _repeated_words(words: Column) -> Column:
    """Number of words in three-word windows that occur twice or more.

    Windows are compared by 64-bit hashes. Sorting finds the hashes that
    repeat; windows with one of them are then found by looking it up, or, when
    many repeat, by sorting (hash, place) pairs.
    """
    windows = F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def places(hashes: Column) -> Column:
        def of(repeats: Column) -> Column:
            looked_up = F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(repeats, h), i)),
                                 lambda i: i.isNotNull())

            def neighbours(pairs: Column) -> Column:
                return F.sort_array(F.filter(
                    F.transform(pairs, lambda x, k: F.when(
                        (F.get(pairs, k - 1)["h"] == x["h"]) | (F.get(pairs, k + 1)["h"] == x["h"]), x["i"])),
                    lambda i: i.isNotNull()))

            by_sorting = _let(F.sort_array(F.transform(
                hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), neighbours)
            found = F.when(F.size(repeats) <= 64, looked_up).otherwise(by_sorting)
            return F.when(F.size(repeats) == 0, 0).otherwise(_let(found, _covered))

        return _let(_let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(
            s, lambda h, k: (k > 0) & (F.get(s, k - 1) == h)))), of)

    return _let(windows, places)


def text_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` and the rules' counts; columns of these names are replaced.

    n_words, word_chars (code points in words), n_symbols (characters of
    ``#*$%&|<>``), n_lines (with a word), n_dup_lines (equal to an earlier one),
    n_repeat_words, n_stop_words, n_letter_words and n_upper_words (words
    without a lower-case letter). Null counts as empty: all are 0.
    """
    names = [*COUNTS, "n_lines", "n_stop_words", "n_letter_words", "n_upper_words"]
    text = F.coalesce(F.col(text_column), F.lit(""))
    space = r"[\x20\x09-\x0D]+"
    rows = docs.drop(*names, "__words", "__lines").withColumns({
        "__words": F.filter(F.split(text, space), lambda w: w != ""),
        "__lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    words, lines = F.col("__words"), F.col("__lines")
    joined = F.array_join(words, " ")
    count = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(words),
        "n_lines": F.size(lines),
        "n_stop_words": F.regexp_count(joined, F.lit(rf"(?<![^ ])(?:{'|'.join(STOP_WORDS)})(?![^ ])")),
        "n_letter_words": F.regexp_count(joined, F.lit(r"(?<![^ ])\p{L}+[,.;:!?]?(?![^ ])")),
        "n_upper_words": F.regexp_count(joined, F.lit(r"(?<![^ ])[^ \p{Ll}]*\p{Lu}[^ \p{Ll}]+(?![^ ])")),
    }
    return rows.withColumns({name: value.cast("long") for name, value in count.items()}).drop("__words", "__lines")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def rules() -> dict[str, Column]:
    """Votes from the counts: 1 good, -1 bad, 0 abstains."""
    n, lines = F.col("n_words"), F.col("n_lines")
    return {
        "length": _vote(n >= 80, n < 50),
        "word_length": _vote(F.col("word_chars").between(3 * n, 9 * n), (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 14 * n)),
        "symbols": _vote(50 * F.col("n_symbols") <= n, 5 * F.col("n_symbols") > n),
        "repeated_lines": _vote((lines >= 2) & (F.col("n_dup_lines") == 0), 3 * F.col("n_dup_lines") > lines),
        "repeated_words": _vote(10 * F.col("n_repeat_words") <= n, 3 * F.col("n_repeat_words") > n),
        "stop_words": _vote(20 * F.col("n_stop_words") >= n, 50 * F.col("n_stop_words") < n),
        "letters": _vote(10 * F.col("n_letter_words") >= 8 * n, 2 * F.col("n_letter_words") < n),
        "capitals": _vote(20 * F.col("n_upper_words") <= n, 3 * F.col("n_upper_words") > n),
    }


@dataclass(frozen=True)
class Estimate:
    """Accuracies of the rules where they vote, on good and on bad texts, and the share of good texts."""

    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]
    share: float


def _posterior(votes: list[Column], on_good: list[Column], on_bad: list[Column], share: Column) -> Column:
    """Probability that a text with these votes is good."""
    odds = F.log(share / (1 - share))
    for vote, good, bad in zip(votes, on_good, on_bad):
        odds += F.when(vote > 0, F.log(good / (1 - bad))).when(vote < 0, F.log((1 - good) / bad)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate(votes: DataFrame, names: list[str], steps: int = EM_STEPS) -> Estimate:
    """Accuracies and share by expectation-maximisation, from all rows of ``votes``."""
    now = Estimate((START[0],) * len(names), (START[1],) * len(names), START[2])
    patterns = votes.groupBy(*names).agg(F.count("*").alias("n")).collect()  # 3 ** rules at most
    if not patterns:
        return now
    patterns = sorted(tuple(row) for row in patterns)
    good, bad, places = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p")), range(len(names))

    def total(when: Column, value: Column, name: str) -> Column:
        return F.sum(F.when(when, value).otherwise(0.0)).alias(name)

    # The present estimate stands in columns beside the patterns: the step's plan, and so its code, stays the same.
    schema = ", ".join(f"{name} int" for name in names) + ", n long, on_good array<double>, on_bad array<double>, share double"
    posterior = _posterior([F.col(name) for name in names], [F.get("on_good", F.lit(i)) for i in places],
                           [F.get("on_bad", F.lit(i)) for i in places], F.col("share"))
    step = [F.sum(good).alias("good"), F.sum("n").alias("all"), *[column for name in names for column in (
        total(F.col(name) > 0, good, f"right_good_{name}"), total(F.col(name) != 0, good, f"voted_good_{name}"),
        total(F.col(name) < 0, bad, f"right_bad_{name}"), total(F.col(name) != 0, bad, f"voted_bad_{name}"))]]
    for _ in range(steps):
        beside = (list(now.on_good), list(now.on_bad), now.share)
        sums = (votes.sparkSession.createDataFrame([(*row, *beside) for row in patterns], schema).coalesce(1)
                .withColumn("p", posterior).agg(*step).first())

        def accuracy(kind: str, start: float) -> list[float]:
            return [(sums[f"right_{kind}_{name}"] + CREDIT * start) / (sums[f"voted_{kind}_{name}"] + CREDIT) for name in names]

        on_good = [max(0.5, value) for value in accuracy("good", START[0])]
        on_bad = [max(BETTER - g, value) for g, value in zip(on_good, accuracy("bad", START[1]))]
        after = Estimate(tuple(on_good), tuple(on_bad), (sums["good"] + 1) / (sums["all"] + 2))
        moved = max(abs(x - y) for x, y in zip((*after.on_good, *after.on_bad, after.share),
                                               (*now.on_good, *now.on_bad, now.share)))
        now = after
        if moved < 1e-5:
            break
    return now


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, the counts, the votes, posterior, base_failed, kept) per row.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated
    windows; ``kept``: not base_failed and posterior at least ``threshold``.
    Null and empty texts fail. Repeated rows are judged alike and each counts
    in the estimate; other columns are ignored; an empty table gives an empty
    result.
    """
    votes = rules()
    names = [f"vote_{name}" for name in votes]
    counted = staged(text_counts(docs.select(id_column, text_column), text_column).drop(text_column)
                     .withColumns({f"vote_{name}": vote for name, vote in votes.items()}), "quality-votes")
    found = estimate(counted, names)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    posterior = _posterior([F.col(name) for name in names], list(map(F.lit, found.on_good)),
                           list(map(F.lit, found.on_bad)), F.lit(found.share))
    return (counted.withColumn("posterior", posterior)
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))
