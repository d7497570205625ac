"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 junk, 2 clean. One weight per
hashed text feature is shared by all grades; ordered thresholds cut the score
into grades: P(grade <= g) = sigmoid(threshold_g - score). A document is
selected by its tail probability P(grade >= wanted), and gets its expected
grade as well.

Features are a document's distinct words, the beginnings of its longer words
(inflected forms share them) and a few coarse shares (capitals, symbols,
repeats, lengths), each hashed as text. The model is fitted on a bounded sample
of the rated rows, ``SAMPLE_ROWS`` at most, whatever their number, and uses the
features that occur in some grade far more often than in others; scoring reads
every whole text and needs no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ready, slices

#: Rated rows that the fit reads at most: those with the smallest seeded hashes of their id.
SAMPLE_ROWS = 12_000
FEATURES = 1 << 18
#: Sampled documents in which a feature must occur: rarer ones say nothing about others.
LEAST_DOCUMENTS = 8
#: Chi-square over the grades that a feature must reach, the least of a large sample and, below it, one for
#: so many rows, but never less than the last: few of the many words reach it by chance.
LEAST_CHI_SQUARE, ROWS_PER_CHI_SQUARE, LEAST_EVER = 60.0, 100, 10.0
STEPS, LEARNING_RATE, PENALTY = 250, 0.1, 1e-4

#: Lengths of the beginnings that are features.
BEGINNINGS = (5, 7)

#: Words whose feature numbers one worker keeps.
REMEMBERED = 500_000

GRADES = 3
CLEAN = 2

_SYMBOLS = "#*$%&|<>!=_{}[]\\^~"
_EDGE = re.compile(r"^[^\w]+|[^\w]+$").sub


def grade(quality, toxic):
    """Grade of a rating: 0 toxic, 1 junk, 2 clean; null where the quality is.

    Toxic is the lowest: its words add up, however many there are, while the
    signs of junk are few per document and so fit into the grade between.
    """
    return F.when(quality.isNotNull(), F.when(toxic > 0, 0).when(quality == 0, 1).otherwise(CLEAN))


def _step(share: float) -> int:
    """Coarse bin of a share."""
    return sum(share > edge for edge in (0.0, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.75))


def shape(text: str, words: list[str], distinct: int) -> list[str]:
    """Coarse shares of a text as feature names."""
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        f"\0symbols {_step(sum(map(text.count, _SYMBOLS)) / n)}",
        f"\0capitals {_step(sum(map(str.isupper, words)) / n)}",
        f"\0repeats {_step(1 - distinct / n)} {min(6, n.bit_length() // 2)}",
        f"\0lines {_step(1 - len(set(lines)) / max(1, len(lines)))}",
        f"\0words {min(10, n.bit_length())}",
        f"\0length {min(12, len(text) // n)}",
    ]


_NUMBERS: dict[str, tuple[int, ...]] = {}


def _numbers(word: str) -> tuple[int, ...]:
    """Feature numbers of a word and its beginnings."""
    word = _EDGE("", word).lower()
    names = [word, *[f"{word[:n]}\0" for n in BEGINNINGS if len(word) > n]]
    return tuple([zlib.crc32(name.encode()) % FEATURES for name in names])


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    words = text.split()
    unique = set(words)
    missing = unique.difference(_NUMBERS)
    if missing:
        if len(_NUMBERS) + len(missing) > REMEMBERED:
            _NUMBERS.clear()
            missing = unique
        _NUMBERS.update((word, _numbers(word)) for word in missing)
    numbers = set(chain.from_iterable(map(_NUMBERS.__getitem__, unique)))
    numbers.update(zlib.crc32(name.encode()) % FEATURES for name in shape(text, words, len(unique)))
    return np.fromiter(sorted(numbers), np.int32, len(numbers))


@dataclass(frozen=True)
class Model:
    """Weights of the features and the ordered thresholds between grades."""

    weights: np.ndarray
    thresholds: tuple[float, ...]

    def tail(self, score, at_least: int):
        """P(grade >= at_least)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[at_least - 1] - score, -500, 500)))

    def expected(self, score):
        return sum(self.tail(score, g) for g in range(1, len(self.thresholds) + 1))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _useful(columns: np.ndarray, of: np.ndarray, grades: np.ndarray, n_grades: int) -> np.ndarray:
    """Which features occur often enough, and in some grade far more often than in others."""
    n = max(1, len(grades))
    seen = np.bincount(columns, minlength=FEATURES)
    chi_square = np.zeros(FEATURES)
    for g in range(n_grades):
        expected = np.maximum(seen * np.count_nonzero(grades == g) / n, 1e-9)
        found = np.bincount(columns[of == g], minlength=FEATURES)
        chi_square += (found - expected) ** 2 / expected * (expected > 1e-9)
    wanted = min(LEAST_CHI_SQUARE, max(LEAST_EVER, n / ROWS_PER_CHI_SQUARE))
    return (seen >= min(LEAST_DOCUMENTS, max(1, n // 4))) & (chi_square >= wanted)


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES) -> Model:
    """Weights and thresholds by penalised maximum likelihood (Adam, full batches, from zero)."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    columns = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    useful = _useful(columns, np.repeat(grades, sizes), grades, n_grades)
    document = np.repeat(np.arange(len(rows)), sizes)[useful[columns]]
    used, column = np.unique(columns[useful[columns]], return_inverse=True)
    # thresholds: the first, then the logarithms of the gaps
    parameters = np.concatenate((np.zeros(len(used)), [-1.0], np.zeros(n_grades - 2)))
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    n = max(1, len(rows))
    for step in range(1, STEPS + 1):
        weights, gaps = parameters[:len(used)], np.exp(parameters[len(used) + 1:])
        edges = np.concatenate(([-np.inf], parameters[len(used)] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        score = np.bincount(document, weights[column], len(rows)) if len(used) else np.zeros(len(rows))
        above, below = _sigmoid(edges[grades + 1] - score), _sigmoid(edges[grades] - score)
        likely = np.maximum(above - below, 1e-12)
        d_above, d_below = above * (1 - above) / likely, below * (1 - below) / likely
        to_score = (d_above - d_below) / n
        to_edges = (np.bincount(grades + 1, -d_above, n_grades + 1) + np.bincount(grades, d_below, n_grades + 1)) / n
        to_edges = to_edges[1:-1]
        gradient = np.concatenate((
            np.bincount(column, to_score[document], len(used)) + PENALTY * weights if len(used) else np.zeros(0),
            [to_edges.sum()], np.cumsum(to_edges[::-1])[::-1][1:] * gaps))
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        parameters = parameters - LEARNING_RATE * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(FEATURES)
    weights[used] = parameters[:len(used)]
    return Model(weights, tuple(parameters[len(used)] + np.concatenate(([0.0], np.cumsum(np.exp(parameters[len(used) + 1:]))))))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model fitted on at most ``sample_rows`` rated documents; None where there is none.

    A document is an id and a grade; where rows repeat an id, its smallest text is read, so the bound holds for rows too.
    """
    ready(docs.sparkSession)
    rated = labels.select(F.col(id_column).alias("id"), grade(F.col("quality"), F.col("toxic")).alias("grade")).where(
        "id is not null and grade is not null")
    sample = rated.distinct().orderBy(F.xxhash64(F.lit(7), "id"), "id", "grade").limit(sample_rows)
    # The sample's size is bounded, so it can be broadcast.
    chosen = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(sample), "id")
    chosen = chosen.groupBy("id", "grade").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [features(text or "").tolist() for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("id"), batch.column("grade"), pa.array(found, pa.list_(pa.int32()))],
                                  ["id", "grade", "features"])

    rows = chosen.mapInArrow(run, "id long, grade int, features array<int>").toArrow()
    if not rows.num_rows:
        return None
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")  # the fit does not depend on the tasks' order
    lists = rows.column("features").combine_chunks()
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    return fit([values[offsets[i]:offsets[i + 1]] for i in order],
               rows.column("grade").to_numpy()[order].astype(np.int64))


def score(docs: DataFrame, model: Model | None, text_column: str = "text", at_least: int = CLEAN,
          threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs`` with expected_grade, tail_probability and kept.

    Columns of these names are replaced. Null and empty texts have no words and
    are scored by that. Without a model everything is kept, with null scores:
    nothing is known against it.
    """
    names = ["expected_grade", "tail_probability", "kept"]
    others = docs.drop(*names)
    if model is None:
        return others.withColumns({names[0]: F.lit(None).cast("double"), names[1]: F.lit(None).cast("double"),
                                   names[2]: F.lit(True)})
    ready(docs.sparkSession)
    schema = others.withColumns({names[0]: F.lit(0.0), names[1]: F.lit(0.0), names[2]: F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            found = np.array([model.weights[features(text or "")].sum() for text in batch.column(text_column).to_pylist()])
            tail = model.tail(found, at_least)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.expected(found)), pa.array(tail), pa.array(tail >= threshold)],
                [*batch.schema.names, *names])

    return others.mapInArrow(run, schema)
