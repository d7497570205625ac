"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word's probability is the sum over all ways to cut it into pieces, by the
forward algorithm; a text's is the product over its words (runs of letters,
lower case, marked at their start). Probabilities are estimated by
expectation-maximisation: forward-backward gives each piece's expected count in
the words of a language.

The estimate reads whole words of a bounded sample of labelled documents:
``SAMPLE_ROWS`` at most, and up to ``LEAST_ROWS`` more of each language, so that
every label is learned; its tables are as large as the vocabulary times the number of languages.
Scoring reads every whole text and needs no shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ready, slices, staged, texts

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNKNOWN = "und"

#: Labelled documents that the estimate reads at most: those with the smallest seeded hashes of their id.
SAMPLE_ROWS = 6_000
#: Groups by hash into which each language's documents are dealt; one of each is read as well.
LEAST_ROWS = 32
EM_STEPS = 3
#: Expected counts that every piece is credited with in advance.
PRIOR = 0.05

#: Words whose scores one worker keeps.
REMEMBERED = 400_000

#: Letters, with the marks that go with them.
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
#: Up to U+024F, but for six numerals, the same is said by a faster expression.
_PLAIN_WORDS = re.compile(r"[^\W\d_]+").findall
_OTHER = re.compile("[^\x00-\u024f]|[²³¹¼½¾]").search

#: Forward values are scaled up when the largest falls below this.
_SMALL, _SCALE = 1e-200, 1e200
_LOG_SCALE = float(np.log(_SCALE))


def words_of(text: str) -> list[str]:
    """Marked words of a text: letters and their marks only, in lower case."""
    lower = text.lower()
    return [MARK + word for word in (WORDS if _OTHER(lower) else _PLAIN_WORDS)(lower)]


_PIECES: dict[str, tuple[dict[str, int], int]] = {}


def vocabulary(path: str = VOCABULARY) -> tuple[dict[str, int], int]:
    """Numbers of the lower-case pieces from 1 on, -1 for what only begins some; and their greatest length.

    Number 0 is a character without a piece.
    """
    if path not in _PIECES:
        _PIECES.clear()  # what is remembered of words holds for one vocabulary
        _BEGINNINGS.clear()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = sorted({
            model.id_to_piece(i).lower() for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))})
        begun = {piece[:n]: -1 for piece in found for n in range(1, len(piece))}
        _PIECES[path] = begun | {piece: n for n, piece in enumerate(found, 1)}, max(map(len, found), default=1)
    return _PIECES[path]


Arcs = tuple[tuple[int, int], ...]

#: (length, piece number) of the pieces that begin ``_WINDOW`` characters, or the last ones of a word, met before.
_BEGINNINGS: dict[str, Arcs] = {}
_WINDOW = 6


def _arcs(word: str, start: int, pieces: dict[str, int]) -> tuple[Arcs, bool]:
    """(length, piece number) of the pieces at a place in the word, and whether its next characters decide them."""
    end, size, found = start + 1, len(word), []
    n = pieces.get(word[start:end])
    if n is None or n < 0:
        found.append((1, 0))
    while n is not None:
        if n > 0:
            found.append((end - start, n))
        end += 1
        if end > size:
            break
        n = pieces.get(word[start:end])
    return tuple(found), n is None and end - start <= _WINDOW


def lattice(word: str, pieces: dict[str, int]) -> list[Arcs]:
    """For each start in the word, the (length, piece number) of the pieces that begin there."""
    out = []
    for start in range(len(word)):
        window = word[start:start + _WINDOW]
        arcs = _BEGINNINGS.get(window)
        if arcs is None:
            arcs, decided = _arcs(word, start, pieces)
            if decided or len(window) < _WINDOW:  # a shorter one is the rest of its word
                if len(_BEGINNINGS) > REMEMBERED:
                    _BEGINNINGS.clear()
                _BEGINNINGS[window] = arcs
        out.append(arcs)
    return out


def forward(arcs: list[Arcs], q: list[float], longest: int) -> float:
    """Log probability of a word: the sum over its segmentations. ``q``: probability of each piece."""
    alpha, log = [0.0] * (len(arcs) + 1), 0.0
    alpha[0] = 1.0
    for start, pieces in enumerate(arcs):
        value = alpha[start]
        if value < _SMALL:  # only what lies ahead is read again
            for i in range(start, min(len(alpha), start + longest + 1)):
                alpha[i] *= _SCALE
            value = alpha[start]
            log -= _LOG_SCALE
        for length, n in pieces:
            alpha[start + length] += value * q[n]
    return math.log(max(alpha[-1], 1e-320)) + log


def forward_four(arcs: list[Arcs], a: list[float], b: list[float], c: list[float], d: list[float]) -> tuple[float, ...]:
    """``forward`` under four languages at once, for a word short enough to need no scaling."""
    zeros, start = [0.0] * len(arcs), 0
    in_a, in_b, in_c, in_d = [1.0, *zeros], [1.0, *zeros], [1.0, *zeros], [1.0, *zeros]
    for pieces in arcs:
        from_a, from_b, from_c, from_d = in_a[start], in_b[start], in_c[start], in_d[start]
        for length, n in pieces:
            end = start + length
            in_a[end] += from_a * a[n]
            in_b[end] += from_b * b[n]
            in_c[end] += from_c * c[n]
            in_d[end] += from_d * d[n]
        start += 1
    log = math.log
    return log(max(in_a[start], 1e-320)), log(max(in_b[start], 1e-320)), log(max(in_c[start], 1e-320)), log(max(in_d[start], 1e-320))


def unscaled_places(p: np.ndarray) -> int:
    """So many places a word may have before a forward value falls below ``_SMALL``: none is less than the
    smallest probability to the power of the places before it."""
    least = min(float(p.min(initial=0.5)), 0.5)
    return int(math.log(_SMALL) / math.log(least)) - 1 if least > 0.0 else 0


def expected_counts(arcs: list[Arcs], q: list[float]) -> dict[int, float]:
    """Expected number of each piece in a word, over all its segmentations."""
    size = len(arcs)
    alpha, beta = [0.0] * (size + 1), [0.0] * (size + 1)
    alpha[0] = 1.0
    scaled: set[int] = set()  # places from which on alpha is larger by a further _SCALE
    longest = 0
    for start, pieces in enumerate(arcs):
        value = alpha[start]
        if value < _SMALL:
            longest = longest or max(length for arc in arcs for length, _ in arc)
            for i in range(start, min(size, start + longest) + 1):
                alpha[i] *= _SCALE
            value = alpha[start]
            scaled.add(start)
        for length, n in pieces:
            alpha[start + length] += value * q[n]
    out: dict[int, float] = {}
    if alpha[-1] <= 0.0:
        return out
    beta[-1] = 1.0 / alpha[-1]
    for start in range(size - 1, -1, -1):
        if start + 1 in scaled:
            for i in range(start + 1, min(size, start + longest) + 1):
                beta[i] *= _SCALE
        value, total = alpha[start], 0.0
        for length, n in arcs[start]:
            flow = q[n] * beta[start + length]
            total += flow
            out[n] = out.get(n, 0.0) + value * flow
        beta[start] = total
    return out


@dataclass(frozen=True)
class Model:
    """Languages and each piece's probability in them (piece by language)."""

    languages: tuple[str, ...]
    p: np.ndarray
    path: str


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang",
          path: str = VOCABULARY, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Piece probabilities from rows of ``docs`` that have a language: ``sample_rows`` and ``LEAST_ROWS`` of each at most."""
    spark = ready(docs.sparkSession)
    rated = docs.where(F.col(language_column).isNotNull() & F.col(id_column).isNotNull())
    chosen = rated.select(F.col(id_column).alias("id")).orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(sample_rows)
    group = F.pmod(F.xxhash64(F.lit(4), id_column), F.lit(LEAST_ROWS))
    least = rated.groupBy(F.col(language_column).alias("lang"), group.alias("group")).agg(F.min(id_column).alias("id"))
    chosen = chosen.union(least.select("id"))
    # The sample's size is bounded, so it can be broadcast.
    sample = rated.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                          F.col(language_column).alias("lang")).join(F.broadcast(chosen.distinct()), "id", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found: dict[str, Counter] = {}
            for text, lang in zip(texts(batch, "text"), batch.column("lang").to_pylist()):
                found.setdefault(lang, Counter()).update(words_of(text))
            for lang, counter in found.items():
                yield pa.record_batch([pa.array([lang] * len(counter)), pa.array(list(counter), pa.string()),
                                       pa.array(list(counter.values()), pa.int64())], ["lang", "word", "n"])

    counted = staged(sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word")
                     .agg(F.sum("n").alias("n")).repartition("lang", "word"), "language-words")
    languages = tuple(sorted(row.lang for row in counted.select("lang").distinct().collect()))
    n_pieces = max(vocabulary(path)[0].values(), default=0) + 1
    p = np.full((n_pieces, max(1, len(languages))), 1.0 / n_pieces)
    for _ in range(EM_STEPS if languages else 0):
        def expect(batches: Iterator[pa.RecordBatch], p=p) -> Iterator[pa.RecordBatch]:
            pieces, _ = vocabulary(path)
            sums: dict[str, dict[int, float]] = {lang: {} for lang in languages}
            q = {lang: column.tolist() for lang, column in zip(languages, p.T)}
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    own = sums[lang]
                    for piece, times in expected_counts(lattice(word, pieces), q[lang]).items():
                        own[piece] = own.get(piece, 0.0) + n * times
            for language, lang in enumerate(languages):
                own = sums[lang]
                yield pa.record_batch([pa.array([language] * len(own), pa.int32()), pa.array(list(own), pa.int32()),
                                       pa.array(list(own.values()), pa.float64())], ["language", "piece", "times"])

        # At most one row per language and piece.
        sums = (counted.mapInArrow(expect, "language int, piece int, times double")
                .groupBy("language", "piece").agg(F.sum(F.round("times", 6)).alias("times")).toArrow())
        counts = np.full_like(p, PRIOR)
        counts[sums.column("piece").to_numpy(), sums.column("language").to_numpy()] += sums.column("times").to_numpy()
        p = np.round(counts / counts.sum(axis=0), 12)  # the order of sums does not show
    return Model(languages, p, path)


_SCORES: dict[str, tuple[float, ...]] = {}
_SCORED_BY: list = [None]


def word_scores(words: set[str], model: Model) -> dict[str, tuple[float, ...]]:
    """Log probabilities per language of each word, remembered for the model that was used last."""
    last = _SCORED_BY[0]
    if last is not model:
        if last is None or (last.languages, last.path) != (model.languages, model.path) or not np.array_equal(last.p, model.p):
            _SCORES.clear()
        _SCORED_BY[0] = model
    missing = words.difference(_SCORES)
    if len(_SCORES) + len(missing) > REMEMBERED:
        _SCORES.clear()
        missing = words
    pieces, longest = vocabulary(model.path)
    columns = [column.tolist() for column in model.p.T]
    whole = len(columns) - len(columns) % 4
    fours, rest, short = [columns[i:i + 4] for i in range(0, whole, 4)], columns[whole:], unscaled_places(model.p)
    for word in missing:
        arcs = lattice(word, pieces)
        if len(arcs) > short:
            _SCORES[word] = tuple([forward(arcs, q, longest) for q in columns])
            continue
        scores: tuple[float, ...] = ()
        for four in fours:
            scores += forward_four(arcs, *four)
        _SCORES[word] = scores + tuple([forward(arcs, q, longest) for q in rest]) if rest else scores
    return _SCORES


def predict(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` with lang_pred and score, the posterior of that language (uniform prior).

    Null texts, texts without letters and, without learned languages, all texts
    are ``und`` with score 0. Columns of these names are replaced.
    """
    ready(docs.sparkSession)
    others = docs.drop("lang_pred", "score")
    schema = others.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column, 4 << 20):
            cut = [words_of(text) if model.languages else [] for text in texts(batch, text_column)]
            known = word_scores(set(chain.from_iterable(cut)), model)
            names, scores = [], []
            for words in cut:
                if not words:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                tally = Counter(words)
                logs = np.fromiter(chain.from_iterable(map(known.__getitem__, tally)), np.float64, len(tally) * len(model.languages))
                total = logs.reshape(len(tally), -1).T @ np.fromiter(tally.values(), np.float64, len(tally))
                best = int(total.argmax())
                names.append(model.languages[best])
                scores.append(float(1 / np.exp(np.minimum(total - total[best], 0.0)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             [*batch.schema.names, "lang_pred", "score"])

    return others.mapInArrow(run, schema)
