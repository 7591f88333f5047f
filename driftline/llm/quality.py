"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

A text becomes a short vector of statistics. cos(W x + b) with Gaussian W stands for a
Gaussian kernel between such vectors, so ridge regression on those features is kernel ridge
regression with normal equations of fixed size. Each task sums them over its rows, fold by
fold, and Spark sums the tasks' sums: the fit reads all labelled rows however many there
are. The folds give every labelled row a raw score from weights that have not seen it; an
isotonic regression of the labels on those maps raw scores to 0..1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from driftline.llm.common import extend, held_out
from driftline.shared import keyed_join, staged

THRESHOLD = 0.7
FEATURES = 256
FOLDS = 5
_WIDTH = 5.0
_RIDGE = 2e-3
_SEED = 12
# Standard deviations at which a statistic is cut off.
_FAR = 6.0
# Raw scores are counted in steps of one in so many, between -1 and 2.
_STEPS = 512
# Rows under one task's sums, and the fewest tasks.
_ROWS_PER_TASK, _TASKS = 1_000_000, 8
_PIECE = 1 << 20

#: The statistics, in the order of their vector.
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_spread", "distinct_words", "commonest_word", "repeated_trigrams",
    "letters", "upper_case", "digits", "symbols", "blanks", "symbol_words", "short_words", "line_words", "repeated_lines",
    "sentence_ends", "beyond_ascii",
)
_LETTER, _UPPER, _DIGIT, _BLANK, _SYMBOL, _END = 1, 2, 4, 8, 16, 32
_KINDS = np.zeros(256, np.uint8)
for _c in range(256):
    _char = chr(_c)
    _KINDS[_c] = (
        _LETTER * _char.isalpha() | _UPPER * _char.isupper() | _DIGIT * _char.isdigit() | _BLANK * _char.isspace()
        | _SYMBOL * (not _char.isalnum() and not _char.isspace() and _char not in ".,;:'\"-()") | _END * (_char in ".!?")
    )
_RANDOM = np.random.Generator(np.random.PCG64(_SEED))
_MIX = _RANDOM.integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashed(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One 64-bit number for each run of code points; equal runs have equal numbers."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    inside = np.zeros(len(codes) + 1, np.int64)
    inside[starts] = 1
    first = np.maximum.accumulate(np.where(inside[:-1] > 0, np.arange(len(codes)), 0))
    value = (codes.astype(np.uint64) + np.uint64(1)) * _MIX[(np.arange(len(codes)) - first) % len(_MIX)]
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    mixed = upto[stops] - upto[starts]
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def _pieces(text: str) -> Iterator[np.ndarray]:
    """Code points of a text in bounded pieces, cut after a line end or blank where there is one."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + _PIECE)
        if stop < len(text):
            cut = max(text.rfind("\n", at, stop), text.rfind(" ", at + _PIECE // 2, stop))
            stop = cut + 1 if cut > at else stop
        yield np.frombuffer(text[at:stop].encode("utf-32-le", "surrogatepass"), np.uint32)
        at = stop


def statistics(text: str | None) -> np.ndarray:
    """The vector of ``STATISTICS`` of a whole text; null counts as empty."""
    counts = np.zeros(6)
    chars = beyond = symbol_words = 0
    words, lengths, lines = [], [], []
    for codes in _pieces(text or ""):
        low = codes < 256
        kinds = np.where(low, _KINDS[np.where(low, codes, 0)], _LETTER).astype(np.uint8)
        chars += len(codes)
        beyond += int((codes > 127).sum())
        counts += [int(((kinds & k) > 0).sum()) for k in (_LETTER, _UPPER, _DIGIT, _BLANK, _SYMBOL, _END)]
        starts, stops = _runs((kinds & _BLANK) == 0)
        words.append(_hashed(codes, starts, stops))
        lengths.append(stops - starts)
        odd = np.concatenate([[0], np.cumsum((kinds & _SYMBOL) > 0)])
        symbol_words += int((odd[stops] > odd[starts]).sum())
        lines.append(_hashed(codes, *_runs(codes != 10)))
    words, lengths, lines = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (words, lengths, lines))
    n, some = len(words), max(len(words), 1)
    lengths = lengths.astype(float)
    mean = lengths.sum() / some
    _, seen = np.unique(words, return_counts=True)
    triples = words[:-2] * np.uint64(3) ^ words[1:-1] * np.uint64(0x9E3779B97F4A7C15) ^ words[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
    share = counts / max(chars, 1)
    return np.array(
        [
            np.log1p(chars),
            np.log1p(n),
            mean,
            np.sqrt(((lengths - mean) ** 2).sum() / some),
            np.log1p(len(seen)) / np.log1p(some),
            seen.max() / some if n else 0.0,
            1 - len(np.unique(triples)) / len(triples) if len(triples) else 0.0,
            share[0],
            counts[1] / max(counts[0], 1),
            share[2],
            share[4],
            share[3],
            symbol_words / some,
            (lengths <= 3).sum() / some,
            np.log1p(n / max(len(lines), 1)),
            1 - len(np.unique(lines)) / len(lines) if len(lines) else 0.0,
            counts[5] / some,
            beyond / max(chars, 1),
        ]
    )


def fourier(vectors: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Random Fourier features of statistics (rows), and a constant as the last column."""
    rand = np.random.Generator(np.random.PCG64(_SEED))
    weights = rand.normal(size=(len(STATISTICS), FEATURES)) / _WIDTH
    phases = rand.uniform(0, 2 * np.pi, FEATURES)
    scaled = np.clip((vectors - mean) / spread, -_FAR, _FAR)
    out = np.ones((len(vectors), FEATURES + 1))
    out[:, :-1] = np.sqrt(2 / FEATURES) * np.cos(scaled @ weights + phases)
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    score: np.ndarray

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        return np.interp(fourier(vectors, self.mean, self.spread) @ self.weights, self.raw, self.score)


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, vector) for every row of ``docs(doc_id, text)``, written and read back.

    One pass over the texts serves fit and scores; nothing later moves a text.
    """

    def make():
        return lambda texts: [pa.array([statistics(t) for t in texts.to_pylist()], pa.list_(pa.float64()))]

    found = extend(docs.select("doc_id", "text"), "text", make, "vector array<double>", drop=("text",), rows=1000)
    return staged(found, "statistics")


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(fold, quality, vector) of every labelled row of ``measured``, written and read back.

    Of several labels of one document the largest counts. Equal ids share a fold.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = keyed_join(measured, staged(known, "labels"), ["doc_id"], "inner")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    return staged(rows.select(fold.alias("fold"), (F.col("quality") > 0).cast("double").alias("quality"), "vector"), "labelled")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS))


def normal_equations(sample: DataFrame, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Z'[Z y] for each fold of ``labelled`` rows: an array (fold, feature, feature and one)."""
    width = FEATURES + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, width, width + 1))
        for batch in batches:
            fold, y = (np.asarray(batch.column(c)) for c in ("fold", "quality"))
            z = fourier(_matrix(batch.column("vector")), mean, spread)
            for f in np.unique(fold):
                own = fold == f
                total[f] += z[own].T @ np.column_stack([z[own], y[own]])
        for f in range(FOLDS):
            numbers = pa.array(f * width + np.arange(width), pa.int64())
            yield pa.RecordBatch.from_arrays([numbers, pa.array(list(total[f]), pa.list_(pa.float64()))], names=["line", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for line, values in zip(batch.column("line").to_pylist(), batch.column("sums"), strict=True):
                found[line] = found.get(line, 0) + np.asarray(values.values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.float64()))], names=["line", "sums"]
        )

    schema = "line long, sums array<double>"
    tasks = max(_TASKS, math.ceil(sample.count() / _ROWS_PER_TASK))
    lines = sample.coalesce(tasks).mapInArrow(sums, schema).withColumn("task", F.spark_partition_id())
    # Lines of one number meet in the order of their tasks, so that sums come out alike each time.
    lines = lines.repartition(8, "line").sortWithinPartitions("line", "task").select("line", "sums")
    out = np.zeros((FOLDS * width, width + 1))
    for row in lines.mapInArrow(added, schema).collect():
        out[row["line"]] = row["sums"]
    return out.reshape(FOLDS, width, width + 1)


def ridge(equations: np.ndarray) -> np.ndarray:
    """Weights of a summed system Z'[Z y]; the last feature is a constant and is not held down."""
    pull = _RIDGE * max(equations[-1, -2], 1.0) * np.ones(len(equations))
    pull[-1] = 1e-9
    return np.linalg.solve(equations[:, :-1] + np.diag(pull), equations[:, -1])


def isotonic(raw: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean raw score and share of good rows of each pool of adjacent violators, both ascending.

    ``raw`` ascends; of ``count`` rows at each value ``good`` are good.
    """
    pools: list[list[float]] = []
    for x, g, n in zip(raw, good, count, strict=True):
        pools.append([x * n, g, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(measured: DataFrame, labels: DataFrame) -> QualityModel:
    """The model learnt from all ``labels(doc_id, quality)`` of the ``measured`` documents.

    Without a labelled row every text scores 0; with labels of one kind, that label.
    """
    sample = labelled(measured, labels)
    width = len(STATISTICS)
    one = [F.avg(F.col("vector")[i]).alias(f"m{i}") for i in range(width)]
    two = [F.stddev_pop(F.col("vector")[i]).alias(f"s{i}") for i in range(width)]
    moments = sample.agg(F.count("*").alias("n"), *one, *two).first()
    if not moments["n"]:
        flat = np.zeros(1)
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(FEATURES + 1), flat, flat)
    mean = np.array([moments[f"m{i}"] for i in range(width)])
    spread = np.array([moments[f"s{i}"] for i in range(width)])
    spread = np.where(spread > 1e-9, spread, 1.0)
    equations = normal_equations(sample, mean, spread)
    whole = equations.sum(axis=0)
    others = np.stack([ridge(whole - own) for own in equations])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = fourier(_matrix(batch.column("vector")), mean, spread)
            value = (z * others[np.asarray(batch.column("fold"))]).sum(axis=1)
            at = np.rint(np.clip(value, -1, 2) * _STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("quality")], names=["at", "quality"])

    counts = sample.mapInArrow(raw, "at long, quality double").groupBy("at").agg(F.sum("quality").alias("good"), F.count("*").alias("n"))
    # At most three times _STEPS and one rows.
    rows = np.array([tuple(r) for r in counts.orderBy("at").collect()], float)
    return QualityModel(mean, spread, ridge(whole), *isotonic(rows[:, 0] / _STEPS, rows[:, 1], rows[:, 2]))


def score_measured(measured: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``measured``, repeated ones too."""
    sent = measured.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda vectors: _scored(sent.value, _matrix(vectors), threshold)

    return extend(measured, "vector", make, _SCORED, drop=("vector",))


def score_documents(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted, from whole texts.

    A null text counts as empty; empty texts get the score of their statistics. Texts of
    equal statistics have equal scores; repeated rows stay. Columns of those two names are
    replaced, all others stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: _scored(sent.value, _table([statistics(t) for t in texts.to_pylist()]), threshold)

    return extend(docs, "text", make, _SCORED, rows=1000)


_SCORED = "score double, predicted int"


def _table(vectors: list[np.ndarray]) -> np.ndarray:
    return np.array(vectors).reshape(-1, len(STATISTICS))


def _scored(model: QualityModel, vectors: np.ndarray, threshold: float) -> list[pa.Array]:
    score = model.scores(vectors)
    return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]


def fit_held_in(measured: DataFrame, labels: DataFrame) -> QualityModel:
    """The model learnt from the labels of all folds of four but number 2."""
    return fit(measured, labels.where(~held_out(F.col("doc_id"), 4, 2)))
