"""Quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised
statistics; ridge scores come from normal equations that each partition sums over
its rows; isotonic regression on rows that the ridge fit has not seen turns the
scores into probabilities.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import map_batches, share_code, utf8
from meritrix.session import stored

#: Width of the kernel map, ridge penalty per row, bins of the calibration, partial
#: sums that reach the driver (each FEATURES squared doubles), and the seed.
FEATURES = 256
PENALTY = 1e-4
BINS = 2_000
PARTIAL_SUMS = 16
SEED = 17

STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_deviation", "longest_word", "upper", "digits", "symbols",
    "loud", "commas", "stops", "other_marks", "non_ascii", "white_space", "log_lines", "words_per_line",
    "repeated_lines", "distinct_words", "most_frequent_word", "repeated_neighbours", "letterless_words",
    "title_words", "letter_entropy",
)

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#*$%&|<>@^~_=+\\/{}[]",
    "loud": b"!?", "commas": b",;:", "stops": b".", "other_marks": b"\"'`()-", "white_space": b" \t\n\r\x0b\x0c",
}
_MEMBERS = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}
_LETTERS = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")) | (np.arange(256) > 127)


def statistics(raw: bytes) -> list[float]:
    """Statistics of one text, all finite; an empty text gives zeros."""
    if not raw:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(raw, np.uint8)
    counts, n = np.bincount(codes, minlength=256), len(raw)
    share = {name: counts[member].sum() / n for name, member in _MEMBERS.items()}
    inside = np.concatenate([[False], ~_MEMBERS["white_space"][codes], [False]])
    borders = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = borders[::2], borders[1::2] - borders[::2]
    words, n_words = raw.split(), max(1, len(starts))
    by_word = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters = counts[_LETTERS]
    p = letters[letters > 0] / max(1, letters.sum())
    lettered = np.logical_or.reduceat(_LETTERS[codes], starts).sum() if len(starts) else 0
    return [
        math.log1p(n), math.log1p(len(starts)), lengths.sum() / n_words, float(lengths.std()) if len(starts) else 0.0,
        math.log1p(int(lengths.max(initial=0))), share["upper"], share["digits"], share["symbols"], share["loud"],
        share["commas"], share["stops"], share["other_marks"], counts[128:].sum() / n, share["white_space"],
        math.log1p(len(lines)), math.log1p(n_words / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
        len(by_word) / n_words, max(by_word.values(), default=0) / n_words, sum(map(eq, words, words[1:])) / n_words,
        (len(starts) - lettered) / n_words, _MEMBERS["upper"][codes[starts]].sum() / n_words,
        float(-(p * np.log(p)).sum()),
    ]


def with_statistics(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, x): one row per document; a null text counts as empty."""
    narrow = docs.select(id_col, F.col(text).cast("string").alias("text_to_judge"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [statistics(raw) for raw in utf8(batch, "text_to_judge")]
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(x, pa.list_(pa.float64()))], [id_col, "x"])

    return map_batches(narrow, work, f"`{id_col}` {narrow.schema[id_col].dataType.simpleString()}, x array<double>")


@dataclass(frozen=True)
class Kernel:
    """z(x): random Fourier features of a standardised x, and a constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: np.ndarray, deviation: np.ndarray) -> Kernel:
        """Frequencies of a Gaussian kernel whose width fits the typical distance
        of two standardised vectors, the square root of their size."""
        random = np.random.default_rng(SEED)
        width = math.sqrt(len(mean))
        return cls(mean, np.where(deviation > 1e-9, deviation, 1.0),
                   random.normal(size=(len(mean), FEATURES - 1)) / width, random.uniform(0, 2 * math.pi, FEATURES - 1))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        standard = np.clip((x - self.mean) / self.scale, -5, 5)
        waves = math.sqrt(2 / (FEATURES - 1)) * np.cos(standard @ self.weights + self.phases)
        return np.hstack([waves, np.ones((len(x), 1))])


@dataclass(frozen=True)
class Model:
    """Ridge weights on the kernel map, then a rising step function with linear
    parts between its knots."""

    kernel: Kernel
    ridge: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.ridge

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def normal_equations(rows: DataFrame, kernel: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y: each partition sums over its rows and hands on one row; a
    second level adds those, so that the driver adds PARTIAL_SUMS of them."""
    share_code(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(kernel)
    schema = pa.schema([("part", pa.int64()), ("sums", pa.binary())])

    def sums_of_rows(batches):
        total = np.zeros((FEATURES, FEATURES + 1))
        for batch in batches:
            z = shared.value(_matrix(batch.column("x")))
            total += z.T @ np.column_stack([z, batch.column("label").to_numpy(zero_copy_only=False)])
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], schema=schema)

    def sums_of_sums(batches):
        total = np.zeros(FEATURES * (FEATURES + 1))
        for batch in batches:
            for sums in batch.column("sums").to_pylist():
                total += np.frombuffer(sums)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], schema=schema)

    partial = rows.select("x", "label").mapInArrow(sums_of_rows, "part bigint, sums binary")
    added = partial.repartition(PARTIAL_SUMS).mapInArrow(sums_of_sums, "part bigint, sums binary")
    total = np.zeros(FEATURES * (FEATURES + 1))
    for row in added.collect():  # PARTIAL_SUMS rows
        total += np.frombuffer(row.sums)
    total = total.reshape(FEATURES, FEATURES + 1)
    return total[:, :-1], total[:, -1]


def isotonic(scores: np.ndarray, means: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and rising levels. A pool is placed at its
    mean score, so that the function is continuous."""
    pools: list[list[float]] = []
    for s, m, w in zip(scores, means, weights):
        pools.append([s * w, m * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(labelled: DataFrame, calibrates: Column) -> Model | None:
    """``labelled`` has x and label (0 or 1). Rows where ``calibrates`` holds fit
    the isotonic part, the others the ridge part. Without rows for the ridge part
    there is no model; without rows to calibrate, scores are only clipped."""
    rows = labelled.where("label IN (0, 1)").select(
        "x", F.col("label").cast("double").alias("label"), F.coalesce(calibrates, F.lit(False)).alias("calibrates"))
    ridge_rows = rows.where("NOT calibrates")
    size = range(len(STATISTICS))
    moments = ridge_rows.agg(F.count(F.lit(1)).alias("n"), *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in size),
                             *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in size)).first()
    if not moments.n:
        return None
    kernel = Kernel.draw(np.array([moments[f"m{i}"] for i in size]), np.array([moments[f"s{i}"] for i in size]))
    gram, target = normal_equations(ridge_rows, kernel)
    penalty = PENALTY * moments.n * np.eye(FEATURES)
    penalty[-1, -1] = 0
    ridge = np.linalg.solve(gram + penalty + 1e-9 * np.eye(FEATURES), target)
    model = Model(kernel, ridge, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    scored = _raw_scores(rows.where("calibrates").select("x", "label"), model)
    low, high = -0.5, 1.5  # ridge scores of 0/1 labels; what lies outside falls into the border bins
    bins = (scored.withColumn("bin", F.least(F.greatest(
        F.floor((F.col("raw") - low) / (high - low) * BINS), F.lit(0)), F.lit(BINS - 1)))
        .groupBy("bin").agg(F.avg("raw").alias("raw"), F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin").collect())  # at most BINS rows
    if not bins:
        return model
    knots, levels = isotonic(*(np.array([r[c] for r in bins], float) for c in ("raw", "mean", "n")))
    return Model(kernel, ridge, knots, levels)


def _raw_scores(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(shared.value.raw(_matrix(batch.column("x"))))], ["label", "raw"])

    return map_batches(rows, work, "label double, raw double")


def score(statistics_of_docs: DataFrame, model: Model | None, *, id_col: str = "doc_id") -> DataFrame:
    """(id, score) for rows of (id, x). Without a model every score is 0.5."""
    if model is None:
        return statistics_of_docs.select(id_col, F.lit(0.5).alias("score"))
    shared = statistics_of_docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(shared.value(_matrix(batch.column("x"))))], [id_col, "score"])

    kind = statistics_of_docs.schema[id_col].dataType.simpleString()
    return map_batches(statistics_of_docs.select(id_col, "x"), work, f"`{id_col}` {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, *, fold_of_id: Column, held_out: int, calibration: int,
             label_col: str = "quality", id_col: str = "doc_id", text: str = "text",
             threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    Labels of the fold ``held_out`` are never used; those of the fold
    ``calibration`` calibrate, the others fit. A null label or id teaches nothing;
    several labels of one id all count. A null text is scored as an empty one;
    repeated rows stay; other columns are ignored. Without usable labels all
    scores are 0.5; an empty table gives no rows. Equal raw scores get equal scores, as
    ties are calibrated together. A text is held whole in one task, with some ten times
    its bytes while it is measured.
    """
    measured = stored(with_statistics(docs, id_col=id_col, text=text))
    usable = labels.select(F.col(id_col), F.col(label_col).alias("label")).where(fold_of_id != held_out)
    model = fit(measured.join(usable, id_col), F.coalesce(fold_of_id == calibration, F.lit(False)))
    held = F.coalesce(fold_of_id == held_out, F.lit(False)).alias("held_out")
    return score(measured, model, id_col=id_col).select(
        id_col, held, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
