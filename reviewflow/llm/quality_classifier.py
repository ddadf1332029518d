"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic scale.

Each text becomes a short vector of statistics (lengths, repetition, symbols, line shape, entropy,
compressibility). Cosines of random projections of the standardised vector approximate a Gaussian
kernel, so a linear fit on them is a kernel fit that never forms a kernel matrix. Its normal equations
are sums over rows: every partition sums its own, and only the sums travel. A fold that the fit has not
seen then gives the isotonic curve from fitted values to probabilities.

Defined cases: a null or empty text has all statistics zero and is scored like any other; labels that
are null teach nothing; without labels of both classes each document gets the share of label 1, 0.5 if
there are none; repeated rows are scored one by one; only doc_id and text are read. Statistics are of
the whole text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, held_out, per_batch, stored, utf8
from reviewflow.llm.quality_rules import Document

# Bound of the labelled sample, in documents.
SAMPLE_ROWS = 200_000
CALIBRATION_FOLD = 4

FEATURES = 384
RIDGE = 1e-3
SEED = 7
# Partial sums of the normal equations that reach the driver, each of FEATURES x FEATURES numbers.
PARTIAL_SUMS = 12
# Fitted values are put in so many steps before they are calibrated.
STEPS = 1000
THRESHOLD = 0.3

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b".,;:!?\"'()-"
ENDS = (b".", b"!", b"?", b":", b";", b'"', b")")
STATISTICS = 24


def share_of(text: bytes, characters: bytes) -> float:
    return (len(text) - len(text.translate(None, characters))) / max(1, len(text))


def statistics(text: bytes) -> list[float]:
    """The numbers a document is judged by."""
    doc = Document(text)
    words, lines = doc.words, doc.lines
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    counts = Counter(words)
    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = histogram[histogram > 0] / len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    line_words = n / len(lines)
    return [
        math.log1p(n),
        math.log1p(len(text)),
        float(lengths.mean()),
        float(lengths.std()),
        math.log1p(float(lengths.max())),
        float((lengths == 1).mean()),
        len(counts) / n,
        max(counts.values()) / n,
        sum(1 for c in counts.values() if c == 1) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        doc.n_repeat_words / n,
        doc.n_dup_lines / len(lines),
        min(5.0, doc.n_symbols / n),
        share_of(text, b"!"),
        share_of(text, UPPER),
        share_of(text, DIGITS),
        share_of(text, MARKS),
        float(histogram[128:].sum()) / len(text),
        math.log1p(line_words),
        sum(line.rstrip().endswith(ENDS) for line in lines) / len(lines),
        sum(len(line) < 30 for line in lines) / len(lines),
        counts.get(b"|", 0) / n,
        float(-(shares * np.log2(shares)).sum()),
        len(zlib.compress(text, 1)) / len(text),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and `x`, the statistics as binary floats."""

    def measured(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.array(statistics(text), "<f4").tobytes() for text in utf8(part.column("text"))]
        return pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(rows, pa.binary())], ["doc_id", "x"])

    return documents(docs, "doc_id", "text").mapInArrow(per_batch(measured), "doc_id BIGINT, x BINARY")


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(-1, STATISTICS).astype(float)


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    probabilities: np.ndarray = field(default_factory=lambda: np.array([0.5]))

    def fitted(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.fitted(x), self.steps, self.probabilities)


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    random = np.random.default_rng(SEED)
    # A kernel as wide as the typical distance of two standardised vectors.
    directions = random.normal(0.0, 1.0 / math.sqrt(STATISTICS), (STATISTICS, FEATURES))
    phases = random.uniform(0.0, 2 * math.pi, FEATURES)
    z = np.clip((x - mean) / scale, -6.0, 6.0)
    cosines = np.cos(z @ directions + phases) * math.sqrt(2.0 / FEATURES)
    return np.hstack([cosines, np.ones((len(x), 1))])


def summed(rows: DataFrame, terms, width: int) -> np.ndarray:
    """The sum over all rows of a vector of `width` numbers, `terms(x, y)` giving that of one batch.

    Each of a fixed number of partitions sums its rows, so as many vectors reach the driver.
    """

    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += terms(matrix(batch.column("x")), np.array(batch.column("y").to_pylist(), float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    parts = rows.select("x", "y").repartition(PARTIAL_SUMS).mapInArrow(run, "total BINARY").collect()
    return np.sum([np.frombuffer(bytes(part.total)) for part in parts], axis=0)


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """x, y and fold of labelled documents outside the held-out fold, `SAMPLE_ROWS` at most expected."""
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("y IN (0, 1)")
    marks = marks.where(~held_out()).where("doc_id IS NOT NULL")
    rate = min(1.0, SAMPLE_ROWS / max(1, marks.count()))
    unit = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) / float(1 << 20)
    chosen = stored(marks.where(unit < rate).withColumn("fold", F.crc32(F.col("doc_id").cast("string")) % 5), "quality-labels")
    return measured.join(chosen, "doc_id").select("x", "y", "fold")


def isotonic(steps: np.ndarray, ones: np.ndarray, all_rows: np.ndarray) -> np.ndarray:
    """Non-decreasing shares of ones, by pooling neighbours that are out of order."""
    pools: list[list[float]] = []
    for one, n in zip(ones, all_rows, strict=True):
        pools.append([one, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            one, n, width = pools.pop()
            pools[-1] = [pools[-1][0] + one, pools[-1][1] + n, pools[-1][2] + width]
    return np.concatenate([np.full(int(width), one / n) for one, n, width in pools])


def train(measured: DataFrame, labels: DataFrame) -> Model:
    rows = stored(labelled(measured, labels), "quality-sample")
    counts = {(r.y, r.late): r.n for r in rows.groupBy("y", (F.col("fold") == CALIBRATION_FOLD).alias("late")).agg(F.count("*").alias("n")).collect()}
    n1 = sum(n for (y, _), n in counts.items() if y)
    n0 = sum(n for (y, _), n in counts.items() if not y)
    width = FEATURES + 1
    if not counts.get((0, False)) or not counts.get((1, False)):
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        flat = np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros(width)
        return Model(*flat, np.array([0.0]), np.array([share]))
    fit = rows.where(F.col("fold") != CALIBRATION_FOLD)
    moments = summed(fit, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 1 + 2 * STATISTICS)
    n, mean = moments[0], moments[1 : 1 + STATISTICS] / moments[0]
    scale = np.sqrt(np.maximum(moments[1 + STATISTICS :] / n - mean**2, 1e-8))

    def normal_equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x, mean, scale)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = summed(fit, normal_equations, width * width + width)
    gram, moment = sums[: width * width].reshape(width, width), sums[width * width :]
    model = Model(mean, scale, np.linalg.solve(gram + RIDGE * np.eye(width), moment))
    # A small sample may have no calibration fold of both classes; it is then calibrated on itself.
    late = rows.where(F.col("fold") == CALIBRATION_FOLD) if counts.get((0, True)) and counts.get((1, True)) else rows

    def stepped(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        step = np.clip(np.rint(model.fitted(x) * STEPS), -STEPS, 2 * STEPS).astype(int) + STEPS
        return np.concatenate([np.bincount(step, y, 3 * STEPS + 1), np.bincount(step, minlength=3 * STEPS + 1)])

    tally = summed(late, stepped, 2 * (3 * STEPS + 1))
    ones, all_rows = tally[: 3 * STEPS + 1], tally[3 * STEPS + 1 :]
    there = all_rows > 0
    steps = (np.arange(3 * STEPS + 1)[there] - STEPS) / STEPS
    return Model(mean, scale, model.weights, steps, isotonic(steps, ones[there], all_rows[there]))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Texts are read once."""
    measured = stored(document_statistics(docs), "quality-statistics")
    model = train(measured, labels)

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.score(matrix(x)), pa.float64())

    scored = measured.select("doc_id", held_out().alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
