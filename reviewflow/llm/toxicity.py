"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text. Both hold the same
ordinary words, frequent ones and those that look like toxic ones; one goes on with what sets toxic
text apart, the other with filler of equal length. Every window of a text, a word with a blank on
either side, is compressed with both. Ordinary windows come out equally long; the more of a window is
toxic text, the shorter it gets with the toxic dictionary. A document is scored by the calibrated
probability for its two largest differences and for their mean, mean square and share of large ones.

What sets toxic text apart is learned from a bounded sample of labelled documents: words, and word
beginnings, that stand in far more contexts (the words before and after) of toxic text than chance
would have it. Contexts are counted once, so groups of copies weigh no more than one text. Dictionaries and
calibration use different folds; the held-out fold takes part in neither. The classes are sampled at
rates of their own; a sampled text counts in the calibration by one over the rate of its class, so that
scores are probabilities at the share of toxic labels of the whole table.

Defined cases: a null or empty text has no windows and gets the score of no difference; rows without
a label, or with a null one, teach nothing; without any toxic or ordinary sample every document gets
the share of toxic labels, 0 if there are none; repeated rows are scored one by one; only doc_id and
text are read. Texts are scored whole, window by window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, held_out, per_batch, stored, utf8

# Bound of the labelled sample, in documents of each class.
SAMPLE_TOXIC = 2000
SAMPLE_ORDINARY = 12000
# Rates of the sample are multiples of one over this.
RATE_STEPS = 1 << 20
CALIBRATION_FOLD = 4

LEVEL = 12
BASE_BYTES = 16_384
ALIKE_BYTES = 16_384
TOXIC_BYTES = 8192
LARGE = 3
# Windows whose difference a worker remembers; most windows of a text are words seen before.
REMEMBERED = 100_000

# Contexts are counted for words and for beginnings of this many bytes.
STEM = 4
LEAST_RATIO = 6.0
# Log-likelihood, beyond that of the best of as many random words, that sets a word apart.
MARGIN = 2.0

PUNCTUATION = b".,;:!?()\"'"
# Every window starts with these bytes, which end both dictionaries: all windows then compress, and
# their lengths differ by what follows.
ANCHOR = bytes(range(128, 160))
# zstandard starts no match in the last eight bytes; these make every word a full part of its window.
TAIL = bytes(range(160, 168))
THRESHOLD = 0.5


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def score(self, measures: tuple[float, ...]) -> float:
        linear = sum(w * x for w, x in zip(self.weights, (1.0, *measures), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, linear))))


MEASURES = ("first", "second", "mean", "square", "large")


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(content + ANCHOR, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False
    )


class Scale:
    """Both compressors, and what the windows met so far came out as."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.plain, self.other = compressor(ordinary), compressor(toxic)
        self.seen: dict[bytes, int] = {}

    def difference(self, word: bytes) -> int:
        """Bytes that the toxic dictionary saves over the ordinary one."""
        gain = self.seen.get(word)
        if gain is None:
            window = ANCHOR + b" " + word + b" " + TAIL
            gain = len(self.plain.compress(window)) - len(self.other.compress(window))
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = gain
        return gain

    def measures(self, text: bytes) -> tuple[float, ...]:
        """The measures of a text; all zero without a word."""
        first = second = total = square = large = n = 0
        known = self.seen.get
        for word in text.lower().split():
            gain = known(word)
            if gain is None:
                gain = self.difference(word)
            n += 1
            if gain:
                total += gain
                square += gain * gain
                large += gain >= LARGE
                if gain > second:
                    first, second = (gain, first) if gain > first else (first, gain)
        n = max(1, n)
        return float(first), float(second), total / n, square / n, large / n


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, weight, fold of the labelled documents outside the held-out fold, classes cut to size.

    Rows are chosen by a hash of the id, at a rate that makes the expected number the bound; the weight
    is one over that rate.
    """
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IS NOT NULL")
    marks = marks.where(~held_out()).where("doc_id IS NOT NULL")
    sizes = {row.toxic: row.n for row in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect() if row.toxic in (0, 1)}
    steps, weight = F.lit(0), F.lit(0.0)
    for mark, bound in ((0, SAMPLE_ORDINARY), (1, SAMPLE_TOXIC)):
        of_class = math.ceil(RATE_STEPS * min(1.0, bound / max(1, sizes.get(mark, 0))))
        steps = F.when(F.col("toxic") == mark, of_class).otherwise(steps)
        weight = F.when(F.col("toxic") == mark, RATE_STEPS / of_class).otherwise(weight)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(RATE_STEPS))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    # Written first, so that Spark knows how few they are and need not move all texts to them.
    chosen = stored(marks.where(drawn < steps).withColumn("weight", weight).withColumn("fold", fold), "toxic-labels")
    return documents(docs, "doc_id", "text").join(chosen, "doc_id").select("text", "toxic", "weight", "fold")


def contexts(sample: DataFrame) -> DataFrame:
    """Distinct (toxic, stem, word, context), a context being the words before and after."""

    def found(part: pa.RecordBatch) -> pa.RecordBatch:
        marks, stems, words, hashes = [], [], [], []
        for text, toxic in zip(utf8(part.column("text")), part.column("toxic").to_pylist(), strict=True):
            row = [b"", *(word.strip(PUNCTUATION) for word in text.lower().split()), b""]
            for before, word, after in set(zip(row, row[1:], row[2:], strict=False)):
                if len(word) > 1:
                    marks.append(toxic)
                    stems.append(word[:STEM])
                    words.append(word)
                    hashes.append(before + b" " + after)
        names = ["toxic", "stem", "word", "context"]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip((marks, stems, words, hashes), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    rows = sample.mapInArrow(per_batch(found), "toxic INT, stem BINARY, word BINARY, context BINARY")
    return rows.select("toxic", "stem", "word", F.xxhash64("context").alias("context")).distinct()


def dictionaries(sample: DataFrame) -> tuple[bytes, bytes] | None:
    """The content of both dictionaries, None if a class has no text.

    The driver gets the most frequent words only, no more than fill a dictionary.
    """
    sums = F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0")
    counted = stored(contexts(sample).groupBy("stem", "word").agg(*sums), "toxic-words")
    totals = counted.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).first()
    if not totals.n0 or not totals.n1:
        return None
    ordinary = counted.where("n0 > 0").select("word", F.col("n0").alias("n"))
    common = ordinary.orderBy(F.desc("n"), "word").limit(BASE_BYTES // 3).select("word")
    base = spaced([bytes(row.word) for row in common.collect()][::-1])[-BASE_BYTES:]
    marked = telling(counted, "word", totals).union(telling(counted, "stem", totals)).distinct()
    marked = marked.orderBy(F.desc("n"), "word").limit(TOXIC_BYTES // 4)
    apart = spaced([bytes(row.word) for row in marked.select("word").collect()][::-1])[-TOXIC_BYTES:]
    filler = np.random.default_rng(0).integers(1, 32, len(apart), dtype=np.uint8).tobytes()
    alike = spaced(look_alikes(ordinary, base + filler, base + apart)[::-1])[-ALIKE_BYTES:]
    return alike + base + filler, alike + base + apart


def look_alikes(ordinary: DataFrame, plain: bytes, other: bytes) -> list[bytes]:
    """The most frequent ordinary words that the toxic dictionary alone would shorten."""

    def gained(part: pa.RecordBatch) -> pa.RecordBatch:
        scale = scale_of(plain, other)
        words = part.column("word").to_pylist()
        keep = [i for i, word in enumerate(words) if scale.difference(word) >= LARGE]
        return part.take(pa.array(keep, pa.int64()))

    found = ordinary.mapInArrow(per_batch(gained), "word BINARY, n BIGINT")
    return [bytes(row.word) for row in found.orderBy(F.desc("n"), "word").limit(ALIKE_BYTES // 3).collect()]


def telling(counted: DataFrame, by: str, totals: Row) -> DataFrame:
    """Words of toxic contexts, with the number of them, that are set apart by word or beginning.

    With a share p of all contexts toxic, E = p n of n are expected to be; the Poisson log-likelihood
    ratio of what is seen must exceed the logarithm of the number of words tried, and some. The rate of
    a word in toxic text must also be `LEAST_RATIO` times that in ordinary text.
    """
    groups = counted.groupBy(by).agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(F.length(by) >= 3)
    tried = groups.count()
    expected = (F.col("n1") + F.col("n0")) * (totals.n1 / (totals.n0 + totals.n1))
    likelihood = F.col("n1") * F.log(F.col("n1") / expected) - (F.col("n1") - expected)
    often = F.col("n1") * totals.n0 >= LEAST_RATIO * totals.n1 * (F.col("n0") + 0.5)
    apart = groups.where(often & (F.col("n1") > expected) & (likelihood >= math.log(max(2, tried)) + MARGIN))
    words = counted.where("n1 > 0").select("stem", "word", F.col("n1").alias("n"))
    return words.join(apart.select(by), by).select("word", "n")


def spaced(words: list[bytes]) -> bytes:
    """Words with a blank on either side of each."""
    return b"".join(b" " + word + b" " for word in words)


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression of y on a constant and x by Newton steps, lightly shrunk; each row counts by
    its weight."""
    x = np.hstack([np.ones((len(x), 1)), x])
    spread = np.average((x - np.average(x, 0, weight)) ** 2, 0, weight)
    scale = np.maximum(np.sqrt(spread), 1e-9)
    scale[0] = 1.0
    x = x / scale
    w, shrink = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + shrink, x.T @ (weight * (p - y)) + shrink @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w / scale)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = stored(labelled(docs, labels), "toxic-sample")
    folds = sample.groupBy("toxic", (F.col("fold") == CALIBRATION_FOLD).alias("calibrate"))
    counted = folds.agg(F.count("*").alias("n"), F.sum("weight").alias("weight")).collect()
    sizes = {(row.toxic, row.calibrate): row.n for row in counted}
    made = dictionaries(sample.where(F.col("fold") != CALIBRATION_FOLD))
    n1 = sum(row.weight for row in counted if row.toxic)
    n0 = sum(row.weight for row in counted if not row.toxic)
    share = n1 / (n0 + n1) if n0 + n1 else 0.0
    if made is None:
        odds = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(b"", b"", (odds, *[0.0] * len(MEASURES)))
    # A small sample may have no calibration fold of both classes; it is then calibrated on itself.
    calibrate = sample
    if sizes.get((0, True), 0) >= 50 and sizes.get((1, True), 0) >= 50:
        calibrate = sample.where(F.col("fold") == CALIBRATION_FOLD)
    # Bounded by the sample: one short row per document of it.
    points = with_measures(calibrate, made, "toxic INT, weight DOUBLE").toPandas()
    x, y, weight = (points[of].to_numpy(float) for of in (list(MEASURES), "toxic", "weight"))
    return Model(*made, fitted(x, y, weight))


def with_measures(rows: DataFrame, made: tuple[bytes, bytes], carried: str) -> DataFrame:
    """The carried columns, then the measures of `text`."""
    names = [column.split()[0] for column in carried.split(", ")]

    def measured(part: pa.RecordBatch) -> pa.RecordBatch:
        scale = scale_of(*made)
        found = np.array([scale.measures(text) for text in utf8(part.column("text"))])
        columns = [pa.array(found[:, i], pa.float64()) for i in range(len(MEASURES))]
        return pa.RecordBatch.from_arrays([*(part.column(name) for name in names), *columns], [*names, *MEASURES])

    schema = ", ".join([carried, *(f"{measure} DOUBLE" for measure in MEASURES)])
    return rows.select(*names, "text").mapInArrow(per_batch(measured), schema)


_scales: dict[tuple[bytes, bytes], Scale] = {}


def scale_of(ordinary: bytes, toxic: bytes) -> Scale:
    """Made once in a worker."""
    if (ordinary, toxic) not in _scales:
        _scales.clear()
        _scales[ordinary, toxic] = Scale(ordinary, toxic)
    return _scales[ordinary, toxic]


def score_documents(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, and the measures."""
    model = model or train(docs, labels)
    found = with_measures(documents(docs, "doc_id", "text"), (model.ordinary, model.toxic), "doc_id BIGINT")
    linear = F.lit(model.weights[0])
    for weight, measure in zip(model.weights[1:], MEASURES, strict=True):
        linear = linear + F.lit(weight) * F.col(measure)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), linear))))
    scored = found.select("doc_id", held_out().alias("held_out"), score.alias("score"), *MEASURES)
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted, *MEASURES)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that are not predicted toxic. No row is shuffled."""
    model = train(docs, labels)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scale = scale_of(model.ordinary, model.toxic)
        return pa.array([model.score(scale.measures(text)) for text in utf8(texts)], pa.float64())

    return docs.where(score(F.col("text")) < threshold)
