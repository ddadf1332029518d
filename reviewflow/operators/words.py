"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.text import lines_of, words_of

# Words that a sketch keeps, and the most that Spark's sketches can.
TRACKED = 10_000
MOST_TRACKED = 1_000_000

# Spark's sketch of n words that tracks m has room for 4 m / 3, and errs by 3.5 n over its room at most; it tells the
# words whose count is surely above that error, which are all with more than twice the error.
MISSED = 2 * 3.5 * 3 / 4


def split_lines(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of a multi-line text column, as `value`."""
    return texts.select(F.explode(lines_of(column)).alias("value"))


def tokenize(lines: DataFrame) -> DataFrame:
    """Lines to words, empty words left out. A missing line has no words."""
    words = lines.select(F.explode(words_of("value")).alias("word"))
    return words.where(F.col("word") != "")


def count_words(lines: DataFrame) -> DataFrame:
    """Word and count `ct`. Counts are summed before the shuffle, so a hot word costs one row a task."""
    return tokenize(lines).groupBy("word").agg(F.count("*").alias("ct"))


def rank_words(counts: DataFrame) -> DataFrame:
    """Most frequent first, ties in word order. On a stream this needs complete output mode."""
    return counts.orderBy(F.desc("ct"), "word")


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent words; each task keeps k rows, nothing is sorted as a whole."""
    return rank_words(counts).limit(k)


def sketch_words(lines: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """One row: a sketch of the frequent words, of a size that does not grow with the lines, and the number of words.

    Sketches of parts are combined into the sketch of the whole."""
    sketch = F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch")
    return tokenize(lines).agg(sketch, F.count("*").alias("words"))


def top_words_of_sketches(sketches: DataFrame, lines: DataFrame, k: int = 20, tracked: int = TRACKED) -> DataFrame:
    """The k most frequent words of lines whose sketches, by parts, are given: equal to `top_words`, without a
    count of the vocabulary.

    The sketches name candidates, which are counted in the lines. A word that is none has at most `MISSED` * words /
    tracked occurrences; if the k-th candidate does not have more, larger sketches are made, and in the end all words
    are counted.
    """
    spark = lines.sparkSession
    while tracked <= MOST_TRACKED:
        whole = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("words").alias("words"))
        whole = whole.select(F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("items"), "words")
        candidates = whole.select(F.explode("items.item").alias("word"))
        counted = tokenize(lines).join(candidates, "word", "left_semi").groupBy("word").agg(F.count("*").alias("ct"))
        best = top_words(counted, k).collect()
        total = whole.select(F.coalesce("words", F.lit(0))).first()[0]
        sure = len(best) == k and best[-1].ct * tracked > MISSED * total
        # Fewer words than asked for, or many equal ones at the end: the candidates may still be all there are.
        if sure or counted.agg(F.coalesce(F.sum("ct"), F.lit(0))).first()[0] == total:
            return spark.createDataFrame(best, counted.schema)
        tracked *= 8
        if tracked <= MOST_TRACKED:
            sketches = sketch_words(lines, tracked)
    return top_words(count_words(lines), k)
