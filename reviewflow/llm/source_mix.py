"""Mixing sources to target weights by Poisson replication.

A document of source s is written N times, N drawn from a Poisson distribution whose mean is the
source's rate: target share times corpus size over source size. The draw inverts the distribution at
a number hashed from the document's id and the seed, so it is the same in every run, on every
executor, and for every order of the rows. All copies are then dealt out by a hash of id and copy.

Defined cases: a null source is a source of its own; a source without a target weight gets none and
is left out; a null doc_id hashes as the empty string; rows that share a doc_id share the draw; an
empty table gives an empty result; text is carried along unread, be it null, empty or very long.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import documents, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# Without given weights a source's target is its size to this power: small sources gain.
TEMPERATURE = 0.7
SEED = "mix-1"

# exp(-mean) must stay a normal number; a larger mean is drawn as a sum of equal parts.
LARGEST_PART = 500.0
HASH_DIGITS = 13


def hashed_unit(*parts: Column) -> Column:
    """A number in [0, 1) from an MD5 hash; SQL engines agree on it."""
    digest = F.md5(F.concat_ws("/", *parts))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long") / F.lit(float(16**HASH_DIGITS))


def cumulative(mean: Column) -> Column:
    """P(N <= k) for k = 0, 1, ... as an array that ends where the tail is below any hashed number."""
    last = (mean + 12 * F.sqrt(mean) + 25).cast("int")
    none = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))

    def next_term(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        sums = F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p))
        return F.struct(p.alias("p"), sums.alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), none, next_term, lambda state: state["sums"])


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Per source: documents, target share, mean number of copies, and the distribution to invert.

    Sizes are counted over all documents, summed in each task before the shuffle, so that a source
    with a third of all rows costs one row a task.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy("source").agg(F.count("*").alias("n_docs"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(TEMPERATURE)))
    else:
        given = spark.createDataFrame(list(weights.items()), "name STRING, weight DOUBLE")
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    whole = weighed.agg(F.sum("weight").alias("all_weights"))
    total = sizes.agg(F.sum("n_docs").alias("all_docs"))
    # Both totals are single rows.
    rated = weighed.join(F.broadcast(whole)).join(F.broadcast(total))
    share = F.col("weight") / F.col("all_weights")
    rated = rated.select("source", "n_docs", share.alias("share"), (share * F.col("all_docs") / F.col("n_docs")).alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_PART)).cast("int")
    return rated.withColumn("parts", parts).withColumn("sums", cumulative(F.col("rate") / F.col("parts")))


def copies(rate_row: dict[str, Column], doc_id: Column, seed: str) -> Column:
    """The number of copies: per part, how many of the cumulative sums lie at or below its number."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))

    def draw(part: Column) -> Column:
        u = hashed_unit(F.lit(seed), key, part.cast("string"))
        return F.size(F.filter(rate_row["sums"], lambda reached: reached <= u))

    drawn = F.transform(F.sequence(F.lit(1), rate_row["parts"]), draw)
    return F.aggregate(drawn, F.lit(0), lambda a, b: a + b)


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    seed: str = SEED,
    partitions: int | None = None,
) -> DataFrame:
    """All copies in a globally shuffled order: the columns of documents, copy (from 1), shuffle_key.

    The rates, one row per source, are written first, so that Catalyst knows their size: under its
    threshold they are broadcast and texts move once, in the final shuffle; above it the join splits
    the tasks of a hot source. `shuffle_key` is a hash of id and copy: copies are dealt over all
    tasks by it and sorted by it within each.
    """
    docs = documents(docs, *COLUMNS)
    rates = stored(source_rates(docs, weights).select(F.col("source").alias("of"), "parts", "sums"), "source-rates")
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col("of")))
    number = copies({"parts": F.col("parts"), "sums": F.col("sums")}, F.col("doc_id"), seed)
    counted = joined.select(*COLUMNS, number.alias("copies")).where("copies > 0")
    exploded = counted.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    key = F.md5(F.concat_ws("/", F.lit(seed), F.lit("order"), F.col("doc_id").cast("string"), F.col("copy").cast("string")))
    keyed = exploded.withColumn("shuffle_key", key)
    dealt = keyed.repartition(partitions, "shuffle_key") if partitions else keyed.repartition("shuffle_key")
    return dealt.sortWithinPartitions("shuffle_key")
