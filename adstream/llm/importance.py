"""Importance resampling towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch
from adstream.llm.terms import spaced

_CACHED_BYTES = 64
_CACHED_FEATURES = 400_000
# Thresholds that one counting job tries: four steps of a bisection at once.
_SECTIONS = 16
_LAST_ID = (1 << 63) - 1


class _Buckets(dict):
    """Buckets of features; short ones are remembered within a bound."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= _CACHED_BYTES:
            if len(self) >= _CACHED_FEATURES:
                self.clear()
            self[feature] = bucket
        return bucket


def _features(text: bytes | None, ngrams: int) -> tuple[int, list[bytes]]:
    """(number of words, all runs of 1 to ``ngrams`` words)."""
    words = spaced(text).split()
    found = words
    for n in range(2, ngrams + 1):
        found = found + [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), found


def _bucket_arrays(batch: pa.RecordBatch, place: _Buckets, ngrams: int) -> tuple[np.ndarray, list[int], list[int]]:
    """(buckets of all features of a batch, where each row's end, words per row)."""
    parts, ends, words, total = [], [], [], 0
    for text in batch.column(0).cast(pa.binary()):
        n, features = _features(text.as_py(), ngrams)
        parts.append(np.fromiter(map(place.__getitem__, features), np.int32, len(features)))
        total += len(features)
        ends.append(total)
        words.append(n)
    return np.concatenate(parts) if parts else np.empty(0, np.int32), ends, words


def _count(buckets: int, ngrams: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            counts += np.bincount(_bucket_arrays(batch, place, ngrams)[0], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(counts[used])], names=["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, text_col: str, buckets: int, ngrams: int) -> DataFrame:
    """(bucket, n) over all texts; a task sends one row per bucket at most."""
    found = docs.select(F.col(text_col).cast("string")).mapInArrow(_count(buckets, ngrams), "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(counts: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """A gain per bucket: a thousand times the log ratio of its smoothed shares, rounded down."""
    sums = [table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for table in (counts, target)]
    every = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(counts.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    )
    real = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double") + 1
    all_s, all_t = (F.lit(float(total + buckets)) for total in sums)
    ratio = (real("t") * all_s) / (real("s") * all_t)
    gains = both.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("gain"))
    # As many rows as there are buckets, whatever the corpus.
    found = gains.toArrow()
    values = np.zeros(buckets, np.int64)
    values[found.column("bucket").to_numpy()] = found.column("gain").to_numpy()
    return values


def _score(gains: np.ndarray, ngrams: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _Buckets(len(gains))
        for batch in batches:
            found, ends, words = _bucket_arrays(batch, place, ngrams)
            sums = np.concatenate(([0], np.cumsum(gains[found])))
            stops = np.array([0, *ends])
            yield pa.record_batch(
                [
                    batch.column(1),
                    pa.array(words, pa.int64()),
                    pa.array(np.diff(stops)),
                    pa.array(np.diff(sums[stops])),
                ],
                names=["_id", "_words", "n_features", "weight"],
            )

    return run


def _noise(row_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from a hash of the id, rounded down."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(uniform)))


def nth_largest(rows: DataFrame, value: Column, n: int) -> int:
    """The n-th largest of the whole numbers ``value``, n from 1 to the number of rows, by exact counts.

    Each job counts the rows above thresholds that cut the interval in question in 16; nothing
    is sorted, and only counts come back.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        cuts = sorted({low + (high - low) * k // _SECTIONS for k in range(1, _SECTIONS)} - {low} | {high})
        counts = rows.agg(*(F.count_if(value >= F.lit(cut)) for cut in cuts)).first()
        enough = [cut for cut, count in zip(cuts, counts) if count >= n]
        short = [cut for cut, count in zip(cuts, counts) if count < n]
        low, high = max(enough, default=low), min(short, default=high + 1) - 1
    return low


def _first_n(rows: DataFrame, n: int) -> Column:
    """A condition that exactly ``n`` rows meet: the highest scores, ties to smaller ids, then row keys."""
    if n <= 0:
        return F.lit(False)
    score, place, key = F.col("score"), F.col("_place"), F.col("_key")
    cut = nth_largest(rows, score, n)
    ties = rows.filter(score == cut)
    n -= rows.filter(score > cut).count()
    # The complement turns the order around without overflow.
    last_place = ~nth_largest(ties, F.bitwise_not(place), n)
    n -= ties.filter(place < last_place).count()
    last_key = ~nth_largest(ties.filter(place == last_place), F.bitwise_not(key), n)
    first = (place < last_place) | ((place == last_place) & (key <= last_key))
    return (score > cut) | ((score == cut) & first)


def _ranked(drawn: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``rank`` by ranges of (score, id, row key): a sort within each and the sizes of those before."""
    order = [F.col("score").desc(), F.col("_place"), F.col("_key")]
    spread = drawn.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a partition, and of a row in it, written so that they stay.
    placed = scratch.save(spread.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition.
    offsets = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    within = F.col("_at") - F.shiftleft(F.col("_part"), 33)
    return placed.withColumn("_part", part).join(offsets, "_part").withColumn("rank", F.col("_before") + within + 1)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = 10,
    min_words: int = 20,
    ngrams: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """Draw ``percent`` % of the documents with at least ``min_words`` words, without replacement.

    A document's weight is the sum, over its runs of 1 to ``ngrams`` words, of the log ratio
    of their bucket's share in ``target`` to that in ``docs``; its score adds Gumbel noise that
    depends on its id and the seed. The highest scores are drawn, ties to smaller ids. Returns
    per row: id, n_features, weight, score, rank (NULL if not drawn), all long.

    A NULL or empty text has no features and weight 0; texts are read whole; a NULL id comes
    after all others among ties and has the noise of an empty one; rows with the same id
    have the same noise and each its own rank, in no particular order if alike; other columns are ignored. An empty
    table gives an empty one, an empty target the smoothed shares of nothing.

    Two passes over the texts, in which a task holds arrays of ``buckets`` numbers. Ids and
    scores are written once; the cutoff is found by counting jobs over them, and only drawn
    rows are dealt to ranges of (score, id), so a hot score or id is cut like any other.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "resample")
    counts, wanted = (
        scratch.save(bucket_counts(table, text, buckets, ngrams), name)
        for table, text, name in ((docs, text_col, "counts"), (target, target_text_col, "target"))
    )
    gains = bucket_gains(counts, wanted, buckets)
    texts = docs.select(F.col(text_col).cast("string").alias("_body"), F.col(id_col).cast("long").alias("_id"))
    weighed = texts.mapInArrow(_score(gains, ngrams), "_id long, _words long, n_features long, weight long")
    scores = scratch.save(
        weighed.withColumn("score", F.col("weight") + _noise(F.col("_id"), seed))
        .withColumn("_place", F.coalesce("_id", F.lit(_LAST_ID)))
        .withColumn("_key", F.monotonically_increasing_id()),
        "scores",
    )
    enough = F.col("_words") >= min_words
    eligible = scores.filter(enough)
    first = enough & _first_n(eligible, percent * eligible.count() // 100)
    columns = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    drawn = _ranked(scores.filter(first), scratch).select(*columns, "rank")
    return drawn.unionByName(scores.filter(~first).select(*columns, F.lit(None).cast("long").alias("rank")))
