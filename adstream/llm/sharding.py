"""Sharding by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch

MAX_BYTES = 16 * 1024 * 1024
_BITS = 64
_BITS_PER_ROUND = 4
_ROW = "_shard_row"


def _prefix(depth: Column) -> Column:
    """The first ``depth`` bits of the hash, as a string: a bucket's place in the directory."""
    return F.substring("bits", F.lit(1), depth)


def assign_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bytes: int = MAX_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, shard (its hash prefix), depth, shard_bytes, shard_docs.

    The directory starts as one bucket and only buckets above ``max_bytes`` split on
    another bit of the id's hash, until every shard fits. A row larger than the limit
    is a shard of its own size, as it can't be split. The hash is of the id and, for
    rows that share an id, of the text's; exact repeats of a row go on with bits of
    their place in the written table, so even they are split. A NULL id hashes like a
    value of its own, a NULL or empty text has no bytes; other columns are ignored
    but for those in ``keep``, which follow at the end; an empty table has no shards. Splitting works on sums per prefix, some bits at a
    time, so a row's text moves nowhere and the driver sees a count only.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def bits(value: Column) -> Column:
        return F.lpad(F.conv(F.hex(value), 16, 2), _BITS, "0")

    rows = docs.select(
        F.col(id_col).alias("row_key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.concat(
            bits(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col(id_col).isNull())),
            bits(F.xxhash64(text)),
            bits(F.xxhash64(F.monotonically_increasing_id())),
        ).alias("bits"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    rows = scratch.save(rows, "rows")
    open_rows, done, depth = rows, None, 0
    while True:
        # Sums for the next few depths at once; a bucket closes at the first depth where it fits.
        last = min(depth + _BITS_PER_ROUND, 3 * _BITS)
        deepest = open_rows.groupBy(_prefix(F.lit(last)).alias("prefix")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_docs")
        )
        deepest = scratch.save(deepest, f"sums-{depth}")
        levels = F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("depth")
        sums = deepest.select(levels, "prefix", "n_bytes", "n_docs")
        sums = sums.groupBy("depth", F.substring("prefix", F.lit(1), F.col("depth")).alias("shard")).agg(
            F.sum("n_bytes").alias("shard_bytes"), F.sum("n_docs").alias("shard_docs")
        )
        fits = (F.col("shard_bytes") <= max_bytes) | (F.col("shard_docs") == 1) | (F.col("depth") == 3 * _BITS)
        fitting = sums.filter(fits)
        # The shallowest fitting prefix of every deepest one.
        tails = deepest.select("prefix", levels).withColumn("shard", F.substring("prefix", F.lit(1), F.col("depth")))
        chosen = (
            tails.join(fitting, ["depth", "shard"])
            .groupBy("prefix")
            .agg(F.min_by(F.struct("shard", "depth", "shard_bytes", "shard_docs"), "depth").alias("s"))
            .select("prefix", "s.*")
        )
        chosen = scratch.save(chosen, f"shards-{depth}")
        placed = open_rows.join(chosen, _prefix(F.lit(last)) == F.col("prefix"), "left")
        placed = scratch.save(placed.drop("prefix"), f"placed-{depth}")
        closed = placed.filter("shard IS NOT NULL")
        done = closed if done is None else done.unionByName(closed)
        open_rows = placed.filter("shard IS NULL").select(rows.columns)
        depth = last
        if open_rows.isEmpty():
            break
    return done.select(
        F.col("row_key").alias(id_col),
        "n_bytes",
        "shard",
        "depth",
        "shard_bytes",
        "shard_docs",
        *[F.col(f"kept_{c}").alias(c) for c in keep],
    )


def write_shards(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_bytes: int = MAX_BYTES
) -> None:
    """Assign the rows of ``docs`` to shards and write every shard to a directory of its own below ``path``.

    Each row is written once, rows that share an id or repeat each other too: rows are
    numbered in a written copy of ``docs`` and meet their shards by that number.
    Names of shards are bits: read them with ``spark.sql.sources.partitionColumnTypeInference.enabled`` off.
    """
    if clash := {"shard", _ROW}.intersection(docs.columns):
        raise ValueError(f"columns that the shards need themselves: {sorted(clash)}")
    scratch = Scratch(docs.sparkSession, "shard-files")
    rows = scratch.save(docs.withColumn(_ROW, F.monotonically_increasing_id()), "rows")
    place = assign_shards(rows, id_col, text_col, max_bytes, keep=(_ROW,)).select(_ROW, "shard")
    placed = rows.join(place, _ROW).drop(_ROW)
    placed.repartition("shard").write.partitionBy("shard").mode("overwrite").parquet(path)
    scratch.drop("rows")
