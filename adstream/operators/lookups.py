"""Marking rows whose key belongs to a flagged group.

A rule such as "more than 50 clicks of one user" is an aggregate whose verdict has
to reach every row of the group. Joining the full aggregate back would shuffle the
whole table and put a dominant key into one task. Here only the flagged groups
travel, and how they travel depends on their measured number.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adstream.config import LookupLimits
from adstream.session import scratch_path


@dataclass(frozen=True)
class Grouping:
    """Verdicts per group: the key columns, ``n_rows`` and the boolean ``flagged``."""

    name: str
    keys: tuple[str, ...]
    verdicts: DataFrame


def _keys_present(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _key_bytes(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, [F.octet_length(F.col(k).cast("string")) for k in keys])


def mark_rows(
    rows: DataFrame, groupings: list[Grouping], limits: LookupLimits, workspace: str | None = None
) -> DataFrame:
    """Add one boolean column per grouping, named after it.

    The flag is NULL when a key is NULL, TRUE when the row's group is flagged and
    FALSE otherwise. The small remainder of each grouping that matters, flagged or
    very big groups, is computed once, all groupings in one job, and written to the
    ``workspace``, by default a new folder below the session's checkpoint folder. A
    session that has none must be given one.
    """
    spark = rows.sparkSession
    relevant = [
        g.verdicts.filter(_keys_present(g.keys))
        .filter(F.col("flagged") | (F.col("n_rows") >= limits.heavy_rows))
        .select(
            F.lit(g.name).alias("grouping"),
            F.struct(*g.keys).alias("key"),
            _key_bytes(g.keys).alias("key_bytes"),
            "n_rows",
            "flagged",
        )
        for g in groupings
    ]
    by_name = {g.name: part.withColumnRenamed("key", f"key_{g.name}") for g, part in zip(groupings, relevant)}
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), by_name.values())
    sizes = Observation()
    totals = []
    for g in groupings:
        mine = F.col("flagged") & (F.col("grouping") == g.name)
        totals.append(F.count_if(mine).alias(f"rows_{g.name}"))
        totals.append(F.sum(F.when(mine, F.col("key_bytes"))).alias(f"bytes_{g.name}"))
        totals.append(F.sum(F.when(F.col("grouping") == g.name, F.col("n_rows"))).alias(f"covered_{g.name}"))
    workspace = workspace or scratch_path(spark, "verdicts")
    together.observe(sizes, *totals).write.mode("overwrite").parquet(workspace)
    measured = spark.read.schema(together.schema).parquet(workspace)
    size_of = sizes.get

    for g in groupings:
        found = measured.filter(F.col("grouping") == g.name).withColumnRenamed(f"key_{g.name}", "key")
        n_rows, n_bytes = size_of[f"rows_{g.name}"], size_of[f"bytes_{g.name}"] or 0
        if n_rows <= limits.max_rows and n_bytes <= limits.max_bytes:
            rows = _mark_by_broadcast(rows, g, found)
        else:
            rows = _mark_by_shuffle(rows, g, found, limits, size_of[f"covered_{g.name}"] or 0)
    return rows


def _verdict(grouping: Grouping, *hits: Column) -> Column:
    return F.when(_keys_present(grouping.keys), F.coalesce(*hits, F.lit(False)))


def _matches(rows: DataFrame, keys: tuple[str, ...], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"{prefix}{k}") for k in keys])


def _mark_by_broadcast(rows: DataFrame, grouping: Grouping, found: DataFrame) -> DataFrame:
    """The flagged groups fit: no row of the table moves."""
    flagged = found.filter("flagged").select(
        *[F.col("key")[k].alias(f"_hit_{k}") for k in grouping.keys], F.lit(True).alias("_hit")
    )
    joined = rows.join(F.broadcast(flagged), _matches(rows, grouping.keys, "_hit_"), "left")
    return joined.withColumn(grouping.name, _verdict(grouping, F.col("_hit"))).select(
        *rows.columns, grouping.name
    )


def row_spread(rows: DataFrame) -> Column:
    """A number per row that spreads rows, copies in different tasks included, alike in every attempt."""
    hashable = [F.col(name) for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*hashable, F.spark_partition_id())


def cells_of_heavy(groups: DataFrame, covered: int, limits: LookupLimits) -> DataFrame:
    """(_heavy, _cells) for the key hashes of the groups that are split, from ``key_hash`` and ``n_rows``.

    ``covered`` is the sum of ``n_rows``, so at most ``max_rows`` groups have the share asked
    for: a bound without a sort. Hashes may collide, as they only mark rows to spread.
    """
    per_cell = max(1, limits.heavy_rows // 4)
    least = max(per_cell + 1, -(-covered // limits.max_rows))
    heavy = groups.groupBy(F.col("key_hash").alias("_heavy")).agg(F.max("n_rows").alias("n"))
    return heavy.filter(F.col("n") >= least).select("_heavy", F.ceil(F.col("n") / per_cell).alias("_cells"))


def place_in_cells(rows: DataFrame, key_hash: Column, heavy: DataFrame, free: Column) -> DataFrame:
    """Add ``_cell``: a place in the cells of the row's key, or any place where ``free``."""
    spread = row_spread(rows)
    cell = F.when(free, spread).when(F.col("_cells").isNotNull(), F.pmod(spread, F.col("_cells")))
    placed = rows.join(F.broadcast(heavy), key_hash == F.col("_heavy"), "left")
    return placed.withColumn("_cell", F.coalesce(cell, F.lit(0).cast("long"))).drop("_heavy", "_cells")


def repeat_in_cells(rows: DataFrame, key_hash: Column, heavy: DataFrame, name: str) -> DataFrame:
    """Each row once per cell of its key, the cell's number in a column ``name``."""
    zero = F.lit(0).cast("long")
    last = F.coalesce(F.col("_cells"), F.lit(1).cast("long")) - 1
    repeated = rows.join(F.broadcast(heavy), key_hash == F.col("_heavy"), "left")
    return repeated.withColumn(name, F.explode(F.sequence(zero, last))).drop("_heavy", "_cells")


def _mark_by_shuffle(
    rows: DataFrame, grouping: Grouping, found: DataFrame, limits: LookupLimits, covered: int
) -> DataFrame:
    """Too many flagged groups to broadcast.

    The rows of the biggest groups are marked by a hash of their key, whatever its
    length, and spread over cells that are part of the join key; if such a group is flagged,
    it is repeated per cell. Rows without a key take part in the shuffle anywhere.
    """
    of_key = F.xxhash64(*[F.col("key")[k] for k in grouping.keys])
    heavy = cells_of_heavy(found.select(of_key.alias("key_hash"), "n_rows"), covered, limits)
    flagged = found.filter("flagged").select(
        *[F.col("key")[k].alias(f"_other_{k}") for k in grouping.keys], F.lit(True).alias("_other")
    )
    flagged_hash = F.xxhash64(*[F.col(f"_other_{k}") for k in grouping.keys])
    others = repeat_in_cells(flagged, flagged_hash, heavy, "_other_cell")
    placed = place_in_cells(rows, F.xxhash64(*grouping.keys), heavy, ~_keys_present(grouping.keys))
    same = _matches(rows, grouping.keys, "_other_") & (F.col("_cell") == F.col("_other_cell"))
    joined = placed.join(others, same, "left")
    return joined.withColumn(grouping.name, _verdict(grouping, F.col("_other"))).select(*rows.columns, grouping.name)
