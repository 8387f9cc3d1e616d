"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.arrays import scan
from adstream.llm.scratch import Scratch
from adstream.llm.text import word_count

_ROWS_PER_CELL = 20_000
_MAX_STEPS = 60


def _targets(totals: DataFrame, cap: int) -> DataFrame:
    """Targets of (source, source_size): shares by weight, held at ``cap`` times a source's size.

    Sources weigh 1, 2, 3 and again in code point order, NULL last. The share that the
    held sources cannot take goes to the others by weight. Ordered by size per weight,
    the sources held are the first ones, so one pass over running sums finds them; there
    is one row per source here, not per document.
    """
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    by_need = Window.orderBy("per_weight", F.col("source").isNull(), "source")
    weighed = totals.withColumn("weight", (F.row_number().over(in_order) - 1) % 3 + 1)
    weighed = weighed.withColumn("per_weight", F.col("source_size") / F.col("weight"))
    whole = Window.partitionBy()
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(0, Window.unboundedFollowing)
    held_before = F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = (F.sum("source_size").over(whole) - cap * held_before) / F.sum("weight").over(after)
    levels = weighed.withColumn("level", level)
    held = F.col("level") >= cap * F.col("per_weight")
    final = F.max(F.when(~held, F.col("level"))).over(whole)
    target = F.when(held, F.lit(float(cap)) * F.col("source_size")).otherwise(
        F.col("weight") * F.coalesce(final, F.lit(0.0))
    )
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def _rate(cap: int) -> Column:
    """A document's rate: tilted by its size against its source's mean, at most ``cap``."""
    return F.when(F.col("size") == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    )


def _solve(cells: DataFrame, targets: DataFrame, cap: int, scratch: Scratch) -> DataFrame:
    """(source, tilt): safeguarded Newton steps on the dual, all sources at once.

    A source's dual is convex in its one multiplier; its gradient is the tokens taken
    less the target, its curvature the size-weighted tokens of documents below the
    cap. Each step is an aggregate over (source, size) cells, so documents of a hot
    source are added up before anything moves. A step leaving the bracket bisects it.
    """
    mean = cells.groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size")) / F.sum(F.when(F.col("size") > 0, F.col("n")))).alias("mean")
    )
    state = targets.join(mean, targets["source"].eqNullSafe(mean["source"])).drop(mean["source"])
    state = state.filter("source_size > 0").withColumns(
        {"tilt": F.lit(0.0), "low": F.lit(-1e6), "high": F.lit(1e6), "gap": F.lit(float("inf"))}
    )
    state = scratch.save(state, "tilt-0")
    for step in range(1, _MAX_STEPS + 1):
        of = state.withColumnRenamed("source", "of")
        rate, x = _rate(cap), F.col("size") / F.col("mean")
        taken = (
            cells.join(of, F.col("source").eqNullSafe(F.col("of")))
            .groupBy("of", "target", "source_size", "mean", "tilt", "low", "high")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("tokens"),
                F.sum(F.when(rate < cap, F.col("n") * F.col("size") * rate * x).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("tokens") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        bounded = taken.select("*", gap.alias("gap"), low.alias("l"), high.alias("h"))
        newton = F.col("tilt") - F.try_divide("gap", "slope")
        middle = F.when(F.col("l") < -1e5, F.col("h") * 2 - 1).when(F.col("h") > 1e5, F.col("l") * 2 + 1)
        middle = middle.otherwise((F.col("l") + F.col("h")) / 2)
        inside = (F.col("slope") > 0) & (newton > F.col("l")) & (newton < F.col("h"))
        inside = inside & (F.abs(newton - F.col("tilt")) < 8)
        done = F.abs(F.col("gap")) <= 1e-6 * F.col("target") + 1e-6
        following = F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle)
        next_state = bounded.select(
            F.col("of").alias("source"),
            "source_size",
            "target",
            "mean",
            following.alias("tilt"),
            F.col("l").alias("low"),
            F.col("h").alias("high"),
            F.when(done, F.lit(0.0)).otherwise(F.abs("gap") / F.greatest("target", F.lit(1e-9))).alias("gap"),
        )
        state = scratch.save(next_state, f"tilt-{step}")
        scratch.drop(f"tilt-{step - 1}")
        if state.filter("gap > 1e-6").isEmpty():
            break
    return state.select("source", "mean", "tilt")


def _copies_per_cell(cells: DataFrame, tilts: DataFrame, cap: int) -> DataFrame:
    """(source, size, n, copies): rates rounded to whole copies, largest sizes first.

    What a cell's whole copies leave over is carried to the next smaller size, so a
    source misses its target by less than its smallest documents. One array per
    source holds its distinct sizes, whatever the number of documents.
    """
    rated = cells.join(tilts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    rated = rated.filter("size > 0").select("source", "size", "n", _rate(cap).alias("rate"))
    listed = rated.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("size", "n", "rate")), asc=False).alias("cells")
    )

    def due(carry: Column, cell: Column) -> Column:
        return carry + cell["n"] * cell["rate"] * cell["size"]

    def copies(carry: Column, cell: Column) -> Column:
        whole = F.least(cell["n"] * cap, F.floor(due(carry, cell) / cell["size"] + 1e-9).cast("long"))
        return F.greatest(whole, F.lit(0).cast("long"))

    filled = scan(
        F.col("cells"),
        F.lit(0.0),
        lambda carry, cell: due(carry, cell) - copies(carry, cell) * cell["size"],
        lambda carry, cell: F.struct(
            cell["size"].alias("size"), cell["n"].alias("n"), copies(carry, cell).alias("copies")
        ),
        "struct<size: bigint, n: bigint, copies: bigint>",
    )
    return listed.select("source", F.inline(filled))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cap: int = 3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How many whole copies of every document the mix takes.

    Returns id, size (words), source_size, target (words, of the source), copies and
    taken = copies * size, with the columns named in ``keep`` beside them. Rates solve
    the entropy-balancing problem: as near to one copy each as the token targets allow, so a document's
    rate is an exponential of its size, bounded by ``cap``. Copies are that rate,
    rounded so that each source meets its target. A document's place among those of
    its source and size comes from a hash of its id, so reruns agree.

    A NULL source is a source, the last. NULL or empty texts have size 0 and no
    copies. Repeated rows count each; which of equal rows gets a copy more is of no
    consequence. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    rows = docs.select(
        F.col(id_col).alias("row_key"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    sized = scratch.save(rows, "sizes")
    cells = scratch.save(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = scratch.save(_targets(totals, cap), "targets")
    tilts = _solve(cells, targets, cap, scratch)
    quotas = scratch.save(_copies_per_cell(cells, tilts, cap), "quotas")

    quota = quotas.select(
        F.col("source").alias("of"), F.col("size").alias("of_size"), "n", "copies"
    )
    same_cell = F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size"))
    dealt = sized.join(quota, same_cell, "left").drop("of", "of_size")
    parts = F.ceil(F.coalesce("n", F.lit(1)) / _ROWS_PER_CELL)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row_key"), parts).cast("int"))
    counts = dealt.filter("copies IS NOT NULL").groupBy("source", "size", "n", "copies", "part").agg(
        F.count("*").alias("here")
    )
    up_to = F.sum("here").over(Window.partitionBy("source", "size").orderBy("part"))
    share = F.expr("(copies % n * up_to) div n - (copies % n * (up_to - here)) div n")
    shares = counts.withColumn("up_to", up_to).select(
        F.col("source").alias("of"), F.col("size").alias("of_size"), F.col("part").alias("of_part"), share.alias("extra")
    )
    same_part = same_cell & (F.col("part") == F.col("of_part"))
    place = F.row_number().over(
        Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("row_key"), "row_key")
    )
    ranked = dealt.withColumn("place", place).join(shares, same_part, "left").drop("of", "of_size", "of_part")
    one_more = (F.col("place") <= F.coalesce("extra", F.lit(0))).cast("long")
    copies = F.coalesce(F.expr("copies div n"), F.lit(0)) + F.when(F.col("copies").isNull(), 0).otherwise(one_more)
    of_source = targets.withColumnRenamed("source", "of")
    return (
        ranked.withColumn("copies", copies.cast("long"))
        .join(of_source, F.col("source").eqNullSafe(F.col("of")), "left")
        .select(
            F.col("row_key").alias(id_col),
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            *[F.col(f"kept_{c}").alias(c) for c in keep],
        )
    )
