"""Conversions without a click: the orphan rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adstream.config import FraudRules, LookupLimits
from adstream.functions.eventtime import day_number, duration, with_window_start
from adstream.operators.lookups import cells_of_heavy, place_in_cells, repeat_in_cells
from adstream.schemas import SILVER_CONVERSION
from adstream.session import scratch_path

_COPIES_PER_STEP = 10_000


def flag_orphans(
    conversions: DataFrame,
    clicks: DataFrame,
    rules: FraudRules = FraudRules(),
    prior_only: bool = False,
    per_click: bool = True,
) -> DataFrame:
    """Flag conversions whose click id belongs to no click close enough in time.

    Both bounds are inclusive; with ``prior_only`` the click must not come later.
    A conversion without a click id or a time is an orphan. If a click id is
    repeated, a conversion is repeated for each click that matches it; with
    ``per_click=False`` it comes out once, on tables without forming pairs.
    Two streams must both carry a watermark on ``timestamp``.
    """
    if conversions.isStreaming or clicks.isStreaming:
        joined = _join_streams(conversions, clicks, rules, prior_only, per_click)
    elif per_click:
        joined = _join_clicks(conversions, clicks, rules.tolerance, prior_only)
    else:
        left, reach, same, found = _with_reach(conversions, clicks, rules, prior_only)
        joined = left.join(reach, same, "left").withColumn("_found", found)
    orphan = ~F.coalesce(F.col("_found"), F.lit(False))
    return joined.withColumns({"is_orphan_conversion": orphan, "is_fraud": orphan}).select(
        SILVER_CONVERSION.fieldNames()
    )


def orphan_conversions(
    conversions: DataFrame,
    clicks: DataFrame,
    rules: FraudRules = FraudRules(),
    prior_only: bool = False,
) -> DataFrame:
    """Only the orphans, as an anti-join of tables; columns stay as they are."""
    left, reach, same, found = _with_reach(conversions, clicks, rules, prior_only)
    return left.join(reach, same & found, "left_anti").select(conversions.columns)


def _in_reach(click: Column, conversion: Column, tolerance: str, prior_only: bool) -> Column:
    latest = conversion if prior_only else conversion + duration(tolerance)
    return (click >= conversion - duration(tolerance)) & (click <= latest)


def _row_hash() -> Column:
    """Spreads rows, copies of one event included, alike in every attempt of a task."""
    return F.xxhash64("event_id", F.spark_partition_id())


def _unmatchable() -> Column:
    """Conversions that can have no click; where a shuffle sends them is free."""
    return F.col("click_id").isNull() | F.col("timestamp").isNull()


def _join_streams(
    conversions: DataFrame, clicks: DataFrame, rules: FraudRules, prior_only: bool, per_click: bool
) -> DataFrame:
    """Outer join whose state the watermarks and the time range keep bounded.

    Once per conversion, those with a click are a semi-join, which lets a conversion out, and out
    of its state, at its first click; those without are what an outer join finds no click for.

    A much-used click id is spread over ``orphan_salts`` cells of the state; the
    narrow click rows are repeated for each cell. Rows without an id or a time would
    stay in the state for ever: such clicks are left out, and such conversions are
    orphans at once.
    """
    salts = rules.orphan_salts
    left = conversions.filter(~_unmatchable()).withColumn("_cell", F.pmod(_row_hash(), F.lit(salts)))
    right = clicks.filter(F.col("event_id").isNotNull() & F.col("timestamp").isNotNull()).select(
        F.col("event_id").alias("_click"),
        F.col("timestamp").alias("_click_time"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("_click_cell"),
        F.lit(True).alias("_found"),
    )
    same = (F.col("click_id") == F.col("_click")) & (F.col("_cell") == F.col("_click_cell"))
    near = _in_reach(F.col("_click_time"), F.col("timestamp"), rules.tolerance, prior_only)
    joined = left.join(right, same & near, "left").select(*conversions.columns, "_found")
    if not per_click:
        with_click = left.join(right, same & near, "left_semi").withColumn("_found", F.lit(True))
        joined = joined.filter("_found IS NULL").unionByName(with_click.select(*conversions.columns, "_found"))
    alone = conversions.filter(_unmatchable()).withColumn("_found", F.lit(False))
    return joined.unionByName(alone)


def _join_clicks(
    conversions: DataFrame, clicks: DataFrame, tolerance: str, prior_only: bool
) -> DataFrame:
    """Outer join of tables on id and day, with the copies of a click folded into one.

    A click counts for each day within its reach: few are that near to midnight, so
    few are doubled, while an id found all over the table is split by day. What is
    left of a dominant click id on the conversion side is split by adaptive execution.
    """
    time, time_type = F.col("timestamp"), clicks.schema["timestamp"].dataType
    right = (
        clicks.filter(F.col("event_id").isNotNull() & time.isNotNull())
        .groupBy(F.col("event_id").alias("_click"), time.alias("_click_time"))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_first", day_number(F.col("_click_time") - duration(tolerance), time_type))
        .withColumn("_last", day_number(F.col("_click_time") + duration(tolerance), time_type))
        .withColumn("_click_day", F.explode(F.sequence("_first", "_last")))
        .select("_click", "_click_time", "_copies", "_click_day")
    )
    day = day_number(time, conversions.schema["timestamp"].dataType)
    any_day = F.pmod(_row_hash(), F.lit(2**31 - 1)).cast("int")
    left = conversions.withColumn("_day", F.when(_unmatchable(), any_day).otherwise(day))
    same = (F.col("click_id") == F.col("_click")) & (F.col("_day") == F.col("_click_day"))
    near = _in_reach(F.col("_click_time"), time, tolerance, prior_only)
    joined = left.join(right, same & near, "left")
    return _repeat(joined.withColumn("_found", F.col("_copies").isNotNull()), "_copies")


def _repeat(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as the column says (once if NULL), without long arrays."""
    last_step = F.expr(f"(coalesce({times}, 1) - 1) div {_COPIES_PER_STEP}")
    left_over = F.coalesce(F.col(times), F.lit(1)) - F.col("_step") * _COPIES_PER_STEP
    in_step = F.least(F.lit(_COPIES_PER_STEP), left_over)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    steps = rows.withColumn("_step", F.explode(F.sequence(zero, last_step)))
    return steps.withColumn("_copy", F.explode(F.sequence(one, in_step)))


def _with_reach(
    conversions: DataFrame, clicks: DataFrame, rules: FraudRules, prior_only: bool
) -> tuple[DataFrame, DataFrame, Column, Column]:
    """Both sides of a join with at most one partner per conversion, its keys and its test.

    A conversion is matched by a click from ``earliest`` to ``latest``. Time is cut
    into windows of just that length, so these two are in one window or in the next.
    Of the clicks in the first window only the last one can decide, of those in the
    second only the first one. So two times per id and window tell all, and they
    are aggregates that combine before the shuffle.
    """
    time, own, start = F.col("timestamp"), F.col("_own"), F.col("_start")
    tolerance = rules.tolerance
    windows = tolerance if prior_only else f"{tolerance} {tolerance}"
    width = duration(windows)
    known = clicks.filter(F.col("event_id").isNotNull() & time.isNotNull()).select("event_id", "timestamp")
    reach = (
        with_window_start(known, "_own", windows)
        .withColumn("_start", F.explode(F.array(own, own - width)))
        .groupBy(F.col("event_id").alias("_click"), start.alias("_click_start"))
        .agg(
            F.max(F.when(own == start, time)).alias("_last"),
            F.min(F.when(own > start, time)).alias("_first"),
        )
    )
    earliest = time - duration(tolerance)
    latest = time if prior_only else time + duration(tolerance)
    time_type = conversions.schema["timestamp"].dataType
    anywhere = F.timestamp_seconds(F.pmod(_row_hash(), F.lit(2**31))).cast(time_type)
    left = with_window_start(
        conversions.withColumn("_earliest", earliest), "_start", windows, time="_earliest"
    ).withColumn("_start", F.when(_unmatchable(), anywhere).otherwise(start))
    left, reach, same = _spread_heavy(conversions, left, reach, rules.limits)
    same = same & (F.col("click_id") == F.col("_click")) & (start == F.col("_click_start"))
    found = (F.col("_last") >= earliest) | (F.col("_first") <= latest)
    return left, reach, same, found


def _spread_heavy(
    conversions: DataFrame, left: DataFrame, reach: DataFrame, limits: LookupLimits
) -> tuple[DataFrame, DataFrame, Column]:
    """Split the conversions of a much-used click id over cells, as a part of the join key.

    The uses are counted once, by a hash of the id, and written. Where no id has
    ``heavy_rows`` of them, which is usual, nothing is added to the join. Otherwise at most
    ``max_rows`` hashes are broadcast, and only the few windows of those ids are repeated.
    """
    spark, sizes = conversions.sparkSession, Observation()
    uses = (
        conversions.filter(~_unmatchable())
        .groupBy(F.xxhash64("click_id").alias("key_hash"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") >= limits.heavy_rows)
    )
    workspace = scratch_path(spark, "click-uses")
    uses.observe(sizes, F.sum("n_rows").alias("covered")).write.parquet(workspace)
    covered = sizes.get["covered"] or 0
    if not covered:
        return left, reach, F.lit(True)
    heavy = cells_of_heavy(spark.read.schema(uses.schema).parquet(workspace), covered, limits)
    left = place_in_cells(left, F.xxhash64("click_id"), heavy, F.lit(False))
    reach = repeat_in_cells(reach, F.xxhash64("_click"), heavy, "_click_cell")
    return left, reach, F.col("_cell") == F.col("_click_cell")
