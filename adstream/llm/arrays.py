"""Column expressions over arrays whose work grows with the array's length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 256


def let(value: Column, body) -> Column:
    """``body`` of a value that is made once, however often a lambda inside refers to it."""
    return F.get(F.transform(F.array(value), body), 0)


def scan(items: Column, start: Column, step, emit, kind: str) -> Column:
    """What ``emit`` makes of each item and of the state before it, which ``step`` moves on.

    Arrays grow within blocks only, as each addition copies them, so the work grows with
    the number of items and not with its square.
    """
    none, no_blocks = (F.from_json(F.lit("[]"), t) for t in (f"array<{kind}>", f"array<array<{kind}>>"))

    def one(state: Column, item: Column) -> Column:
        return F.struct(
            step(state["at"], item).alias("at"), F.concat(state["out"], F.array(emit(state["at"], item))).alias("out")
        )

    def block(state: Column, some: Column) -> Column:
        done = F.aggregate(some, F.struct(state["at"].alias("at"), none.alias("out")), one)
        return let(
            done, lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out"))
        )

    def blocks(every: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / _BLOCK).cast("int"))
        cut = F.transform(numbers, lambda b: F.slice(every, b * _BLOCK + 1, F.lit(_BLOCK)))
        return F.when(F.size(every) > 0, cut).otherwise(F.slice(F.array(every), 1, 0))

    first = F.struct(start.alias("at"), no_blocks.alias("out"))
    return F.flatten(F.aggregate(let(items, blocks), first, block)["out"])
