"""Packing tokenised documents into sequences: best-two-fit."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.bpe import Encoder, public_tokenizer
from adstream.llm.scratch import Scratch
from adstream.llm.shingles import texts
from adstream.llm.workercache import worker_cached

PIECES_PER_GROUP = 100_000


def _pieces(path: str | None, capacity: int, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or public_tokenizer()
        encoder = worker_cached(("encoder", file), lambda: Encoder(file))
        end, step = array("I", [end_id]).tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for row_key, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                ids = encoder.ids(text or b"") + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((row_key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, types)],
                names=["row_key", "piece", "start", "length", "ids_crc32"],
            )

    return run


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item; lengths are 1 to ``capacity``.

    A bin takes the longest item left and then, again and again, the longest that
    fits. If room is left, its smallest item is exchanged for the two unpacked items
    whose sum comes closest to that item and the room together, if they fill more.
    """
    left = np.bincount(lengths, minlength=capacity + 1)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in np.argsort(lengths, kind="stable")[::-1].tolist():
        stacks[lengths[i]].append(i)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    largest = capacity
    number, todo = 0, len(lengths)

    def longest(limit: int) -> int:
        """The longest length left of at most ``limit``; 0 if none."""
        at = np.flatnonzero(left[1 : limit + 1])
        return int(at[-1]) + 1 if len(at) else 0

    while todo:
        while not left[largest]:
            largest -= 1
        packed, room = [largest], capacity - largest
        left[largest] -= 1
        while room and (take := longest(room)):
            packed.append(take)
            left[take] -= 1
            room -= take
        if room and len(packed) > 1:
            smallest = packed[-1]
            lengths_left = np.flatnonzero(left)
            if pair := _best_pair(left, lengths_left, room + smallest, smallest):
                packed.pop()
                left[smallest] += 1
                for take in pair:
                    packed.append(take)
                    left[take] -= 1
        at = 0
        for take in packed:
            item = stacks[take].pop()
            bins[item], offsets[item] = number, at
            at += take
        todo -= len(packed)
        number += 1
    return bins, offsets


def _best_pair(left: np.ndarray, lengths: np.ndarray, gap: int, beyond: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum of at most ``gap`` that is above ``beyond``."""
    small = lengths[lengths < gap]
    if not len(small):
        return None
    at = np.searchsorted(small, gap - small, side="right") - 1
    fits = at >= 0
    first, second = small[fits], small[at[fits]]
    alone = (first == second) & (left[first] < 2)
    before = np.maximum(at[fits] - 1, 0)
    second = np.where(alone, np.where(at[fits] > 0, small[before], 0), second)
    total = np.where(second > 0, first + second, 0)
    if not len(total) or total.max() <= beyond:
        return None
    best = int(np.argmax(total))
    return int(first[best]), int(second[best])


def _pack(capacity: int) -> Callable:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row_key", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = best_two_fit(group["length"].to_numpy(), capacity)
        base = np.int64(group["pack"].iloc[0]) << 32
        return group.drop(columns="pack").assign(sequence_id=base + bins, offset=offsets)

    return run


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    tokenizer_path: str | None = None,
    pieces_per_group: int = PIECES_PER_GROUP,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.
    Only a document longer than a sequence is cut, into full pieces and a last one.
    Special tokens written in a text are special tokens, as the tokenizer reads them. A NULL or empty text is its end id alone; repeated rows and rows with a NULL id are packed
    each for itself; other columns are ignored; an empty table gives no sequences.
    The tokenizer file (default: the public one) must be on every executor.

    Tokens are made once, in Arrow batches; only lengths and checksums travel on.
    Full pieces are sequences already. The others are dealt at random into groups of
    bounded size, each packed by best-two-fit, so no task sees all pieces and a group
    wastes one sequence at most more than one packing of everything.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "row_key long, piece int, start long, length long, ids_crc32 long"
    pieces = scratch.save(rows.mapInArrow(_pieces(tokenizer_path, capacity, end_id), schema), "pieces")
    loose = pieces.filter(F.col("length") < capacity)
    groups = loose.count() // pieces_per_group + 1
    deal = F.pmod(F.xxhash64("row_key", "piece", F.monotonically_increasing_id()), F.lit(groups))
    packed = (
        loose.withColumn("pack", deal)
        .groupBy("pack")
        .applyInPandas(_pack(capacity), f"{schema}, sequence_id long, offset long")
    )
    full = pieces.filter(F.col("length") == capacity).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full).withColumnRenamed("row_key", id_col)
