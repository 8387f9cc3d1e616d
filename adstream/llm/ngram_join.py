"""Near duplicates by word shingles: an exact Jaccard join with count-vector R-trees.

How the join scales. A tree over all sets would send every query nearly everywhere,
as sets of one size that share nothing have much the same group counts. So trees are
grown per *cell*. Two sets with Jaccard >= p% share a shingle among their first
``size - ceil(p% size) + 1`` in any order common to all sets. The order used here is
rarest first by a sketch of the shingle counts of the whole corpus (fixed size, summed
in Spark), so that passages and lines of many documents come last. A cell is the sets
that share one such shingle; shingles with the same sets make one cell.

Inside a cell the R-tree bounds overlaps by summed minima of group counts. First it does
so on count vectors alone, and sets that have no partner left in a cell leave it. For the others, exact
intersections verify what the tree lets through. What comes out is which components
of a cell are one, as a star around the smallest, so a group of any size gives at most as
many rows as it has sets, and no long paths. Big cells are cut
into blocks: first rounds give each set one cell and block, which merges dense groups
cheaply; the last round takes every cell that still holds two components, where the
sets outside its main component meet all of its blocks. That makes the components exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.components import connected_components
from adstream.llm.rtree import CountVectorTree, cluster, count_vector
from adstream.llm.scratch import Scratch
from adstream.llm.shingles import shingle_sets, texts

GROUPS = 512
_FINE_GROUPS = 4096
_SKETCH_BITS = 22
_SKETCH_CHUNK = 1 << 12
_SHINGLES_PER_BLOCK = 1_000_000
_CELL_SETS = 4096
_MERGING_ROUNDS = 2
_BROADCAST_ROWS = 1_000_000


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _node(shingles: np.ndarray) -> int:
    """Identity of a set: equal sets are one node. 64 bits of hash over its 64-bit members."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), seed=len(shingles))).view(np.int64))


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each; their length tells which."""
    kind = next(k for k in ("u1", "<u2", "<u4", "<u8") if counts.max() < 256 ** np.dtype(k).itemsize)
    return counts.astype(kind).tobytes()


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // size}").astype(np.int64)


def _sketch_cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)


def _measure(width: int, groups: int) -> Callable:
    """Per row its set's node, size and count vector; at a task's end its part of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _SKETCH_BITS, np.int64)
        names = ["row_key", "n_shingles", "node", "point", "chunk", "counts"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        for batch in batches:
            sizes, nodes, points = [], [], []
            for s in shingle_sets(texts(batch.column(1)), width):
                sizes.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                points.append(_packed(count_vector(s, groups)) if len(s) else None)
                np.add.at(counts, _sketch_cells(s), 1)
            none = [None] * len(sizes)
            columns = [batch.column(0), sizes, nodes, points, none, none]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        for chunk, part in enumerate(counts.reshape(-1, _SKETCH_CHUNK)):
            if part.any():
                row = [[None], [None], [None], [None], [chunk], [_packed(part)]]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(row, types)], names=names)

    return run


def _add_parts(parts: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([_unpacked(c, _SKETCH_CHUNK) for c in parts["counts"]], axis=0)
    return pd.DataFrame({"chunk": [parts["chunk"].iloc[0]], "counts": [_packed(total)]})


def _rarest(shingles: np.ndarray, counts: np.ndarray, first: int) -> np.ndarray:
    """The ``first`` rarest of a sorted set of shingles, ties to smaller ones."""
    return shingles[np.argsort(counts[_sketch_cells(shingles)], kind="stable")[:first]]


def _prefixes(width: int, percent: int, blocks: int, sketch) -> Callable:
    """Each set's first shingles, rarest first, packed by block of the hash space.

    A shingle that several sets of one batch have is known to be shared: those sets
    are passed on as they are, under a block number of their own, and one of them
    stands for all in its block. So a shingle of a huge group fills no block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        for batch in batches:
            kept, owners = [], []
            for s in shingle_sets(texts(batch.column(0)), width):
                n = len(s)
                if not n or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                first = n + (-percent * n // 100) + 1
                kept.append(_rarest(s, counts, first))
                owners.append(np.full(len(kept[-1]), node, np.int64))
            if len(seen) > 1_000_000:
                seen.clear()
            if not kept:
                continue
            token, owner = np.concatenate(kept), np.concatenate(owners)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            new = np.r_[True, token[1:] != token[:-1]]
            again = ~new | np.r_[~new[1:], False]
            rows = [(-1 - int(xxhash.xxh32_intdigest(owner[:1].tobytes()) % 4096), token[again], owner[again], again[again])]
            token, owner, again = token[new], owner[new], again[new]
            block = (token % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                rows.append((int(block[part[0]]), token[part], owner[part], again[part]))
            rows = [r for r in rows if len(r[1])]
            yield pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([_signed(r[1]).tobytes() for r in rows], pa.binary()),
                    pa.array([r[2].tobytes() for r in rows], pa.binary()),
                    pa.array([np.packbits(r[3]).tobytes() for r in rows], pa.binary()),
                ],
                names=["block", "tokens", "nodes", "known"],
            )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node) of the shingles that several sets have; rows come block by block."""

    def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        token = np.frombuffer(row["tokens"], np.int64)
        known = np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(token)).astype(bool)
        return token, np.frombuffer(row["nodes"], np.int64), known

    def out(token: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(token), 100_000):
            parts = [pa.array(x[at : at + 100_000]) for x in (token, node)]
            yield pa.record_batch(parts, names=["token", "node"])

    def finish(parts: list) -> Iterator[pa.RecordBatch]:
        if parts:
            token, node, known = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((node, token))
            token, node, known = token[order], node[order], known[order]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            various = np.minimum.reduceat(node, starts) != np.maximum.reduceat(node, starts)
            shared = various | np.logical_or.reduceat(known, starts)
            keep = np.repeat(shared, np.diff(np.r_[starts, len(token)])) & ~known
            yield from out(token[keep], node[keep])

    parts, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            token, node, known = unpack(row)
            if row["block"] < 0:
                yield from out(token, node)
                continue
            if row["block"] != current:
                yield from finish(parts)
                parts, current = [], row["block"]
            parts.append((token, node, known))
    yield from finish(parts)


def _fine_points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count vectors with more groups, whose bound is nearly exact."""
    for batch in batches:
        sets = [np.frombuffer(s, np.uint64) for s in batch.column(1).to_pylist()]
        points = pa.array([_packed(count_vector(s, _FINE_GROUPS)) for s in sets], pa.binary())
        yield pa.record_batch([batch.column(0), points], names=["node", "point"])


def _sets(width: int) -> Callable:
    """Each set's node and shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(texts(batch.column(0)), width) if len(s)]
            data = [s.tobytes() for s in sets]
            columns = [pa.array([_node(s) for s in sets], pa.int64()), pa.array(data, pa.binary())]
            yield pa.record_batch(columns, names=["node", "shingles"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of every group of a stream sorted by its first columns, and the group's key."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:n_keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:n_keys], []
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)


def _in_batches(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    ready = []
    for row in rows:
        ready.append(row)
        if len(ready) >= 10_000:
            yield _table(ready, names)
            ready = []
    yield _table(ready, names)


def _candidates(percent: int, groups: int) -> Callable:
    """Of each cell the sets for which the tree's bound allows a link to another component.

    A row has token, i, j, node, n_sets, component, main, visiting and the point. Only
    visiting sets ask, and all may be found.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (token, *_), rows in _groups(batches, 3):
            rows = list({r[0]: r for r in rows}.values())
            if len(rows) < 2:
                continue
            points = np.stack([_unpacked(r[5], groups) for r in rows]).astype(np.int32)
            component, sizes = np.array([r[2] for r in rows], np.int64), points.sum(axis=1)
            tree = CountVectorTree(points, sizes, percent)
            kept = set()
            asks = np.array([r[4] for r in rows], bool)
            # Where all ask, a set that was found need not: its own partners find it.
            every = bool(asks.all())
            values, counts = np.unique(component, return_counts=True)
            if every and 2 * counts.max() > len(rows):
                # Those outside the component of most find its sets, too.
                asks, every = component != values[counts.argmax()], False
            for x in np.flatnonzero(asks).tolist():
                if not (every and x in kept):
                    near = tree.query(points[x], int(sizes[x]))
                    near = near[component[near] != component[x]]
                    if len(near):
                        kept.add(x)
                        kept.update(near.tolist())
            yield from ((token, *rows[x][:4]) for x in kept)

    return lambda batches: _in_batches(ask(batches), ["token", "node", "n_sets", "component", "main"])


def _links_of_cells(percent: int, groups: int) -> Callable:
    """(component, the smallest of those it is linked with) in each cell; a row has token, i, j, node, component, shingles."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for _, rows in _groups(batches, 3):
            rows = list({r[0]: r for r in rows}.values())
            if len(rows) < 2:
                continue
            sets = [np.frombuffer(r[2], np.uint64) for r in rows]
            points = np.stack([count_vector(s, groups) for s in sets])
            start, least = {}, {}
            for x, y in cluster(points, sets, np.array([r[1] for r in rows], np.int64), percent):
                known, new = rows[x][1], rows[y][1]
                first = start[new] = start.setdefault(known, known)
                least[first] = min(least.get(first, first), new)
            yield from ((c, least[first]) for c, first in start.items() if c != least[first])

    return lambda batches: _in_batches(join(batches), ["a", "b"])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
    groups: int = GROUPS,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles`` and ``component_id``.

    Words are runs of anything but ASCII white space, A-Z in lower case. Sets of
    ``width``-word shingles link when 100 * |intersection| >= percent * |union|.
    ``component_id`` is the smallest id reachable by links. A NULL, empty or wordless
    text has no shingles and its own id. Repeated rows stay and share a component; a
    NULL id is passed by unless all ids of a component are NULL. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    rows = docs.select(F.col(id_col).cast("long").alias("row_key"), F.col(text_col).cast("string").alias("body"))
    measured = scratch.save(
        rows.mapInArrow(
            _measure(width, groups),
            "row_key long, n_shingles long, node long, point binary, chunk int, counts binary",
        ),
        "measured",
    )
    sets = measured.filter("n_shingles IS NOT NULL").select("row_key", "n_shingles", "node")
    firsts = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("row_key").alias("first"))
    firsts = ids = scratch.save(firsts, "firsts")

    labels = _components(rows, measured, firsts, scratch, width, percent, groups)
    if labels is not None:
        lows = (
            labels.join(firsts, "node")
            .groupBy("component")
            .agg(F.min("first").alias("low"))
        )
        merged = labels.join(lows, "component").select("node", "low")
        ids = firsts.join(merged, "node", "left").select("node", F.coalesce("low", "first").alias("first"))
        ids = scratch.save(ids, "ids")
    result = sets.join(ids.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    return result.select(
        F.col("row_key").alias(id_col),
        "n_shingles",
        F.coalesce("first", "row_key").alias("component_id"),
    )


def _summed(parts: DataFrame) -> np.ndarray:
    """The sketch of the corpus, with as many bytes a count as its largest asks for."""
    chunks = parts.groupBy("chunk").applyInPandas(_add_parts, "chunk int, counts binary").collect()
    width = max((len(row["counts"]) for row in chunks), default=_SKETCH_CHUNK) // _SKETCH_CHUNK
    sketch = np.zeros(((1 << _SKETCH_BITS) // _SKETCH_CHUNK, _SKETCH_CHUNK), f"<u{width}")
    for row in chunks:
        sketch[row["chunk"]] = _unpacked(row["counts"], _SKETCH_CHUNK)
    return sketch.reshape(-1)


def _components(
    rows: DataFrame, measured: DataFrame, firsts: DataFrame, scratch: Scratch, width: int, percent: int, groups: int
) -> DataFrame | None:
    """(node, component) of the nodes that may have links, by exact components; None if none has one.

    Each stage of a plan and each table that is broadcast costs the driver some MB for a
    while. So what several plans use is written once, and rounds end with the last cell
    where two components could meet.
    """
    spark = rows.sparkSession
    sketch = _summed(measured.filter("chunk IS NOT NULL").select("chunk", "counts"))
    first_shingles = int(sketch.sum(dtype=np.int64)) * (100 - percent) // 100
    if not first_shingles and not sketch.any():
        return None
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), first_shingles // _SHINGLES_PER_BLOCK + 1)
    shared_sketch = spark.sparkContext.broadcast(sketch)
    packed = rows.select("body").mapInArrow(
        _prefixes(width, percent, blocks, shared_sketch), "block int, tokens binary, nodes binary, known binary"
    )
    dealt = packed.repartition(blocks, "block").sortWithinPartitions("block")
    shared = scratch.save(dealt.mapInArrow(_shared, "token long, node long"), "shared")

    cells = scratch.save(shared.distinct().join(_different_cells(shared.distinct()), "token"), "cells")
    scratch.drop("shared")
    if cells.isEmpty():
        return None

    def streamed(table: DataFrame) -> DataFrame:
        return table.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")

    # First by the bound alone, on count vectors: each block of a cell by itself, then
    # the sets that met nothing there with the cell's other blocks.
    touched = cells.select("node").distinct().join(firsts, "node").withColumnRenamed("node", "of")
    points = measured.join(touched, (F.col("node") == F.col("of")) & F.col("row_key").eqNullSafe(F.col("first")))
    points = scratch.save(points.select("node", "point"), "points")
    point_columns = ["token", "i", "j", "node", "n_sets", "component", "main", "visiting", "point"]
    kept_columns = "token long, node long, n_sets long, component long, main long"

    def may_link(placed: DataFrame, points: DataFrame, groups: int) -> DataFrame:
        table = streamed(placed.join(points, "node").select(point_columns))
        return table.mapInArrow(_candidates(percent, groups), kept_columns)

    own = _block(F.col("n_sets"), 0).alias("i")
    alone = [F.col("node").alias("component"), F.lit(None).cast("long").alias("main")]
    placed = cells.select("token", "n_sets", "node", *alone, own)
    met = may_link(placed.withColumn("j", F.col("i")).withColumn("visiting", F.lit(True)), points, groups)
    met = scratch.save(met, "met")
    several = placed.filter(F.col("n_sets") > _CELL_SETS)
    any_big = not several.isEmpty()
    if any_big:
        visitors = several.join(met, ["token", "node"], "left_anti")
        across = _visits(several.withColumn("visiting", F.lit(False)), visitors.withColumn("visiting", F.lit(True)))
        met = scratch.save(met.unionByName(may_link(across, points, groups)).distinct(), "met-cells")
    # A set meets once in a cell of one block. Cells that have the same sets left are one.
    tokens = _different_cells(met).select("token")
    cells = scratch.save(met.select("token", "node", "n_sets").join(tokens, "token", "left_semi"), "open-1")
    scratch.drop("cells", "met", "met-cells")
    live = scratch.save(cells.select("node").distinct().join(firsts, "node").select("node", "first"), "live")
    ids = live.select("first")
    if live.count() <= _BROADCAST_ROWS:
        ids = F.broadcast(ids)
    needed = rows.join(ids, F.col("row_key").eqNullSafe(F.col("first")), "left_semi")
    vectors = scratch.save(needed.select("body").mapInArrow(_sets(width), "node long, shingles binary"), "sets")

    merged = False
    join = _links_of_cells(percent, groups)
    components = live.select("node", F.col("node").alias("component"))
    for k in [*range(1, _MERGING_ROUNDS + 1), None]:
        if k == 1:
            open_cells = cells.withColumn("component", F.col("node"))
        else:
            open_cells = cells.join(components, "node")
            sizes = open_cells.groupBy("token", "component").agg(F.count("*").alias("n"))
            spread = sizes.groupBy("token").agg(F.count("*").alias("n"), F.max_by("component", "n").alias("main"))
            open_cells = open_cells.join(spread.filter("n > 1").select("token", "main"), "token")
            open_cells = scratch.save(open_cells, f"open-{k}")
            # Sets with no partner left outside their component leave small cells.
            small = open_cells.filter(F.col("n_sets") <= _CELL_SETS)
            tests = [(points, groups)]
            if k is None:
                tests.append((vectors.mapInArrow(_fine_points, "node long, point binary"), _FINE_GROUPS))
            for test in tests:
                asked = small.withColumns({"i": F.lit(0), "j": F.lit(0), "visiting": F.lit(True)})
                if small.count() <= _BROADCAST_ROWS:
                    asked = F.broadcast(asked)
                small = scratch.save(may_link(asked, *test), f"small-{k}-{test[1]}")
            small = small.join(_different_cells(small).select("token"), "token", "left_semi")
            open_cells = small if not any_big else small.unionByName(open_cells.filter(F.col("n_sets") > _CELL_SETS))
            if open_cells.isEmpty():
                break
        if k is None:
            # All that are not of a cell's main component meet all its blocks.
            placed = open_cells.withColumn("i", _block(F.col("n_sets"), 0))
            one = placed.filter(F.col("n_sets") <= _CELL_SETS).withColumn("j", F.col("i"))
            columns = ["token", "i", "j", "node", "component"]
            if any_big:
                several = placed.filter(F.col("n_sets") > _CELL_SETS)
                many = _visits(several, several.filter(F.col("component") != F.col("main")))
                one = one.select(columns).unionByName(many.select(columns))
            placed = one.select(columns)
        else:
            choice = F.min_by(F.struct("token", "n_sets"), F.xxhash64("token", F.lit(k))).alias("cell")
            chosen = open_cells.groupBy("node", "component").agg(choice)
            block = _block(F.col("cell.n_sets"), k).alias("i")
            placed = chosen.select("node", "component", "cell.token", block).withColumn("j", F.col("i"))
        placed = scratch.save(placed, f"placed-{k}")
        if placed.count() <= _BROADCAST_ROWS:
            placed = F.broadcast(placed)
        together = placed.join(vectors, "node")
        together = streamed(together.select("token", "i", "j", "node", "component", "shingles"))
        found = scratch.save(together.mapInArrow(join, "a long, b long"), f"links-{k}")
        if found.isEmpty():
            continue
        if merged or k is None:
            labels = connected_components(found, scratch, f"merge-{k}").toDF("component", "least")
        else:
            # Each set is its own component and came to one cell, so these are stars apart.
            labels = found.toDF("component", "least")
        components = components.join(labels, "component", "left").select(
            "node", F.coalesce("least", "component").alias("component")
        )
        components = scratch.save(components, f"components-{k}")
        merged = True
    scratch.drop("points", "sets", "open-1")
    return components if merged else None


def _different_cells(cells: DataFrame) -> DataFrame:
    """(token, n_sets) of the cells with several sets, only one of those that have the same."""
    which = F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("which")
    sizes = cells.groupBy("token").agg(F.count("*").alias("n_sets"), which).filter("n_sets > 1")
    return sizes.groupBy("n_sets", "which").agg(F.min("token").alias("token")).select("token", "n_sets")


def _block(n_sets: Column, salt: int) -> Column:
    """The block of its cell that a set belongs to; cells up to a bound have one."""
    return F.pmod(F.xxhash64("node", F.lit(salt)), F.ceil(n_sets / _CELL_SETS)).cast("int")


def _visits(several: DataFrame, visitors: DataFrame) -> DataFrame:
    """Rows of block pairs (i, j) of big cells: the visitors of i, with all sets of j."""
    others = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_sets") / _CELL_SETS).cast("int") - 1))
    coming = visitors.withColumn("j", others)
    hosts = coming.select("token", "i", "j").distinct()
    there = several.withColumnRenamed("i", "j").join(hosts, ["token", "j"])
    columns = [c for c in there.columns if c in coming.columns]
    return coming.select(columns).unionByName(there.select(columns))
