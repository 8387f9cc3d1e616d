"""Ranked lexical search for a set of queries, by scanning documents with an automaton."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch
from adstream.llm.terms import BYTE_TABLE, spaced
from adstream.llm.workercache import worker_latest

# Terms of all items of one block, in bytes, and items of one block: bounds of what is broadcast.
BLOCK_BYTES = 4 << 20
BLOCK_ITEMS = 20_000
# Documents scored at once; a slice ends earlier when it has met this many (term, item) pairs.
_SLICE_ROWS = 256
_SLICE_PAIRS = 2_000_000
# Sums of at most this many terms are exact in doubles.
_EXACT_TERMS = 100_000


class Block:
    """Some items: their distinct terms and, per term, the items that have it. Plain arrays only."""

    def __init__(self, items: list[list[bytes]]):
        self.terms = sorted(set().union(*items))
        number = {term: i for i, term in enumerate(self.terms)}
        pairs = sorted((number[t], k) for k, terms in enumerate(items) for t in terms)
        self.items = len(items)
        self.of_term = np.array([k for _, k in pairs], np.int32)
        ends = np.searchsorted(np.array([t for t, _ in pairs], np.int64), np.arange(len(self.terms) + 1))
        self.starts = ends.astype(np.int64)
        self.longest = max(map(len, items), default=0)


def _automaton(terms: list[bytes]):
    """Matches a term only between spaces, its guards; neighbours share the space between them."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(f" {term.decode('latin-1')} ", i)
    found.make_automaton()
    return found


def _scanner(terms: list[bytes]) -> Callable:
    """text -> (number of its terms, item terms in it, how often each)."""
    key = hashlib.sha256(b" ".join(terms)).hexdigest()
    automaton = worker_latest("automaton", key, lambda: _automaton(terms) if terms else None)

    def scan(text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        flat = spaced(text)
        # Bytes as letters: UTF-8 never matches across characters.
        met = [i for _, i in automaton.iter(f" {flat.decode('latin-1')} ")] if automaton is not None else []
        ids, times = np.unique(np.array(met, np.int64), return_counts=True)
        return len(flat.split()), ids, times

    return scan


def _statistics(terms) -> Callable:
    """One task's (term, number of documents with it); -1 for documents with a term, -2 for all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(terms.value)
        df, documents, total = np.zeros(len(terms.value), np.int64), 0, 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                n, ids, _ = scan(text.as_py())
                df[ids] += 1
                documents += n > 0
                total += n
        used = np.flatnonzero(df)
        yield pa.record_batch(
            [
                pa.array(np.concatenate(([-1, -2], used)), pa.int64()),
                pa.array(np.concatenate(([documents, total], df[used])), pa.int64()),
            ],
            names=["term", "n"],
        )

    return run


class _Best:
    """The ``k`` best documents per item: highest score, then smallest id, NULL last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)
        self.id = np.zeros((items, k), np.int64)
        self.null = np.ones((items, k), bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """scores: one row per document, one column per item."""
        hopeful = (scores > 0) & (scores >= self.score[:, -1])
        for item in np.flatnonzero(hopeful.any(axis=0)):
            at = np.flatnonzero(hopeful[:, item])
            score = np.concatenate((self.score[item], scores[at, item]))
            id_ = np.concatenate((self.id[item], ids[at]))
            null = np.concatenate((self.null[item], nulls[at]))
            first = np.lexsort((id_, null, -score))[: self.k]
            self.score[item], self.id[item], self.null[item] = score[first], id_[first], null[first]

    def rows(self) -> pa.RecordBatch:
        item, at = np.nonzero(self.score > 0)
        return pa.record_batch(
            [
                pa.array(item, pa.int32()),
                pa.array(self.score[item, at]),
                pa.array(self.id[item, at], mask=self.null[item, at]),
            ],
            names=["item", "score", "doc_id"],
        )


def _top(block, weights: np.ndarray, n_documents: int, n_terms: int, k: int, damping: int) -> Callable:
    """One task's best documents per item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, of_term, starts, n_items, longest = block.value
        scan = _scanner(terms)
        best = _Best(n_items, k)
        shape = max(1, _SLICE_ROWS * 1024 // max(n_items, 1024))
        for batch in batches:
            ids = batch.column(1).fill_null(0).to_numpy()
            nulls = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            held, pairs, first = [], 0, 0
            for at, text in enumerate(batch.column(0).cast(pa.binary()), 1):
                n, found, tf = scan(text.as_py())
                length = 100 - damping + (damping * n * n_documents) // max(n_terms, 1)
                held.append((found, weights[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length))))
                pairs += int((starts[found + 1] - starts[found]).sum())
                if len(held) == shape or pairs > _SLICE_PAIRS or at == batch.num_rows:
                    scores = _sums(held, starts, of_term, n_items, longest)
                    best.add(scores, ids[first:at], nulls[first:at])
                    held, pairs, first = [], 0, at
        yield best.rows()

    return run


def _sums(held: list, starts: np.ndarray, of_term: np.ndarray, n_items: int, longest: int) -> np.ndarray:
    """Per document and item the sum over the item's terms."""
    found = np.concatenate([f for f, _ in held])
    parts = np.concatenate([p for _, p in held])
    row = np.repeat(np.arange(len(held)), [len(f) for f, _ in held])
    count = starts[found + 1] - starts[found]
    # The places in of_term of each found term's items, end to end.
    ends = np.cumsum(count)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[found] - (ends - count), count)
    cell = np.repeat(row, count) * n_items + of_term[places]
    values, size = np.repeat(parts, count), len(held) * n_items
    if longest <= _EXACT_TERMS:
        sums = np.bincount(cell, weights=values, minlength=size).astype(np.int64)
    else:
        sums = np.zeros(size, np.int64)
        np.add.at(sums, cell, values)
    return sums.reshape(len(held), n_items)


def _blocks(items: DataFrame, block_bytes: int, block_items: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """The items in blocks of bounded size; the driver holds one block and one written partition."""
    numbers, terms, size = [], [], 0
    for row in items.toLocalIterator():
        found = sorted(set(bytes(row["_body"] or b"").translate(BYTE_TABLE).split()))
        grown = sum(map(len, found))
        if numbers and (size + grown > block_bytes or len(numbers) == block_items):
            yield numbers, terms
            numbers, terms, size = [], [], 0
        numbers.append(row["_number"])
        terms.append(found)
        size += grown
    if numbers:
        yield numbers, terms


def _weights(df: np.ndarray, n_documents: int, spark) -> np.ndarray:
    """Rarer terms weigh more: a thousand times a log ratio, rounded down."""
    wanted = sorted(set(df.tolist()))
    rows = spark.createDataFrame([(n,) for n in wanted] or [(0,)], "df long")
    weight = F.floor(
        F.lit(1000.0) * F.ln(F.lit(float(2 * n_documents + 2)) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))
    )
    # One row per distinct count of a block's terms.
    of = {r["df"]: r["w"] for r in rows.select("df", weight.alias("w")).collect()}
    return np.array([of[n] for n in df.tolist()], np.int64)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    damping: int = 90,
    block_bytes: int = BLOCK_BYTES,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item, among those that score above 0.

    Returns item id, rank (from 1), document id, score. Terms are lower-cased (A-Z) runs of
    ASCII letters, digits and all beyond ASCII; a document's score adds, over an item's
    distinct terms in it, the term's weight times a saturated count that is damped by the
    document's length (``damping`` of 100 parts), in whole numbers. Ties go to smaller ids.

    NULL or empty texts have no terms and are never found; texts are read whole. Repeated
    document rows are documents each, with ranks of their own; a NULL document id comes last among ties.
    Exact copies of an item row count once, rows of one id with different texts are
    searched each for itself; other columns are ignored; empty tables give no rows.

    There is no index of documents: the items' terms make an automaton, and each task counts
    them in its texts in one scan, once for document frequencies and once for scores. Items
    come in blocks whose terms are at most ``block_bytes`` (one item may exceed it alone), so
    what is broadcast is bounded; each block reads the documents twice. A task
    sends at most ``k`` rows per item on.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    wanted = items.select(F.col(item_col).alias("_item"), F.col(item_text_col).cast("string").alias("_text")).distinct()
    numbered = scratch.save(wanted.withColumn("_number", F.monotonically_increasing_id()), "items")
    bodies = numbered.select("_number", F.col("_text").cast("binary").alias("_body"))
    rows = docs.select(F.col(text_col).cast("string").alias("_body"), F.col(id_col).cast("long").alias("_id"))
    texts = rows.select("_body")
    tops, n_documents, n_terms = [], None, None
    for b, (numbers, terms) in enumerate(_blocks(bodies, block_bytes, block_items)):
        block = Block(terms)
        sent = spark.sparkContext.broadcast(block.terms)
        found = texts.mapInArrow(_statistics(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        # At most one row per term of the block.
        counts = {r["term"]: r["n"] for r in found.collect()}
        n_documents, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        df = np.array([counts.get(i, 0) for i in range(len(block.terms))], np.int64)
        weights = _weights(df, n_documents, spark)
        whole = spark.sparkContext.broadcast((block.terms, block.of_term, block.starts, block.items, block.longest))
        best = rows.mapInArrow(
            _top(whole, weights, n_documents, n_terms, k, damping), "item int, score long, doc_id long"
        )
        names = spark.createDataFrame(list(enumerate(numbers)), "item int, _number long")
        tops.append(scratch.save(_best_of(best.join(F.broadcast(names), "item"), F.col("_number"), k), f"top-{b}"))
    if not tops:
        empty = numbered.select("_number", F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("doc_id"))
        tops.append(empty.withColumn("rank", F.lit(1)).limit(0))
    every = tops[0]
    for more in tops[1:]:
        every = every.unionByName(more)
    ids = numbered.select("_number", F.col("_item").alias(item_col))
    return every.join(ids, "_number").select(item_col, "rank", F.col("doc_id").alias(id_col), "score")


def _best_of(rows: DataFrame, item: Column, k: int) -> DataFrame:
    order = Window.partitionBy(item).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(item.alias("_number"), "score", "doc_id", "rank")
