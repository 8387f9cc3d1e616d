"""I-Match fingerprints with randomised lexicons."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.scratch import Scratch
from adstream.llm.shingles import term_sets, texts

# One randomised lexicon each: the share of the lexicon that it keeps is 1/2 to this power.
# Thin lexicons compare long texts, thick ones short texts.
POWERS, PER_POWER = (1, 3, 5, 7, 9, 11, 13), 24
LEXICONS = tuple(power for power in POWERS for _ in range(PER_POWER))
_HEX = 8
_MISSING = "-" * _HEX
# Terms of the lexicon that a worker holds at once; a larger lexicon is read in parts.
PART_TERMS = 4_000_000
# The band of inverse document frequencies, ln(documents / document frequency).
LOW, HIGH = 4.0, 9.0
# A text with fewer terms in the band is read with a wider one.
MIN_TERMS = 8
_RARE = 127
_BROADCAST_ROWS = 1_000_000
_BUCKET_BYTES = 32 * 1024 * 1024
_MAX_BUCKETS = 10_000
_TERMS_AT_ONCE = 8192
_TERMS_HELD = 2_000_000
_FIRST_KEY = -(1 << 63)
_EDIT_DDL = (
    "row_key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of terms, added up within the task as far as memory is meant for it; a text counts 1/copies."""
    terms, counts, held = [], [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        term, at = np.unique(np.concatenate(terms) if terms else np.empty(0, np.uint64), return_inverse=True)
        return term, np.bincount(at, weights=np.concatenate(counts) if counts else None, minlength=len(term))

    def out(term: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(term.view(np.int64)), pa.array(n, pa.float64())], names=["term", "n"])

    for batch in batches:
        sets = list(term_sets(texts(batch.column(0))))
        terms += sets
        counts.append(np.repeat(1 / np.asarray(batch.column(1), np.float64), [len(s) for s in sets]))
        held += sum(map(len, sets))
        if held > _TERMS_HELD:
            term, n = added()
            if len(term) > _TERMS_HELD // 2:
                yield out(term, n)
                terms, counts, held = [], [], 0
            else:
                terms, counts, held = [term], [n], len(term)
    yield out(*added())


def term_counts(docs: DataFrame, text_col: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """(term, df) over the distinct texts, and how many of these there are.

    Copies of a text share one count between them, so no text moves; only hashes of
    texts do, and the ones that repeat are joined back.
    """
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = docs.select(body.alias("body"), F.xxhash64(body).alias("of"))
    groups = scratch.save(text.groupBy(F.col("of").alias("which")).agg(F.count("*").alias("copies")), "copies")
    repeated = groups.filter("copies > 1")
    if repeated.count() <= _BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    shared = text.join(repeated, F.col("of") == F.col("which"), "left")
    shared = shared.select("body", F.coalesce("copies", F.lit(1)).alias("copies"))
    counts = shared.mapInArrow(_count_terms, "term long, n double").groupBy("term")
    return counts.agg(F.round(F.sum("n")).cast("long").alias("df")), groups.count()


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


_SALTS = np.array([0x9E3779B97F4A7C15 * (k + 1) % 2**64 for k in range(len(LEXICONS))], np.uint64)
_SHIFTS = np.array([64 - power for power in LEXICONS], np.uint64)


def _subset_sums(terms: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text and randomised lexicon: the sum of its terms' hashes in it, and their number.

    ``starts`` are the places where texts with terms begin. A sum of hashes of distinct
    terms stands for the sorted list of them, and lets parts of a lexicon be added up.
    """
    salted = (terms[:, None] ^ _SALTS) * np.uint64(0xD6E8FEB86659FD93)
    member = (salted >> _SHIFTS) == 0
    sums = np.add.reduceat(np.where(member, _mixed(terms)[:, None], np.uint64(0)), starts, axis=0)
    return sums, np.add.reduceat(member.astype(np.int64), starts, axis=0)


class Prints:
    """What is known of some texts' fingerprints; parts of the lexicon are added one after the other.

    A first round counts each text's terms by the steps that the band must widen to hold them, which
    tells how wide its band is. A second one adds up the hashes of the terms in that band.
    """

    def __init__(self, terms: list[np.ndarray]):
        self.lengths = np.array([len(t) for t in terms], np.int64)
        self.terms = np.concatenate(terms) if terms else np.empty(0, np.uint64)
        self.text = np.repeat(np.arange(len(terms)), self.lengths)
        self.steps = np.full(len(self.terms), _RARE, np.int16)

    def find(self, lexicon: tuple[np.ndarray, np.ndarray]) -> None:
        known, steps = lexicon
        if len(known):
            at = np.minimum(np.searchsorted(known, self.terms), len(known) - 1)
            here = known[at] == self.terms
            self.steps[here] = steps[at[here]]

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, whether there is one) per text and randomised lexicon."""
        n, width = len(self.lengths), len(LEXICONS)
        # The narrowest band with enough terms, or all terms, the rarest ones too.
        order = np.lexsort((self.steps, self.text))
        starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])) if n else np.empty(0, np.int64)
        widest = np.full(n, _RARE, np.int16)
        enough = self.lengths >= MIN_TERMS
        widest[enough] = self.steps[order[starts[enough] + MIN_TERMS - 1]]
        kept = self.steps <= widest[self.text]
        terms, text = self.terms[kept], self.text[kept]
        sums, counts = np.zeros((n, width), np.uint64), np.zeros((n, width), np.int64)
        every = np.zeros(n, np.uint64)
        np.add.at(every, text, _mixed(terms))
        for at in range(0, len(terms), _TERMS_AT_ONCE):
            some, of = terms[at : at + _TERMS_AT_ONCE], text[at : at + _TERMS_AT_ONCE]
            begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            part_sums, part_counts = _subset_sums(some, begins)
            # A text may go on from the block before; within one block it is there once.
            sums[of[begins]] += part_sums
            counts[of[begins]] += part_counts
        # Terms that are in none of the lexicons, as may happen to one or two, are hashed in the first one's place.
        alone = (self.lengths > 0) & ~counts.any(axis=1)
        sums[alone, 0], counts[alone, 0] = every[alone], 1
        mixed = _mixed(sums ^ (counts.astype(np.uint64) << np.uint64(48)))
        return (mixed >> np.uint64(32)).astype(np.uint32), counts > 0


def _written(hashes: np.ndarray, there: np.ndarray) -> str:
    text = hashes.astype(">u4").tobytes().hex()
    if there.all():
        return text
    return "".join(text[_HEX * k : _HEX * k + _HEX] if here else _MISSING for k, here in enumerate(there.tolist()))


def lexicon_of(corpus: DataFrame, text_col: str, low: float = LOW, high: float = HIGH) -> list:
    """The terms of ``corpus`` in the band and the commoner ones, as broadcast parts (sorted terms, steps).

    The band is of inverse document frequencies ln(n / df) over the n distinct texts, so
    copies of a text change nothing. Commoner terms are there for texts with few or no terms in the band,
    each with the steps of 1 that its frequency is away; 0 is in the band. There are at most ``mean distinct
    terms of a text * e**high`` terms in all, whatever n is, cut by hash into parts of about
    ``PART_TERMS``, each plain arrays.
    """
    spark = corpus.sparkSession
    scratch = Scratch(spark, "lexicon")
    counts, n = term_counts(corpus, text_col, scratch)
    kept = scratch.save(counts.filter(F.col("df") >= n * np.exp(-high)), "terms")
    n_parts = kept.count() // PART_TERMS + 1
    parts = []
    for part in range(n_parts):
        here = kept if n_parts == 1 else kept.filter(F.pmod(F.xxhash64("term"), F.lit(n_parts)) == part)
        found = here.toArrow()
        terms = found.column("term").to_numpy().view(np.uint64)
        away = low - np.log(n / found.column("df").to_numpy())
        order = np.argsort(terms)
        steps = np.clip(np.ceil(away), 0, _RARE - 1).astype(np.int16)
        parts.append(spark.sparkContext.broadcast((terms[order], steps[order])))
    scratch.drop("terms", "copies")
    return parts


def _prints(term_sets: list[np.ndarray], lexicon: list) -> tuple[np.ndarray, np.ndarray]:
    found = Prints(term_sets)
    for part in lexicon:
        found.find(part.value)
        if len(lexicon) > 1:
            # One part is in memory at a time; it is read again from the executor's disk.
            part.__dict__.pop("_value", None)
    return found.digests()


def _fingerprints(lexicon: list, n_texts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = []
            for i in range(n_texts):
                found, there = _prints(list(term_sets(texts(batch.column(i)))), lexicon)
                prints.append(pa.array([_written(h, t) for h, t in zip(found, there)], pa.string()))
            names = [f"print_{i}" for i in range(n_texts)] + batch.schema.names[n_texts:]
            yield pa.record_batch([*prints, *batch.columns[n_texts:]], names=names)

    return run


def fingerprint(docs: DataFrame, text_cols: list[str], lexicon: list) -> DataFrame:
    """Adds ``print_0``, ``print_1``, ... for the texts in ``text_cols``, which it takes away.

    A fingerprint keeps a text's terms (words, A-Z in lower case) that are in the
    lexicon, sorts the distinct ones and hashes those in each of several randomised
    parts of it. A text with fewer than ``MIN_TERMS`` terms in the band takes the commoner
    ones in, step by step, and at last all its terms. Equal texts have equal fingerprints
    and, if they have words, likeness 1. A part none of whose terms the
    text has leaves a mark that matches nothing; so does a NULL, empty or wordless text
    throughout. Repeated rows get the same each; an empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in text_cols]
    rows = docs.select(*[F.col(c).cast("string") for c in text_cols], *rest)
    prints = ", ".join(f"print_{i} string" for i in range(len(text_cols)))
    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[len(text_cols) :])
    return rows.mapInArrow(_fingerprints(lexicon, len(text_cols)), prints + kept)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How alike two fingerprints are, from 0 to 1; row by row of (hashes, whether there is one).

    That is the share of equal hashes at the thickness of lexicon where it is
    largest, among lexicons in which either text has terms. A thickness with few of
    these counts as if it had half of all, unless the fingerprints are equal.
    """
    (x, x_there), (y, y_there) = a, b
    levels = (-1, len(POWERS), PER_POWER)
    used = (x_there | y_there).reshape(levels).sum(axis=2)
    same = (x_there & y_there & (x == y)).reshape(levels).sum(axis=2)
    shares = same / np.maximum(used, PER_POWER // 2)
    equal = (x_there == y_there).all(axis=1) & ((x == y) | ~x_there).all(axis=1)
    return np.where(equal, x_there.any(axis=1).astype(float), shares.max(axis=1, initial=0.0))


def _edits(lexicon: list) -> Callable:
    """Rows come bucket by bucket in order; each meets the next one of its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[tuple] = []
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS_AT_ONCE):
                batch = whole.slice(at, _ROWS_AT_ONCE)
                columns = [batch.column(i).to_pylist() for i in range(3)]
                rows = [
                    *carried,
                    *(
                        (bucket, guest, row_key, (text or b"").decode())
                        for bucket, guest, row_key, text in zip(*columns, texts(batch.column(3)))
                    ),
                ]
                carried = rows[-1:]
                pairs = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
                if pairs:
                    yield _edit_rows(rows, pairs, lexicon)

    return run


_ROWS_AT_ONCE = 1000


def _edit_rows(rows: list[tuple], pairs: list[int], lexicon: list) -> pa.RecordBatch:
    edited = []
    for i in pairs:
        text, following = rows[i][3], rows[i + 1][3]
        half = len(text) // 2
        edited.append((text[: len(text) - half] + following[:half]).encode())
    own = [text.encode() for *_, text in rows]
    hashed, there = _prints(list(term_sets(own + edited)), lexicon)
    mine, after = np.array(pairs), np.array(pairs) + 1
    new = np.arange(len(rows), len(rows) + len(pairs))
    of = lambda at: (hashed[at], there[at])
    columns = [
        ([rows[i][2] for i in pairs], pa.int64()),
        ([len(rows[i][3]) for i in pairs], pa.int64()),
        ([hashlib.sha256(t).hexdigest() for t in edited], pa.string()),
        ([_written(hashed[i], there[i]) for i in pairs], pa.string()),
        ([_written(hashed[i], there[i]) for i in new], pa.string()),
        (likeness(of(mine), of(new)), pa.float64()),
        (likeness(of(mine), of(after)), pa.float64()),
    ]
    return pa.record_batch([pa.array(c, t) for c, t in columns], names=_EDIT_NAMES)


_EDIT_NAMES = [column.split()[0] for column in _EDIT_DDL.split(", ")]


def _bucket(key: Column, second: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted bounds are at most (key, second), by halving."""
    if not bounds:
        return F.lit(0)
    firsts, seconds = (F.array(*(F.lit(b[k]).cast("long") for b in bounds)) for k in (0, 1))
    steps = [2**k for k in range(len(bounds).bit_length() - 1, -1, -1)]

    def halve(low: Column, step: Column) -> Column:
        first = F.get(firsts, low + step - 1)
        passed = (first < key) | ((first == key) & (F.get(seconds, low + step - 1) <= second))
        return F.when(passed, low + step).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), halve)


def _bounds(rows: DataFrame, parts: int) -> list[tuple[int, int]]:
    """Where buckets begin: at quantiles of the ids, and within an id that has many rows at its texts' hashes."""
    cuts = [i / parts for i in range(1, parts)] or [0.5]
    found = rows.agg(F.percentile_approx("first_key", cuts, 100 * parts).alias("q"), F.count("*").alias("n")).first()
    bounds = {(key, _FIRST_KEY) for key in found["q"] or []}
    # Fewer than there are parts, as each has a part's share of the rows.
    share = max(found["n"] // parts, 1)
    heavy = rows.groupBy("first_key").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * share)
    for row in heavy.collect():
        pieces = row["n"] // share
        bounds |= {(row["first_key"], _FIRST_KEY + (k << 64) // pieces) for k in range(pieces)}
    return sorted(bounds)


def edit_likeness(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH
) -> DataFrame:
    """How fingerprints follow an edit: each text against itself with its end replaced.

    The edited text has its last half of code points replaced by the beginning of the
    next row's, in order of id (NULL first; rows of one id by their texts' hashes); the last row's next is the
    first. Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. NULL texts count as empty; other columns are ignored.

    Texts move once, into buckets of (id, hash of the text), each a task of its own; an id that has
    many rows is cut between texts. Each bucket also gets the first
    row of the bucket after it, so neighbours always meet; there is one such row a bucket.
    """
    lexicon = lexicon_of(docs, text_col, low, high)
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("row_key"), body.alias("body")).select(
        "row_key", "body", F.coalesce("row_key", F.lit(_FIRST_KEY)).alias("first_key"), F.xxhash64("body").alias("second_key")
    )
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rows, max(partitions, min(size // _BUCKET_BYTES + 1, _MAX_BUCKETS)))
    order = ["first_key", "second_key"]
    bucketed = rows.withColumn("bucket", _bucket(F.col("first_key"), F.col("second_key"), bounds))
    firsts = bucketed.groupBy("bucket").agg(F.min(F.struct(*order, F.col("row_key").isNotNull())).alias("low"))
    heads = [(r["bucket"], r["low"][0], r["low"][1]) for r in firsts.orderBy("bucket").collect()]
    if not heads:
        return spark.createDataFrame([], _EDIT_DDL).withColumnRenamed("row_key", id_col)
    # Each bucket's guest is the head of the next one.
    guests = [(b, *heads[(i + 1) % len(heads)][1:]) for i, (b, *_) in enumerate(heads)]
    wanted = F.broadcast(spark.createDataFrame(guests, "bucket int, first_key long, second_key long"))
    head = rows.join(wanted, order).groupBy("bucket", *order).agg(F.min("body").alias("body"))
    columns = ["bucket", "guest", "row_key", "body", *order]
    everything = bucketed.withColumn("guest", F.lit(False)).select(columns).unionByName(
        head.withColumns({"guest": F.lit(True), "row_key": F.lit(None).cast("long")}).select(columns)
    )
    dealt = everything.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions(
        "bucket", "guest", *order, "body"
    )
    return dealt.select("bucket", "guest", "row_key", "body").mapInArrow(_edits(lexicon), _EDIT_DDL).withColumnRenamed(
        "row_key", id_col
    )
