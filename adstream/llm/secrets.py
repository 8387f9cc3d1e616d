"""Secrets in texts: fixed patterns, and character Markov models of random strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.arrays import let, scan
from adstream.llm.text import whole, words

# The base patterns, in order of kind, and the characters each needs.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
BASE_KINDS = {
    "assign": (ASSIGN, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
# A pattern that finds a text's possible matches of a kind more cheaply than the kind's own.
_HINTS = {"hex": r"[0-9a-f]{24}", "access": "AKIA"}
_LONG_HEX = r"[0-9a-f]{24,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
MARKOV = "markov"
_STATES = len(ALPHABET) + 1
_SPAN_FIELDS = ("start", "rank", "end", "kind")
# Inside, a span also has its places in bytes, at which texts can be cut without counting characters.
_SPAN = "struct<start: int, rank: int, end: int, kind: string, from: int, to: int, token: string>"
_MOST_HALVINGS = 26

SAMPLE_DOCUMENTS = 500
RANDOM_STRINGS = 4000
THRESHOLD = 0.35
_KINDS = (True, False)
_PRIOR = 8.0


def _no_spans() -> Column:
    return F.from_json(F.lit("[]"), f"array<{_SPAN}>")


def find_spans(text: Column, pattern: str, group: int, least: int, kind: str, rank: int) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches whose ``group`` has ``least`` characters.

    A match begins where the texts between matches and the matches before it end.
    """
    whole_match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = {"gap": F.split(text, pattern, -1), "match": whole_match}
    if group:
        found["needed"] = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(parts: Column) -> Column:
        # The text after the last match has none of its own.
        zipped = F.slice(F.arrays_zip(*(parts[name] for name in found)), 1, F.size(parts["match"]))

        def emit(at: Column, z: Column) -> Column:
            start, begin = at["chars"] + F.length(z["gap"]), at["bytes"] + F.octet_length(z["gap"])
            asked = z["needed"] if group else z["match"]
            return F.struct(
                start.alias("start"),
                F.lit(rank).alias("rank"),
                (start + F.length(z["match"])).alias("end"),
                F.lit(kind).alias("kind"),
                begin.alias("from"),
                (begin + F.octet_length(z["match"])).alias("to"),
                F.when(F.length(asked) >= least, z["match"]).alias("token"),
            )

        def step(at: Column, z: Column) -> Column:
            return F.struct(
                (at["chars"] + F.length(z["gap"]) + F.length(z["match"])).alias("chars"),
                (at["bytes"] + F.octet_length(z["gap"]) + F.octet_length(z["match"])).alias("bytes"),
            )

        zero = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("bytes"))
        return F.filter(scan(zipped, zero, step, emit, _SPAN), lambda s: s["token"].isNotNull())

    return let(F.struct(*(value.alias(name) for name, value in found.items())), placed)


def _how_many_below(ordered: Column, value: Column, inclusive: bool) -> Column:
    """How many numbers of an ascending array are below ``value`` (or at most that), by halving."""

    def halve(low: Column, step: Column) -> Column:
        tried = F.get(ordered, low + step - 1)
        return F.when(tried <= value if inclusive else tried < value, low + step).otherwise(low)

    steps = F.array(*(F.lit(1 << k) for k in range(_MOST_HALVINGS, -1, -1)))
    return F.aggregate(steps, F.lit(0), halve)


def _apart(candidates: Column, spans: Column) -> Column:
    """The candidates that overlap none of the spans; both in order, neither overlapping itself."""
    places = F.struct(
        F.transform(spans, lambda s: s["start"]).alias("starts"), F.transform(spans, lambda s: s["end"]).alias("ends")
    )

    def free(at: Column) -> Column:
        return F.filter(
            candidates,
            lambda c: _how_many_below(at["starts"], c["end"], False) == _how_many_below(at["ends"], c["start"], True),
        )

    return F.when((F.size(candidates) > 0) & (F.size(spans) > 0), let(places, free)).otherwise(candidates)


def base_spans(text: Column) -> dict[str, Column]:
    found = {}
    for rank, (kind, (pattern, group, least)) in enumerate(BASE_KINDS.items()):
        # Runs of hex digits are maximal, so shorter ones may be skipped beforehand.
        spans = find_spans(text, _LONG_HEX if kind == "hex" else pattern, group, least, kind, rank)
        found[kind] = F.when(text.rlike(_HINTS.get(kind, pattern)), spans).otherwise(_no_spans())
    return found


def labelled_strings(docs: DataFrame, text_col: str, sample_documents: int, random_strings: int) -> DataFrame:
    """(random, token): the labelled samples of both kinds of strings, of bounded number.

    Random ones are digests in the usual notations and the values that base patterns
    found in the sampled texts. Ordinary ones are those texts' other words, as they
    are, in capitals, and joined in pairs and triples as identifiers are.
    """
    spark = docs.sparkSession
    n = docs.count()
    every = max(1, n // sample_documents)
    text = F.col(text_col).cast("string")
    # Distinct texts, the first ones by hash: copies of a text fill no sample, and reruns agree.
    hashed = docs.select(whole(text).alias("body"), F.xxhash64(whole(text)).alias("of"))
    sample = hashed.filter(F.pmod("of", F.lit(every)) == 0).groupBy("of").agg(F.min("body").alias("body"))
    sample = sample.orderBy("of").limit(2 * sample_documents).select("body")
    secret = sample.select(
        F.explode(
            F.flatten(
                F.array(
                    F.regexp_extract_all("body", F.lit(ASSIGN), F.lit(2)),
                    F.regexp_extract_all("body", F.lit(r"AKIA[A-Z0-9]{16,}"), F.lit(0)),
                    F.regexp_extract_all("body", F.lit(_LONG_HEX), F.lit(0)),
                )
            )
        ).alias("token")
    ).filter(F.length("token") >= 16)
    rest = F.col("body")
    for pattern in (ASSIGN, r"AKIA[A-Z0-9]{16,}", _LONG_HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    plain = F.filter(
        F.transform(words(rest), lambda w: F.regexp_extract(w, r"[A-Za-z_-]+", 0)), lambda w: F.length(w) >= 2
    )

    def joined(w: Column) -> Column:
        """The words, in capitals too, and joined with the ones behind them."""
        size = F.size(w)
        later = [F.slice(w, k, F.greatest(size - (k - 1), F.lit(0))) for k in (2, 3)]
        rows = F.slice(F.arrays_zip(w.alias("a"), later[0].alias("b"), later[1].alias("c")), 1, size)
        pair = F.transform(
            rows,
            lambda r, i: F.when(i % 3 == 0, F.concat_ws("_", r["a"], r["b"], r["c"]))
            .when(i % 3 == 1, F.concat_ws("-", r["a"], r["b"]))
            .otherwise(F.concat(r["a"], F.initcap(F.coalesce(r["b"], F.lit(""))))),
        )
        return F.flatten(F.array(w, pair, F.transform(w, F.upper)))

    ordinary = sample.select(F.explode(let(plain, joined)).alias("token"))
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 512)
    raw = F.unhex(digest)
    token = (
        F.when(F.col("id") % 4 == 0, digest)
        .when(F.col("id") % 4 == 1, F.upper(digest))
        .when(F.col("id") % 4 == 2, F.translate(F.base64(raw), "\r\n", ""))
        .otherwise(F.translate(F.base64(raw), "+/=\r\n", "-_"))
    )
    made = spark.range(random_strings).select(F.substring(token, 1, 40).alias("token"))
    return (
        made.unionByName(secret)
        .select(F.lit(True).alias("random"), "token")
        .unionByName(ordinary.distinct().select(F.lit(False).alias("random"), "token"))
    )


def _states(token: Column) -> Column:
    letters = F.filter(F.split(token, "", -1), lambda c: c != "")
    return F.transform(letters, lambda c: F.position(c, F.lit(ALPHABET)))


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of every transition, row by row: random against ordinary.

    Transitions are counted in Spark; their number is bounded by the alphabet's square.
    """
    pairs = samples.select("random", _states(F.col("token")).alias("s")).select(
        "random",
        F.explode(
            F.transform("s", lambda a, i: F.struct(a.alias("a"), F.get("s", i + 1).alias("b")))
        ).alias("p"),
    )
    counts = {
        (r["random"], r["a"], r["b"]): r["n"]
        for r in pairs.filter("p.b IS NOT NULL")
        .groupBy("random", "p.a", "p.b")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    # A transition that was seen little is judged by how frequent its second character is.
    ends = [[sum(counts.get((kind, a, b), 0) for a in range(_STATES)) + 0.5 for b in range(_STATES)] for kind in _KINDS]
    shares = [[n / sum(row) for n in row] for row in ends]
    out = []
    for a in range(_STATES):
        rows = [
            [counts.get((kind, a, b), 0) + _PRIOR * share[b] for b in range(_STATES)]
            for kind, share in zip(_KINDS, shares)
        ]
        sums = [sum(r) for r in rows]
        out += [math.log(x / sums[0]) - math.log(y / sums[1]) for x, y in zip(*rows)]
    return out


def likelihood_ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio of a token's transitions."""
    weights = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")

    def terms(states: Column) -> Column:
        following = F.slice(states, 2, F.greatest(F.size(states) - 1, F.lit(0)))
        return F.zip_with(states, following, lambda a, b: F.get(weights, a * _STATES + b))

    total = F.aggregate(let(_states(token), terms), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    return total / F.greatest(F.length(token) - 1, F.lit(1))


def _located(docs: DataFrame, text_col: str, threshold: float, sample_documents: int, random_strings: int) -> DataFrame:
    """``row`` (all columns of ``docs``), ``body`` and ``spans``, with their places in bytes."""
    table = train(labelled_strings(docs, text_col, sample_documents, random_strings))
    rows = docs.select(F.struct("*").alias("row"), whole(F.col(text_col)).alias("body"))
    text = F.col("body")
    base = base_spans(text)
    found = rows.withColumns({f"base_{kind}": spans for kind, spans in base.items()})
    candidates = F.when(
        text.rlike(CANDIDATE), find_spans(text, CANDIDATE, 0, 20, MARKOV, len(BASE_KINDS))
    ).otherwise(_no_spans())
    found = found.withColumn("free", candidates)
    for kind in base:
        found = found.withColumn("free", _apart(F.col("free"), F.col(f"base_{kind}")))
    more = F.filter("free", lambda c: likelihood_ratio(c["token"], table) > threshold)
    every = F.array_sort(F.concat(*(f"base_{kind}" for kind in base), more))
    return found.select("row", "body", every.alias("spans"))


def find_secrets(
    docs: DataFrame,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    sample_documents: int = SAMPLE_DOCUMENTS,
    random_strings: int = RANDOM_STRINGS,
) -> DataFrame:
    """Adds ``secrets`` to every row: its spans (start, rank, end, kind), by start, then kind.

    Positions are code points, ends exclusive. Base kinds come from fixed patterns,
    each leftmost and non-overlapping in itself. Kind ``markov`` are further runs of
    20 or more key characters that touch no base span and whose transitions fit the model of
    random strings better than that of ordinary identifiers, by more than the
    threshold on the mean. Both models are trained on bounded samples. A NULL or empty text
    has no spans; equal rows get equal spans. Columns of ``docs`` stay, but for one
    called ``secrets``; an empty table gives an empty result.
    """
    # The spans are made before the rows' own columns come back, whose names may be those used here.
    done = _located(docs, text_col, threshold, sample_documents, random_strings)
    spans = F.transform("spans", lambda s: F.struct(*(s[f].alias(f) for f in _SPAN_FIELDS)))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c != "secrets"]
    return done.select(*kept, spans.alias("secrets"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask_secrets(
    docs: DataFrame,
    text_col: str = "text",
    mask: str = "[SECRET]",
    threshold: float = THRESHOLD,
    sample_documents: int = SAMPLE_DOCUMENTS,
    random_strings: int = RANDOM_STRINGS,
) -> DataFrame:
    """The rows of ``docs`` with every span of its text replaced by ``mask``; overlapping spans by one.

    Texts without spans, also NULL, stay as they are, and so do all other columns.
    """
    done = _located(docs, text_col, threshold, sample_documents, random_strings)

    def masked(given: Column) -> Column:
        # Cut in bytes, as a place in characters is found by counting from the beginning.
        raw, spans = given["raw"], given["spans"]

        def cut(start: Column, end: Column) -> Column:
            return F.substring(raw, start + 1, F.greatest(end - start, F.lit(0))).cast("string")

        pieces = scan(
            spans,
            F.lit(0),
            lambda at, s: F.greatest(at, s["to"]),
            lambda at, s: F.when(s["from"] < at, F.lit("")).otherwise(F.concat(cut(at, s["from"]), F.lit(mask))),
            "string",
        )
        last = F.array_max(F.transform(spans, lambda s: s["to"]))
        return F.concat(F.array_join(pieces, ""), cut(last, F.octet_length(raw)))

    given = F.struct(F.col("body").cast("binary").alias("raw"), F.col("spans").alias("spans"))
    text = F.when(F.size("spans") > 0, let(given, masked)).otherwise(F.col("row")[text_col])
    return done.select(*((text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns))
