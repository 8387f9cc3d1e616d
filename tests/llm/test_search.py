"""Importance resampling and ranked search against brute force."""

import collections
import hashlib
import math
import re
import zlib
from fractions import Fraction

import pytest

from adstream.llm import importance, ranking

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score long, rank int, weight string, _key int"
NOT_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return NOT_TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", 0, 1, 2, "w", 3) for i, t in enumerate(texts)], DOCS)


TEXTS = [
    *(" ".join(f"W{(i * 31 + k * k) % 97}" for k in range(8 + i % 40)) for i in range(120)),
    "Été ÉTÉ été a_b a-b A.B 1a2 İx 中文 nbsp here",
    "",
    None,
    " \t\n--",
    *(["the same text " * 8] * 30),
    "long " * 20_000,
]
TARGET = ["w3 w4 W5 w5 w77", None, "", "été the", "w3 w4"]


def expected_draw(rows, target, buckets=10_000):
    """rows: (id, text); the whole contract in plain Python."""
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s = collections.Counter(bucket(w) for _, t in rows for w in terms(t))
    t = collections.Counter(bucket(w) for x in target for w in terms(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, text in rows:
        w = terms(text)
        weight = sum(gain(bucket(x)) for x in w)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    eligible = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(eligible[: 10 * len(eligible) // 100], 1):
        r[4] = k
    return sorted(map(tuple, out), key=repr)


def test_draw_matches_brute_force(spark):
    docs = corpus(spark, TEXTS)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    got = importance.resample(docs, target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_draw(list(enumerate(TEXTS)), TARGET)


def test_draw_of_repeated_rows_ties_and_null_ids(spark):
    text = "tie " * 25
    rows = [(7, text)] * 40 + [(None, text)] * 30 + [(8, text)] * 40 + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    got = importance.resample(docs.repartition(7), target, percent=50).collect()
    assert len(got) == len(rows)
    ranks = sorted((r["rank"], r["score"]) for r in got if r["rank"])
    assert [r for r, _ in ranks] == list(range(1, 56))
    scores = [s for _, s in ranks]
    assert scores == sorted((r["score"] for r in got if r["n_features"]), reverse=True)[:55]


def test_draw_of_nothing(spark):
    empty = corpus(spark, []).limit(0)
    target = spark.createDataFrame([("a b",)], "text string")
    assert importance.resample(empty, target).count() == 0
    few = importance.resample(corpus(spark, ["a b c"] * 5), target.limit(0)).collect()
    assert len(few) == 5 and {r["rank"] for r in few} == {None}


def test_longer_features(spark):
    n, features = importance._features(b"One two, three", 2)
    assert n == 3 and features == [b"one", b"two", b"three", b"one two", b"two three"]


@pytest.mark.parametrize("values", [[5], [3, 3, 3], [-(1 << 62), 0, 1 << 62, 7, 7], list(range(100)), [0, -1, -2, 9] * 9])
def test_nth_largest(spark, values):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values, reverse=True)
    for n in {1, len(values) // 2 or 1, len(values)}:
        assert importance.nth_largest(rows, F.col("v"), n) == ordered[n - 1]


def expected_search(rows, items, k=10):
    counts = [(i, collections.Counter(terms(t))) for i, t in rows]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for *_, n in counts)
    df = collections.Counter(t for _, c, _ in counts for t in c)
    # The only real numbers; a fraction keeps the quotient exact up to the logarithm.
    weight = {t: math.floor(1000 * math.log(Fraction(2 * n_docs + 2, 2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        wanted = set(terms(text))
        scored = []
        for i, c, n in counts:
            m = 10 + (90 * n * n_docs) // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            scored += [(-score, i is None, i or 0, i)] if score > 0 else []
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


ITEMS = [
    (1, "W3 w4, w5; w3"),
    (2, "ÉTÉ 中文 Été"),
    (3, "a b nothing"),
    (4, None),
    (5, ""),
    (6, "no term of these is anywhereelse"),
    (7, "the same text"),
    (8, "lo ng ext tex"),
    (None, "w10 w11 w12 w13"),
    (9, " ".join(f"w{i}" for i in range(97))),
    (9, "w96 w95"),
]


def items(spark):
    return spark.createDataFrame([(i, t, 0, 0) for i, t in ITEMS], "item_id long, text string, score int, rank int")


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 20}, {"block_items": 2}])
def test_search_matches_brute_force(spark, limits):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[4]), (None, TEXTS[4])]
    docs = corpus(spark, TEXTS).unionByName(
        spark.createDataFrame([(i, t, "", "", 0, 0, 0, "", 0) for i, t in rows[len(TEXTS) :]], DOCS)
    )
    found = ranking.search(docs.repartition(5), items(spark).union(items(spark)), **limits)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected_search(rows, ITEMS)


def test_search_of_nothing(spark):
    docs = corpus(spark, TEXTS[:3])
    assert ranking.search(docs.limit(0), items(spark)).count() == 0
    assert ranking.search(docs, items(spark).limit(0)).count() == 0
    assert ranking.search(corpus(spark, [None, "", "--"]), items(spark)).count() == 0


def test_sums_of_very_long_items_stay_whole(monkeypatch):
    import numpy as np

    block = ranking.Block([[b"a", b"b"], [b"b"]])
    held = [(np.array([0, 1]), np.array([(1 << 53) + 1, 2])), (np.array([], np.int64), np.array([], np.int64))]
    monkeypatch.setattr(ranking, "_EXACT_TERMS", 1)
    sums = ranking._sums(held, block.starts, block.of_term, block.items, block.longest)
    assert sums.tolist() == [[(1 << 53) + 3, 2], [0, 0]]


def test_queries_match_their_sql(spark):
    import duckdb

    from adstream.llm import queries

    folder = "/root/testdata/sf0.001"
    database = duckdb.connect()
    for name in ("documents", "benchmark"):
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        ours = queries.QUERIES[name](spark, folder)
        theirs = database.execute(f"SELECT {', '.join(ours.columns)} FROM ({sql})").fetchall()
        assert sorted(map(tuple, ours.collect()), key=repr) == sorted(theirs, key=repr)
