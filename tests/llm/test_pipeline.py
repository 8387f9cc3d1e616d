"""The stages of the pipeline: what each keeps, against plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from adstream.llm import mixing, packing, quality

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, number int, quality string, "
    "kept int, secrets string, n_words int, copies int, size string, component_id int, spans int"
)
EXTRA = ("r", 1, "q", 2, "s", 3, 4, "z", 5, 6)
LETTERS = "bcdfghjklmnprstvw"


def prose(seed, n=90):
    """Sentences of invented words among common ones, different for each seed."""
    draw = random.Random(seed)
    common = "the of and to in is that it was for".split()
    invented = lambda: "".join(draw.choice(LETTERS) + draw.choice("aeiou") for _ in range(3))
    words = [draw.choice(common) if k % 2 else invented() for k in range(n)]
    return " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))


def documents(spark, rows):
    """(doc_id, text, source) with columns whose names the stages use themselves."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in rows], SCHEMA)


def found(table):
    return [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


TEXTS = [prose(i) for i in range(12)]


def test_quality_stage_keeps_what_the_rules_keep(spark):
    rows = [(i, t, "a") for i, t in enumerate(TEXTS)] + [(50, "too short", "a"), (51, None, "a"), (52, "", None)]
    rows += [(53, "spam " * 100, "b"), (None, TEXTS[0], None), (None, TEXTS[0], None)]
    docs = documents(spark, rows)
    kept = stage("quality_rules")(spark, docs, "")
    assert kept.columns == docs.columns
    judged = quality.assess_quality(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    want = [(r["doc_id"], r["text"], r["source"]) for r in judged.collect() if r["kept"]]
    assert collections.Counter(found(kept)) == collections.Counter(want)
    assert len(want) >= 12 and not {50, 51, 52, 53} & {i for i, *_ in want}
    assert {tuple(r)[5:] for r in kept.collect()} == {EXTRA}


def test_no_text_is_lost_with_its_near_copies(spark):
    a, b = TEXTS[0], TEXTS[1]
    for rows, want in (
        ([(1, a), (1, b), (2, b), (None, a), (None, a)], [(1, a), (1, b)]),
        ([(None, a), (None, a), (None, b)], [(None, a), (None, b)]),
        ([(5, a), (5, a), (3, a + " end"), (None, a)], [(3, a + " end")]),
        ([(4, None), (4, None), (6, "")], [(4, None), (4, None), (6, "")]),
    ):
        docs = documents(spark, [(i, t, "s") for i, t in rows]).repartition(3)
        kept = stage("ngram_jaccard_join")(spark, docs, "")
        assert kept.columns == docs.columns
        assert collections.Counter((i, t) for i, t, _ in found(kept)) == collections.Counter(want)


def sets_of(text):
    w = text.lower().split()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_one_row_of_each_group_stays(spark):
    near = [t.replace(t.split()[k], "other", 1) for k, t in enumerate(TEXTS[:8])]
    texts = TEXTS + near + TEXTS[:3]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    sets, label = [sets_of(t) for t in texts], list(range(len(texts)))
    for _ in texts:
        for x, a in enumerate(sets):
            for y, b in enumerate(sets):
                if 100 * len(a & b) >= 75 * len(a | b):
                    label[x] = label[y] = min(label[x], label[y])
    kept = stage("ngram_jaccard_join")(spark, documents(spark, rows), "")
    assert sorted(found(kept)) == [rows[i] for i in sorted(set(label))]
    assert len(set(label)) == 12


def test_secrets_are_masked_and_counted(spark):
    texts = [f"{t} api_key = Abcdef12345{i} and AKIAABCDEFGHIJKLMN{i:02d} end" for i, t in enumerate(TEXTS)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(99, TEXTS[0], None), (None, None, None)]
    masked = stage("secret_scans")(spark, documents(spark, rows), "")
    plain = lambda t: t and re.sub(r"AKIA[A-Z0-9]{16,}", "[SECRET]", re.sub(r"api_key = [A-Za-z0-9]+", "[SECRET]", t))
    assert sorted(found(masked), key=repr) == sorted([(i, plain(t), s) for i, t, s in rows], key=repr)
    for r in masked.collect():
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"])) and tuple(r)[5:] == EXTRA


def test_documents_come_as_often_as_the_mix_takes_them(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "abc"[i % 3] if i % 4 else None) for i in range(200)]
    docs = documents(spark, rows)
    mixed = stage("source_mixing")(spark, docs, "")
    assert mixed.columns == docs.columns
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs).collect()}
    want = collections.Counter({row: taken[row[0]] for row in rows if taken[row[0]]})
    assert collections.Counter(found(mixed)) == want
    assert len(set(taken.values())) > 2


def test_packing_holds_every_row(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "s"), (None, None, None)]
    packed = stage("best_fit_packing")(spark, documents(spark, rows), "").collect()
    want = []
    for i, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((i, 0, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_tables_pass_through(spark, name):
    empty = documents(spark, []).limit(0)
    assert stage(name)(spark, empty, "").count() == 0


def test_the_whole_pipeline_applies_its_stages(spark, tmp_path):
    near = [t + " more" for t in TEXTS[:6]]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(TEXTS + near + ["short", "junk " * 200])]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} <= set(range(12)) and packed
    by_sequence = collections.defaultdict(list)
    for r in packed:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
