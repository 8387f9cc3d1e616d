"""BPE encoding and decoding against the tokenizers library itself."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from adstream.llm import bpe, queries

SPECIAL = [
    "a <|endoftext|> b",
    "<|endoftext|>",
    "<|startoftext|><|endoftext|><|endoftext|>x",
    "in<|startoftext|>side",
    "<|ENDOFTEXT|> <|endof text|> <|endoftext|",
]
TEXTS = [
    *SPECIAL,
    "İstanbul Straße ÀÉÎ don't. it's x1y2 a.b... ŒUVRE Ως ΩΣ 中文。 ét́ \x1c\x85 x ﻿​'S'll ŉ ǅ",
    "'s ab'real é ́a x\ńy don't we'll  tabs\t\tand\x0bmore\r\n",
    "🙂🙃 👩‍👩‍👧 naïve—dash …",
    "The quick brown fox, and so on. " * 50,
    "",
    None,
    " \n\t ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.public_tokenizer())


def numbers(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_and_texts_equal_the_library(spark, library):
    schema = "doc_id long, text string, ids string, n_tokens long, decoded string, _body int, _packed int"
    rows = [(i, t, "x", 1, "y", 2, 3) for i, t in enumerate(TEXTS)] + [(None, "again <|endoftext|>", None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, schema)
    got = bpe.decode_ids(bpe.encode_texts(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert numbers(r["ids"]) == want and r["n_tokens"] == len(want)
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
        assert r["_body"] in (2, None) and r["_packed"] in (3, None)
    empty = bpe.decode_ids(bpe.encode_texts(docs.limit(0)))
    assert empty.count() == 0 and set(docs.columns) <= set(empty.columns)


def test_query_digests(spark):
    from adstream.llm.queries import op11_bpe_round_trip
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.public_tokenizer())
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op11_bpe_round_trip(spark, folder).collect()}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        r = got.pop(d["doc_id"])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert not got


def test_long_words_are_cut_and_streamed(library, monkeypatch):
    monkeypatch.setattr(bpe, "_RUN", 300)
    monkeypatch.setattr(bpe, "_BLOCK_LETTERS", 40)
    encoder = bpe.Encoder(bpe.public_tokenizer())
    draw = random.Random(5)
    alphabets = ["abcdefghijklmnopqrstuvwxyzABCD", "中文字国人一二", "=-#*.'<|", "0123456789abcXYZ'", "аяйбé́ñ", "aA", " a　'sre<|>=019中é"]
    for k in range(150):
        alphabet = alphabets[k % len(alphabets)]
        text = "".join(draw.choice(draw.choice(alphabets) if k % 2 else alphabet) for _ in range(2500))
        assert numbers(encoder.ids(text.encode())) == library.encode(text, add_special_tokens=False).ids
    word = "a" * 400_000 + "中" * 100_000
    assert numbers(encoder.ids(word.encode())) == library.encode(word, add_special_tokens=False).ids


def merge_whole(merges):
    """Applies each merge in order of rank, everywhere from the left: the definition."""

    class Token(str):
        value = property(str)
        id = property(str)

    def merge(letters):
        parts = list(letters)
        for u, v in merges:
            at = 0
            while at < len(parts) - 1:
                if parts[at] == u and parts[at + 1] == v:
                    parts[at : at + 2] = [u + v]
                at += 1
        return [Token(p) for p in parts]

    return merge


def test_lookahead_suffices_for_any_proper_list():
    draw = random.Random(7)
    longest = 0
    for _ in range(150):
        known, merges = list("abc"), []
        for _ in range(draw.randint(1, 14)):
            pair = (draw.choice(known), draw.choice(known))
            if "".join(pair) not in known:
                merges.append(pair)
                known.append("".join(pair))
        lookahead = bpe.sufficient_lookahead(merges)
        longest = max(longest, lookahead)
        merge = merge_whole(merges)
        for _ in range(12):
            word = "".join(draw.choice("abc" if draw.random() < 0.5 else "aab") for _ in range(draw.randint(1, 90)))
            transducer, held, got = bpe.Transducer(merge, lookahead, block=1), 0, []
            for letter in word:
                got += transducer.feed(letter)
                held = max(held, len(transducer.open))
            got += transducer.end()
            assert got == [str(t) for t in merge(word)]
            assert held <= 1 + lookahead + max(map(len, known)) + 1
    assert longest > 5


def test_improper_lists_have_no_lookahead():
    assert bpe.sufficient_lookahead([("ab", "c")]) is None
    assert bpe.sufficient_lookahead([("a", "b"), ("b", "c"), ("a", "bc"), ("ab", "c")]) is None
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([("a", "b</w>"), ("a", "b")], "</w>") == 1


def test_decoder_keeps_unfinished_characters():
    table, separator = bpe.decoding_table(bpe.public_tokenizer().replace("word_bpe_49k", "byte_bpe_50k"))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.public_tokenizer().replace("word_bpe_49k", "byte_bpe_50k"))
    for text in ["naïve 🙂🙃 中文 \x85 <|endoftext|> end", ""]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        # Also sequences that break characters.
        for some in (ids, ids[1::2], ids[::-1]):
            for step in (1, 3, 100):
                decoder = bpe.Decoder(table, separator)
                parts = [decoder.feed(some[i : i + step]) for i in range(0, len(some), step)]
                assert "".join([*parts, decoder.end()]) == tokenizer.decode(some, skip_special_tokens=False)


def test_other_files_are_encoded_by_the_library(spark):
    from tokenizers import Tokenizer

    file = bpe.public_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")
    tokenizer = Tokenizer.from_file(file)
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for r in bpe.decode_ids(bpe.encode_texts(docs, tokenizer_path=file), tokenizer_path=file).collect():
        want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert numbers(r["ids"]) == want and r["decoded"] == tokenizer.decode(want, skip_special_tokens=False)


def test_batches_split_by_size(spark, monkeypatch):
    monkeypatch.setattr(bpe, "_BATCH_BYTES", 40)
    work = bpe._encode(None, ["n_tokens", "ids", "key"])
    import pyarrow as pa

    texts = ["one two three four five six seven"] * 7 + [None, ""]
    batch = pa.record_batch([pa.array(texts), pa.array(range(9))], names=["t", "key"])
    out = list(work(iter([batch, batch.slice(0, 0)])))
    assert len(out) > 2 and list(itertools.chain(*(b.column(2).to_pylist() for b in out))) == list(range(9))


def test_a_round_trip_takes_one_worker_and_equals_both_ways(spark, tmp_path):
    rows = [(i, t, "kept") for i, t in enumerate(TEXTS * 2)] + [(None, TEXTS[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    got = bpe.round_trip_texts(docs)
    want = bpe.decode_ids(bpe.encode_texts(docs))
    assert got.columns == want.columns
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["text"])
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert bpe.round_trip_texts(docs.limit(0)).count() == 0
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    query = queries.op11_bpe_round_trip(spark, str(tmp_path))
    assert query._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
