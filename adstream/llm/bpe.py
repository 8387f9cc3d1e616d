"""BPE encoding by a transducer with bounded lookahead, and incremental decoding."""

from __future__ import annotations

import codecs
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.workercache import worker_cached

# Words up to this many bytes are remembered, so the number bounds the bytes kept: when a table
# is full it becomes the older one, and what is used again moves on to the new one.
_CACHED_BYTES = 64
_CACHED_WORDS = 200_000
# Letters that a transducer gathers beyond its lookahead before it merges them.
_BLOCK_LETTERS = 4096
# A text without white space is prepared in runs of about this many characters.
_RUN = 1 << 16
_BATCH_BYTES = 8 << 20
_DECODED_AT_ONCE = 1 << 15
# Up to here letters are Latin and composed: normalising only makes them lower case.
_LATIN_END = "\u0250"
# Marks that are always split from letters before them.
_MARKS = ".,;:!?%*&$#|"

# Places where a run without white space can be cut, with no effect on normalising or
# splitting it: inside letters (or marks) after four of their kind, or next to a digit.
# The next character is one that never composes with what is before it, and never
# begins a contraction or a special token.
_IDEOGRAPH = "一-龥"
_CUT = re.compile(
    rf"(?<=[A-Za-z]{{4}})(?=[A-Za-z])|(?<=[{_IDEOGRAPH}]{{4}})(?=[{_IDEOGRAPH}])"
    r"|(?<=[=#*+/.~_-]{4})(?=[=#*+/.~_-])|(?<=[0-9])(?=[0-9A-Za-z])|(?<=[A-Za-z])(?=[0-9])"
)


def public_tokenizer() -> str:
    """Place of the public word-level BPE vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int | None:
    """How many letters behind a token must be known for it to stay, whatever follows.

    Merges apply in order of rank, so a decision travels leftwards only through merges
    of rising rank that touch each other. For each merge (u, v) this adds up, in order of
    rank, how far behind its end that chain can begin: where v (or u) was itself made,
    where v could have gone into an earlier merge to its right, and where u could have
    gone into one to its left. A finished token waits for every merge that could take it.

    None if the list is not proper: a part that no earlier merge makes, or a token made
    twice. Then a pre-token is merged whole.
    """
    made: dict[str, int] = {}
    width: dict[str, int] = {}
    # Of the merges so far that take a token on their left (right) side: how far behind
    # that token's end they have to look.
    taken_left: dict[str, int] = {}
    taken_right: dict[str, int] = {}
    for u, v in merges:
        for part in (u, v):
            if part not in width:
                if len(part.removesuffix(suffix) if suffix else part) > 1:
                    return None
                width[part] = 1
        # The first part keeps its own suffix only in a broken list.
        if u + v in made or (suffix and u.endswith(suffix) and len(u) > len(suffix)):
            return None
        behind_v = width[v]
        look = max(
            0,
            made.get(v, 0),
            made.get(u, 0) - behind_v,
            taken_left.get(v, 0),
            taken_right.get(u, 0) - behind_v,
        )
        made[u + v], width[u + v] = look, width[u] + behind_v
        taken_left[u] = max(taken_left.get(u, 0), behind_v + look)
        taken_right[v] = max(taken_right.get(v, 0), look)
    return max(0, *made.values(), *taken_left.values()) if made else 0


class Transducer:
    """Ids of one pre-token, fed in parts; a token comes out once nothing behind it can change it.

    ``merge`` gives the tokens of a string of letters as if a pre-token ended there. Up
    to ``block`` letters and the lookahead are held, however long the pre-token.
    """

    def __init__(self, merge: Callable, lookahead: int | None, block: int = _BLOCK_LETTERS):
        self.merge, self.lookahead, self.block = merge, lookahead, block
        self.open = ""

    def feed(self, letters: str) -> Iterator[int]:
        if self.lookahead is None:
            self.open += letters
            return
        step = self.block
        for at in range(0, len(letters), step):
            self.open += letters[at : at + step]
            if len(self.open) > step + self.lookahead:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        # The last letter is merged as a last one, which it need not be.
        known = len(self.open) - 1 - self.lookahead
        done = 0
        for token in self.merge(self.open):
            if done + len(token.value) > known:
                break
            done += len(token.value)
            yield token.id
        self.open = self.open[done:]

    def end(self) -> Iterator[int]:
        if self.open:
            yield from (token.id for token in self.merge(self.open))
        self.open = ""


class Encoder:
    """Texts as ids of a byte-level BPE file of the tokenizers library, special tokens included.

    Words between ASCII white space are independent of each other, as the file drops
    white space; other files are encoded by the library.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        self.lookahead = sufficient_lookahead(pairs, model.get("end_of_word_suffix") or "")
        self.splits_words = _drops_white_space(spec)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.marks = [c.encode() for c in self.special]
        strings = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile(f"({'|'.join(map(re.escape, strings))})") if strings else None
        self.words, self.older_words = {}, {}
        self.letters, self.older_letters = {}, {}
        self.byte_letters = _byte_letters()

    def ids(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not self.splits_words:
            return _packed(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)
        if any(mark in text for mark in self.marks):
            parts = self.special_pattern.split(text.decode())
            return b"".join(
                _packed([self.special[part]]) if i % 2 else self._plain(part.encode()) for i, part in enumerate(parts)
            )
        return self._plain(text)

    def _plain(self, text: bytes) -> bytes:
        # bytes.split knows ASCII white space only, all of which the file drops.
        known = self.words
        return b"".join([known.get(word) or self._word(word) for word in text.split()])

    def _word(self, word: bytes) -> bytes:
        if value := self.words.get(word) or self.older_words.get(word):
            self.words[word] = value
            return value
        text = word.decode()
        if len(word) > _CACHED_BYTES:
            return _packed(self._stream(text))
        # Words differ in capitals and in marks at their end more than in their letters.
        stem = text.rstrip(_MARKS)
        marks = text[len(stem) :].encode()
        if stem.isalpha() and (stem.isascii() or max(stem) < _LATIN_END):
            value = self._lower(stem.lower()) + (self.words.get(marks) or self._word(marks) if marks else b"")
        else:
            value = _packed(self._stream(text))
        if len(self.words) >= _CACHED_WORDS:
            self.words, self.older_words = {}, self.words
        self.words[word] = value
        return value

    def _lower(self, letters: str) -> bytes:
        known = self.letters.get(letters) or self.older_letters.get(letters)
        if known is None:
            if not letters.isalpha():  # a capital that becomes a letter and a mark
                known = _packed(self._stream(letters))
            else:
                spelled = letters
                if not letters.isascii():
                    spelled = letters.encode().decode("latin-1").translate(self.byte_letters)
                # A pre-token that fits a block is merged when it ends.
                known = _packed([token.id for token in self.tokenizer.model.tokenize(spelled)])
        if len(self.letters) >= _CACHED_WORDS:
            self.letters, self.older_letters = {}, self.letters
        self.letters[letters] = known
        return known

    def _stream(self, text: str) -> Iterator[int]:
        """Prepares a text without white space run by run and streams its pre-tokens."""
        transducer = Transducer(self.tokenizer.model.tokenize, self.lookahead)
        for run, goes_on in _runs(text):
            normal = self.tokenizer.normalizer.normalize_str(run)
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            for k, (letters, _) in enumerate(pieces):
                if k:
                    yield from transducer.end()
                yield from transducer.feed(letters)
            if not goes_on:
                yield from transducer.end()
        yield from transducer.end()


def _runs(text: str) -> Iterator[tuple[str, bool]]:
    """(run, whether its last pre-token goes on in the next run)."""
    at = 0
    while len(text) - at > _RUN:
        cut = _CUT.search(text, at + _RUN)
        if not cut:
            break
        end = cut.start()
        yield text[at:end], not (text[end - 1].isdigit() or text[end].isdigit())
        at = end
    yield text[at:], False


def _drops_white_space(spec: dict) -> bool:
    """True for files that split at white space and keep none of it, so that words are independent."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = steps[0] if steps else {}
    return (
        spec["model"].get("type") == "BPE"
        and split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and bool(split.get("invert"))
        and split["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


def _packed(ids) -> bytes:
    return array("I", ids).tobytes()


class Decoder:
    """Text of ids, fed in parts: a state machine from bytes to text.

    Between parts it keeps the bytes of an unfinished character, at most three, and
    whether a token has come yet. A file with a byte-level decoder joins the bytes of its
    tokens, where broken characters become U+FFFD; one without a decoder has its tokens
    joined as they are written, by spaces.
    """

    def __init__(self, table: list[bytes], separator: bytes):
        self.table, self.separator = table, separator
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        found = self.separator.join(map(self.table.__getitem__, ids))
        if self.begun:
            found = self.separator + found
        self.begun = True
        return self.state.decode(found)

    def end(self) -> str:
        return self.state.decode(b"", True)


def decoding_table(file: str) -> tuple[list[bytes], bytes]:
    """The bytes of every id, and what stands between two tokens."""
    with open(file, encoding="utf-8") as source:
        spec = json.load(source)
    written = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
    kind = (spec.get("decoder") or {}).get("type")
    if kind not in (None, "ByteLevel"):
        raise ValueError(f"decoder {kind} is not known")
    table = [b""] * (max(written.values()) + 1)
    values = {letter: byte for byte, letter in _byte_letters().items()}
    for token, i in written.items():
        spelled = kind == "ByteLevel" and all(c in values for c in token)
        table[i] = bytes(values[c] for c in token) if spelled else token.encode()
    return table, b"" if kind else b" "


def _batches(rows: Iterator[tuple], columns: list, types: list, names: list) -> Iterator[pa.RecordBatch]:
    """Batches of about equal size from (size, values) and the kept columns of one batch."""
    held, size, start = [], 0, 0

    def batch() -> pa.RecordBatch:
        made = [pa.array(c, t) for c, t in zip(list(zip(*held)) or [()] * len(types), types)]
        return pa.record_batch([*made, *(c.slice(start, len(held)) for c in columns)], names=names)

    for row_size, values in rows:
        held.append(values)
        size += row_size
        if size > _BATCH_BYTES:
            yield batch()
            start, held, size = start + len(held), [], 0
    if held:
        yield batch()


def _encode(path: str | None, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or public_tokenizer()
        encoder = worker_cached(("encoder", file), lambda: Encoder(file))
        for batch in batches:

            def rows(texts=batch.column(0).cast(pa.binary())):
                for text in texts:
                    ids = encoder.ids(text.as_py() or b"")
                    yield len(ids), (len(ids) // 4, ids)

            yield from _batches(rows(), batch.columns[1:], [pa.int64(), pa.binary()], names)

    return run


def _decode(path: str | None, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or public_tokenizer()
        table = worker_cached(("decoding table", file), lambda: decoding_table(file))
        for batch in batches:

            def rows(column=batch.column(0)):
                for packed in column:
                    text = _text(table, packed.as_py() or b"")
                    yield len(text), (text,)

            yield from _batches(rows(), batch.columns[1:], [pa.string()], names)

    return run


def _text(table: tuple[list[bytes], bytes], packed: bytes) -> str:
    ids = np.frombuffer(packed, "<u4")
    decoder = Decoder(*table)
    parts = [decoder.feed(ids[at : at + _DECODED_AT_ONCE].tolist()) for at in range(0, len(ids), _DECODED_AT_ONCE)]
    return "".join([*parts, decoder.end()])


def _round_trip(path: str | None, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or public_tokenizer()
        encoder = worker_cached(("encoder", file), lambda: Encoder(file))
        table = worker_cached(("decoding table", file), lambda: decoding_table(file))
        for batch in batches:

            def rows(texts=batch.column(0).cast(pa.binary())):
                for text in texts:
                    ids = encoder.ids(text.as_py() or b"")
                    decoded = _text(table, ids)
                    yield len(ids) + len(decoded), (len(ids) // 4, ids, decoded)

            yield from _batches(rows(), batch.columns[1:], [pa.int64(), pa.binary(), pa.string()], names)

    return run


def _mapped(rows: DataFrame, work: Callable, new: list[tuple[str, str]], path: str | None) -> DataFrame:
    """``work`` on the first column, whose place the new ones (name, type) take; the others stay, whatever their names."""
    kept = [(f"_{i}", f.dataType.simpleString()) for i, f in enumerate(rows.schema.fields[1:])]
    columns = [(f"_new{i}", kind) for i, (_, kind) in enumerate(new)] + kept
    schema = ", ".join(f"{name} {kind}" for name, kind in columns)
    plain = rows.toDF("_text", *(name for name, _ in kept))
    made = plain.mapInArrow(work(path, [name for name, _ in columns]), schema)
    found = made.toDF(*(name for name, _ in new), *rows.columns[1:])
    return found.select(*rows.columns[1:], *(name for name, _ in new))


def encode_texts(
    docs: DataFrame, text_col: str = "text", columns: list[str] | None = None, tokenizer_path: str | None = None
) -> DataFrame:
    """Adds ``n_tokens`` and ``ids`` to every row of ``docs`` (or to ``columns`` of it).

    ``ids`` is binary: little-endian unsigned 32-bit ids of the whole text, as the tokenizers
    library gives them with add_special_tokens=False and neither truncation nor padding;
    special tokens written in the text are special tokens. A NULL or empty text has no
    ids; repeated rows are encoded each; other columns stay, but those named like the new
    ones give way; an empty table gives an empty one. The tokenizer file (default: the
    public one) must be on every executor.

    No row leaves its task. Short words are remembered within a bound; longer ones are
    streamed through a transducer that holds as many letters as the merge list's
    lookahead asks for, so memory does not grow with a word's length.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("n_tokens", "ids")]
    rows = docs.select(F.col(text_col).cast("string"), *columns)
    return _mapped(rows, _encode, [("n_tokens", "long"), ("ids", "binary")], tokenizer_path)


def decode_ids(
    encoded: DataFrame, ids_col: str = "ids", columns: list[str] | None = None, tokenizer_path: str | None = None
) -> DataFrame:
    """Adds ``decoded``, the text of the ids as the library's decode without skipping special tokens.

    NULL or no ids give an empty text; other columns stay, but one named ``decoded`` gives way.
    """
    columns = [c for c in (encoded.columns if columns is None else columns) if c != "decoded"]
    rows = encoded.select(F.col(ids_col), *columns)
    return _mapped(rows, _decode, [("decoded", "string")], tokenizer_path)


def round_trip_texts(
    docs: DataFrame, text_col: str = "text", columns: list[str] | None = None, tokenizer_path: str | None = None
) -> DataFrame:
    """Adds ``n_tokens``, ``ids`` and ``decoded`` as ``decode_ids`` does after ``encode_texts``.

    Each text is decoded where it was encoded. A task then has one Python worker, and one
    batch of rows, in place of two of each, and the ids need no way between them.
    """
    new = [("n_tokens", "long"), ("ids", "binary"), ("decoded", "string")]
    columns = [c for c in (docs.columns if columns is None else columns) if c not in dict(new)]
    rows = docs.select(F.col(text_col).cast("string"), *columns)
    return _mapped(rows, _round_trip, new, tokenizer_path)
