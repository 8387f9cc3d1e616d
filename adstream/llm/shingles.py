"""Sets of hashed word shingles, made inside tasks with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


# About as many bytes are hashed at once; a longer text is cut between words.
_PIECE = 1 << 20
_BASE = 0x9FB21C651E98DF25
_BYTES = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


# A number for each byte, in lower case (A-Z only).
_BYTE_VALUES = _mixed((_LOWER.astype(np.uint64) + np.uint64(1)) * _FACTOR)


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, _PIECE + 1)
            self.up, self.down = (
                np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, base, np.uint64))))
                for base in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each run of anything but ASCII white space.

    The hash of a word is a polynomial in its bytes, the difference of two running sums
    that is shifted to where the word begins, and then mixed with its length.
    """
    data = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:-1], out=sums[1:])
    words = (sums[ends] - sums[starts]) * down[starts]
    return _mixed(words + (ends - starts).astype(np.uint64) * _FACTOR), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space, whatever the length of its words."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def _in_groups(documents: list[bytes | None]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """(hashes of words, how many each text has) of some texts at a time."""
    group, size = [], 0

    def hashed() -> tuple[np.ndarray, list[int]]:
        words, starts = _word_hashes(b"\n".join(group))
        offsets = np.cumsum([0] + [len(t) + 1 for t in group])
        return words, np.diff(np.searchsorted(starts, offsets)).tolist()

    for document in documents:
        text = document or b""
        if group and size + len(text) > _PIECE:
            yield hashed()
            group, size = [], 0
        if len(text) > _PIECE:
            words = np.concatenate([_word_hashes(piece)[0] for piece in _pieces(text)])
            yield words, [len(words)]
        else:
            group.append(text)
            size += len(text) + 1
    if group:
        yield hashed()


def _shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, or for the whole sequence if it is shorter."""
    used = min(width, len(words))
    total = words[: len(words) - used + 1] * _FACTOR ** np.uint64(0)
    for i in range(1, used):
        total = total + words[i : len(words) - used + 1 + i] * _FACTOR ** np.uint64(i)
    return _mixed(total ^ np.uint64(used))


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """As ``numpy.unique``, which takes longer for short arrays."""
    found = np.sort(hashes)
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def term_sets(documents: list[bytes | None]) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's words, in lower case (A-Z only)."""
    for words, counts in _in_groups(documents):
        at = 0
        for n in counts:
            yield _distinct(words[at : at + n])
            at += n


def shingle_sets(documents: list[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in lower case (A-Z only).

    A text with fewer words than ``width`` has its whole sequence as its one
    shingle; one without words, or NULL, has none.
    """
    for words, counts in _in_groups(documents):
        # Those that span two texts are made too, and left out.
        runs = _shingles(words, width) if len(words) >= width else np.empty(0, np.uint64)
        at = 0
        for n in counts:
            if n >= width:
                yield _distinct(runs[at : at + n - width + 1])
            else:
                yield _shingles(words[at : at + n], width) if n else np.empty(0, np.uint64)
            at += n
