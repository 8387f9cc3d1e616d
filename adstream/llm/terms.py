"""Terms of whole texts: lower-cased (A-Z only) runs of ASCII letters, digits and all beyond ASCII."""

from __future__ import annotations


def _byte_table() -> bytes:
    """Maps A-Z to a-z and every other separator to a space; UTF-8 bytes beyond ASCII stay."""
    kept = {*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)}
    capitals = range(ord("A"), ord("Z") + 1)
    return bytes(b if b in kept else b + 32 if b in capitals else 32 for b in range(256))


BYTE_TABLE = _byte_table()


def spaced(text: bytes | None) -> bytes:
    """The text with its terms in lower case and only spaces between them."""
    return text.translate(BYTE_TABLE) if text else b""
