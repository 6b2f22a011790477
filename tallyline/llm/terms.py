"""Terms of whole texts, as bytes: runs of ASCII letters (and digits, where wanted) and all other characters."""

from __future__ import annotations

from string import ascii_letters, digits


def term_table(with_digits: bool) -> bytes:
    """For ``bytes.translate``: A-Z lower-cased, every ASCII character that is no part of a term a space."""
    inside = set((ascii_letters + (digits if with_digits else "")).encode())
    return bytes(b if b >= 0x80 or b in inside else 0x20 for b in range(256)).lower()


def terms(text: bytes, table: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order. What is left between them is spaces only."""
    return text.translate(table).split()
