"""Words of ASCII letters, digits and anything beyond ASCII, with A-Z in lower case."""

from __future__ import annotations

import re

# Bytes that are no ASCII letter or digit part words; those from 128 on belong to one.
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def word_bytes(text: str | None) -> list[bytes]:
    """The words as UTF-8."""
    return (text or "").encode().translate(TABLE).split()


def word_spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each word in the text, in code points."""
    return [m.span() for m in WORD.finditer(text)]
