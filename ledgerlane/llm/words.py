"""Words of whole texts, block by block."""

from __future__ import annotations

import re
from collections.abc import Iterator

BLOCK_BYTES = 1 << 20

#: Lower-cases A-Z and leaves every other byte as it is.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text; a null text is empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The maximal runs of ``[^\\x20\\x09-\\x0D]``, in blocks cut at white space, so that a long text is
    never split into words whole."""
    start = 0
    while start < len(data):
        cut = _SPACE.search(data, start + BLOCK_BYTES)
        end = cut.start() if cut else len(data)
        yield data[start:end].split()
        start = end
