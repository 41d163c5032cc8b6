"""Streaming word splitting for texts of any length (used inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

#: Code points that are split at a time.
SLICE = 1 << 20
_SPACE = frozenset(b" \t\n\x0b\x0c\r")


def word_slices(text: str | None, lower: bool = True) -> Iterator[list[bytes]]:
    """The white-space separated words (UTF-8), slice by slice; no word is cut.  ``lower`` maps A-Z to a-z."""
    rest = b""
    for i in range(0, len(text or ""), SLICE):
        raw = rest + text[i:i + SLICE].encode("utf-8", "surrogatepass")
        if lower:
            raw = raw.lower()
        words = raw.split()
        rest = b""
        if words and raw[-1] not in _SPACE and i + SLICE < len(text):
            rest = words.pop()
        if words:
            yield words
    if rest:
        yield [rest]
