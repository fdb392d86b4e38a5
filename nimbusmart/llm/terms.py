"""Terms of a text: runs of digits, letters A-Z (lower-cased) and everything
beyond ASCII. On UTF-8 that is a table from byte to byte and a split at spaces."""

from __future__ import annotations

from collections.abc import Iterator

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
TABLE = bytes(
    b if b >= 0x80 or b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
SLICE_BYTES = 1 << 20


def term_slices(text: str | None) -> Iterator[list[bytes]]:
    """The terms in order, in lists of about a megabyte of text, so that a very
    long text never stands as one list of all its terms."""
    data = (text or "").encode().translate(TABLE)
    if len(data) <= SLICE_BYTES:
        yield data.split()
        return
    lo = 0
    while lo < len(data):
        hi = data.find(b" ", min(lo + SLICE_BYTES, len(data)))
        hi = len(data) if hi < 0 else hi
        yield data[lo:hi].split()
        lo = hi


def terms(text: str | None) -> list[bytes]:
    return [t for part in term_slices(text) for t in part]
