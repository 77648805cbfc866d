"""Terms of many texts: runs of some bytes, with A-Z lower-cased.

All bytes from 0x80 on belong to terms, so a run of bytes is a run of
characters and every term is valid UTF-8.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa

from martlet.llm._words import pieces

#: Bytes of a text that are cut into terms at a time.
SLICE = 1 << 20


def table(others: str = "") -> bytes:
    """For ``bytes.translate``: letters (A-Z lower-cased), ``others`` and all non-ASCII bytes stay, the rest are blanks."""
    stay = set((string.ascii_letters + others).encode()) | set(range(128, 256))
    return bytes(ord(chr(b).lower()) if b < 128 and b in stay else b if b in stay else 32 for b in range(256))


def terms(data: bytes, keep: bytes) -> Iterator[list[bytes]]:
    """The terms of one text with repeats, in lists of about ``SLICE`` bytes."""
    begun: list[bytes] = []  # a term that goes on in the next slice
    for i in range(0, len(data), SLICE):
        part = data[i : i + SLICE].translate(keep)
        cut = part.rfind(b" ")
        if cut < 0:
            begun.append(part)
            continue
        yield b"".join([*begun, part[:cut]]).split()
        begun = [part[cut + 1 :]]
    yield b"".join(begun).split()


def rows(batches, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Bounded slices of Arrow batches, each with the bytes of its texts."""
    for batch in batches:
        for part in pieces(batch, column, 1 << 20):
            yield part, part.column(column).cast(pa.binary()).to_pylist()
