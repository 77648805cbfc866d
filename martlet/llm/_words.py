r"""Words and hashes of many texts at once, with numpy.

A *word* is a maximal run of bytes outside ``\x20\x09-\x0d``; on UTF-8 text
that is the regular expression ``[^\x20\x09-\x0D]+`` on characters. Hashes
are 64-bit, depend on content alone and are the same in every process.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute

U = np.uint64
MUL = U(0x9E3779B97F4A7C15)
WORD_BASE = 0xD6E8FEB86659FD93
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at a time; the arrays of one block stay in the CPU's cache.
BLOCK = 1 << 18
#: Bytes of a word that is hashed on its own.
LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, element by element."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODE = mix((np.arange(256, dtype=U) + U(1)) * MUL)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    p = np.full(n, U(base), U)
    p[:1] = U(1)
    return np.cumprod(p, dtype=U)


_POW = powers(WORD_BASE, BLOCK + 1)
_INV = powers(pow(WORD_BASE, -1, 1 << 64), BLOCK + 1)


def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("").cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the row it belongs to."""
    inside = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(buf), bool)
    after = np.empty(len(buf), bool)
    if len(buf):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word's bytes, mixed with its length; words of
    over ``LONG`` bytes, for which different words with equal polynomials
    modulo 2**64 are known, get their BLAKE2b hash."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + BLOCK, side="right"))
        if j <= i:  # one word longer than a block
            i += 1
            continue
        part = buf[base : int(ends[j - 1])]
        total = np.zeros(len(part) + 1, U)
        np.cumsum(BYTE_CODE[part] * _POW[: len(part)], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * _INV[s]
        i = j
    out = mix(out + (ends - starts).astype(U) * MUL)
    for k in np.flatnonzero(ends - starts > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(buf[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return out


def gram_hashes(words: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of the k words from each position on (``len(words) - k + 1`` of them)."""
    n = len(words)
    if n < k:
        return np.zeros(0, U)
    total = np.zeros(n + 1, U)
    np.cumsum(words * powers(base, n), out=total[1:])
    return mix((total[k:] - total[:-k]) * powers(pow(base, -1, 1 << 64), n - k + 1))


def within_rows(rows: np.ndarray, k: int) -> np.ndarray:
    """For each gram of ``gram_hashes``, whether all its words are of one row."""
    return rows[: len(rows) - k + 1] == rows[k - 1 :] if len(rows) >= k else np.zeros(0, bool)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """``batch`` in slices of at most ``limit`` bytes of text (or one row), to bound the memory of a task."""
    col = batch.column(column)
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
