"""Benchmark decontamination: find benchmark passages in texts, edits allowed.

Method: q-gram lemma filtering. A benchmark text is cut into overlapping
windows of ``WINDOW`` characters. Where a window of m characters occurs with
at most e edits, it shares at least m + 1 - Q (e + 1) q-grams with the text,
and all of them lie on diagonals (text position - window position) at most
2e apart. Shared q-grams are counted in overlapping diagonal bands, bands
that reach the bound stay, and a banded alignment gives the real edit
distance of the window to the text there.

Both sides are compared in lower case with each run of white space as one
space. Benchmark texts of under ``SHORTEST`` characters are searched without
edits: from Q characters on by their q-grams, shorter ones as exact stretches
that do not begin or end inside a word (characters of scripts without spaces
are words of their own). The benchmark is sent to the tasks in blocks of at
most ``BLOCK_CHARS`` characters, with one pass over the texts for each block;
the texts are never shuffled.

Cases: null and empty texts and benchmark texts match nothing; a benchmark
text without an item_id has no key to report and is left out (the pipeline
gives it one); repeated rows are judged alike; with an empty table on either
side there is no match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm import _words as w
from martlet.llm._common import ship

Q, WINDOW, STRIDE, SHORTEST = 10, 60, 30, 30
#: Edits allowed for each so many characters of a window.
PER_EDIT = 20
BLOCK_CHARS = 16 << 20
#: Bytes of text that a task searches at a time; its arrays take about 45 times as much.
SLICE = 1 << 19
BASE = 0x9E3779B97F4A7C15
MAP_BITS = 22
U = np.uint64


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    return w.gram_hashes(w.mix(chars.astype(U) * w.MUL + U(1)), q, BASE)


def allowed(size):
    """Edits allowed in a window of ``size`` characters."""
    return size // PER_EDIT * (size >= SHORTEST)


def _joins(char: int) -> bool:
    """Whether a character can be part of a longer word."""
    spaceless = 0x0E00 <= char < 0x0F00 or 0x1000 <= char < 0x10A0 or 0x1780 <= char < 0x1800 or 0x3040 <= char < 0x3100 \
        or 0x3400 <= char < 0xA000 or 0xF900 <= char < 0xFB00 or 0x20000 <= char < 0x33480
    return not spaceless and (chr(char).isalnum() or char == ord("_"))


class Windows:
    """The windows of some benchmark texts and an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, self.text = [], []
        tiny: dict[int, list] = {}
        for item, text in items:
            t = normal(text).replace("\0", " ").strip()
            if item is None or not t:
                continue
            if len(t) < Q:
                tiny.setdefault(len(t), []).append((item, codes(t)))
                continue
            last = max(0, len(t) - WINDOW)
            for a in sorted({*range(0, last, STRIDE), last}):
                self.item.append(item)
                self.text.append(codes(t[a : a + WINDOW]))
        self.item = np.array(self.item, np.int64)
        self.size = np.array([len(t) for t in self.text], np.int64)
        self.edits = allowed(self.size)
        self.need = self.size + 1 - Q * (self.edits + 1)
        found = [grams(t) for t in self.text]
        gram = np.concatenate(found) if found else np.zeros(0, U)
        of = np.repeat(np.arange(len(found)), [len(g) for g in found])
        at = np.concatenate([np.arange(len(g)) for g in found]) if found else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        self.of, self.at = of[order], at[order]
        self.gram, self.first = np.unique(gram[order], return_index=True)
        self.first = np.append(self.first, len(gram))
        self.map = np.zeros(1 << MAP_BITS, bool)
        self.map[self.gram >> U(64 - MAP_BITS)] = True
        self.tiny = {}
        for m, some in tiny.items():
            code = np.concatenate([grams(t, m) for _, t in some])
            order = np.argsort(code, kind="stable")
            self.tiny[m] = code[order], [some[k] for k in order]

    def stretches(self, chars: np.ndarray):
        """(item, last position) of the texts of under Q characters."""
        out = []
        for m, (code, some) in self.tiny.items():
            g = grams(chars, m)
            first = np.searchsorted(code, g)
            for p in np.flatnonzero(code[np.minimum(first, len(code) - 1)] == g).tolist():
                end = p + m
                if p and _joins(int(chars[p - 1])) and _joins(int(chars[p])):
                    continue
                if end < len(chars) and _joins(int(chars[end - 1])) and _joins(int(chars[end])):
                    continue
                k = int(first[p])
                while k < len(code) and code[k] == g[p]:
                    if np.array_equal(some[k][1], chars[p:end]):
                        out.append((some[k][0], end - 1))
                    k += 1
        return out

    def hits(self, chars: np.ndarray):
        """(window, diagonal) of every q-gram shared with ``chars``."""
        g = grams(chars)
        pos = np.flatnonzero(self.map[g >> U(64 - MAP_BITS)])
        i = np.minimum(np.searchsorted(self.gram, g[pos]), len(self.gram) - 1)
        real = self.gram[i] == g[pos]
        pos, i = pos[real], i[real]
        n = self.first[i + 1] - self.first[i]
        total = np.cumsum(n)
        j = np.arange(total[-1] if len(n) else 0) - np.repeat(total - n, n) + np.repeat(self.first[i], n)
        return self.of[j], np.repeat(pos, n) - self.at[j]

    def regions(self, chars: np.ndarray):
        """(window, first diagonal, width) of the bands that reach the lemma's bound."""
        win, diagonal = self.hits(chars)
        step = 2 * self.edits[win] + 1  # a band is two steps wide; a neighbour starts at each step
        band = (diagonal + WINDOW) // step
        win2, band2 = np.concatenate([win, win]), np.concatenate([band, band - 1])
        key, count = np.unique(win2 * (1 << 40) + band2 + 1, return_counts=True)
        win2, band2 = key >> 40, (key & ((1 << 40) - 1)) - 1
        keep = count >= self.need[win2]
        win2, band2 = win2[keep], band2[keep]
        step = 2 * self.edits[win2] + 1
        return win2, band2 * step - WINDOW, 2 * step

    def matches(self, chars: np.ndarray, row_of: np.ndarray):
        """(row, item, position, edits) of the verified regions; ``row_of`` maps a position to its text."""
        exact = np.array(self.stretches(chars), np.int64).reshape(-1, 2)
        out = [[row_of[exact[:, 1]]], [exact[:, 0]], [exact[:, 1]], [np.zeros(len(exact), np.int64)]]
        if not len(self.gram) or len(chars) < Q:
            return [x[0] for x in out]
        win, low, width = self.regions(chars)
        for m in np.unique(self.size[win]):
            group = np.flatnonzero(self.size[win] == m)
            for a in range(0, len(group), 4096):
                part = group[a : a + 4096]
                v = win[part]
                e = int(allowed(m))
                cols = int(m) + 2 * (2 * e + 1) + 2 * e
                at = low[part] - e
                place = at[:, None] + np.arange(cols)
                region = np.where((place >= 0) & (place < len(chars)), chars[np.clip(place, 0, len(chars) - 1)], 0)
                pattern = np.stack([self.text[k] for k in v])
                least, end = align(pattern, region)
                good = least <= e
                where = np.clip(at[good] + end[good], 0, len(chars) - 1)
                for o, x in zip(out, (row_of[where], self.item[v[good]], where, least[good]), strict=True):
                    o.append(x)
        return [np.concatenate(o) for o in out]


def align(pattern: np.ndarray, region: np.ndarray):
    """Least edit distance of each pattern to any stretch of its region, and
    the last position of that stretch; all pairs at once, row by row. Code 0
    separates texts and equals nothing."""
    n, cols = region.shape
    ramp = np.arange(cols + 1)
    row = np.zeros((n, cols + 1), np.int64)
    for i in range(pattern.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + (region != pattern[:, i : i + 1]) + 4096 * (region == 0), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - ramp, axis=1) + ramp
    end = row.argmin(1)
    return row[np.arange(n), end], np.maximum(end - 1, 0)


def _search(block):
    def run(batches):
        windows = block.value
        for batch in batches:
            for part in w.pieces(batch, "text", SLICE):
                texts = [normal(t) for t in part.column("text").to_pylist()]
                chars = codes("\0".join(t.replace("\0", " ") for t in texts))
                size = np.array([len(t) for t in texts])
                row_of = np.repeat(np.arange(len(texts)), size + 1)[: len(chars)]
                row, item, at, edits = windows.matches(chars, row_of)
                start = np.concatenate([[0], np.cumsum(size + 1)])
                found: dict[tuple[int, int], list] = {}
                for r, k, p, e in zip(row.tolist(), item.tolist(), at.tolist(), edits.tolist(), strict=True):
                    found.setdefault((r, k), []).append((p - int(start[r]), e))
                keys = sorted(found)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").take(pa.array([r for r, _ in keys], pa.int64())),
                    "item_id": pa.array([k for _, k in keys], pa.int64()),
                    "ends": pa.array([sorted({p for p, _ in found[x]}) for x in keys], pa.list_(pa.int64())),
                    "min_edits": pa.array([min(e for _, e in found[x]) for x in keys], pa.int64()),
                })

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark text found in it: doc_id,
    item_id, ``ends`` (last characters of the matches in the normal form of
    the text) and ``min_edits``. Documents without a match have no row."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("long"), "text").distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = int(chars // BLOCK_CHARS) + 1
    out = None
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(Windows([(r.item_id, r.text) for r in rows]))
        part = docs.select("doc_id", "text").mapInArrow(_search(sent), "doc_id long, item_id long, ends array<long>, min_edits long")
        out = part if out is None else out.unionByName(part)
    return out.distinct()
