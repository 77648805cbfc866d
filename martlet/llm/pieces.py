"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a slice are cut before each run of spaces into *units*; no
piece of the model crosses such a cut, so equal units are encoded once and a
task keeps those it has met with their ids, up to a bound. The new distinct
units are concatenated and a suffix array over them, each suffix up to the
end of its unit, is built by prefix doubling. Every piece is binary-searched
for the range of its occurrences; these are the edges (position, length,
piece), sorted by position. The edges are then relaxed in the order of the model: in each unit
the best-scored edge that joins two neighbouring symbols (the left one of
equals) replaces them, until none is left. That is the order of merges of a
BPE model, so ids are those of the library. A character without a piece
falls back to its bytes.

Decoding joins the pieces' bytes; the first space is the model's own.

Cases: a null text has null ids and decodes to null, an empty one has no
ids. U+2581 is the model's space and decodes as a space. Units of over
``LONG`` characters are relaxed with a heap, so one very long unit takes
n log n steps. Columns called ``token_ids``,
``decoded`` or (with ``verify``) ``round_trip`` are replaced. Ids of no piece
decode to nothing.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

from martlet.llm import _words as w
from martlet.llm._common import ship

LONG = 100
SPACE = "▁"
UNIT = re.compile("▁+[^▁]*|[^▁]+")
PACK = 5  # bytes of one key in base 257
#: Bytes of text a task takes at a time, and of the units it keeps.
SLICE, KNOWN = 1 << 20, 8 << 20


def load(path: str) -> list[tuple[int, bytes, float]]:
    """The pieces of a model that match text: (id, UTF-8, score), in order of ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    other = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return [(i, sp.id_to_piece(i).encode(), sp.get_score(i)) for i in range(sp.get_piece_size()) if not other(i)]


def byte_ids(path: str) -> list[int]:
    """The ids of the 256 bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def sorted_by(key: np.ndarray, most: int):
    """The order of non-negative keys of at most ``most``, and the keys in it.
    Where key and index fit one number, numpy sorts these numbers in place of indices."""
    n = len(key)
    bits = n.bit_length()
    if most < 1 << (63 - bits):
        both = np.sort((key << bits) | np.arange(n))
        return both & ((1 << bits) - 1), both >> bits
    order = np.argsort(key, kind="stable")
    return order, key[order]


def packed(buf: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position, the PACK bytes from there on as one number; 0 past the end of its unit, ``left`` bytes on."""
    n = len(buf)
    wide = np.concatenate([buf.astype(np.int64) + 1, np.zeros(PACK, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(PACK):
        key = key * 257 + wide[j : j + n] * (left > j)
    return key


def suffix_array(key: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` bytes from there on, up to the end of
    the unit, by prefix doubling; only those that still tie are sorted again."""
    n, have = len(key), PACK
    order, k = sorted_by(key, 257**PACK)
    slots, rank = np.arange(n), np.empty(n, np.int64)
    new = np.concatenate([[True], k[1:] != k[:-1]])
    rank[order] = np.maximum.accumulate(slots * new)
    while have < depth:
        tied = np.concatenate([~new[1:], [False]]) | ~new
        slots = slots[tied]
        slots = slots[left[order[slots]] >= have]
        if not len(slots):
            break
        at = order[slots]
        ahead = np.where(left[at] > have, rank[np.minimum(at + have, n - 1)] + 1, 0)
        by, k = sorted_by(rank[at] * (n + 1) + ahead, n * (n + 1))
        at = at[by]
        order[slots] = at
        new = np.concatenate([[True], k[1:] != k[:-1]])
        rank[at] = np.maximum.accumulate(slots * new)
        have *= 2
    return order


def _bound(key, left, order, shift, lo, hi, value, right):
    """Binary search of each value in its own range of suffixes, by the key ``shift`` bytes in."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        at = order[np.minimum(mid, len(order) - 1)]
        k = np.where(left[at] > shift, key[np.minimum(at + shift, len(key) - 1)], 0)
        go = open_ & ((k <= value) if right else (k < value))
        lo, hi = np.where(go, mid + 1, lo), np.where(open_ & ~go, mid, hi)


class Encoder:
    def __init__(self, pieces: list[tuple[int, bytes, float]], bytes_: list[int]):
        self.id = np.array([p[0] for p in pieces], np.int64)
        self.size = np.array([len(p[1]) for p in pieces], np.int64)
        self.score = np.array([p[2] for p in pieces], np.float64)
        self.bytes = np.array(bytes_, np.int64)
        self.known = pa.array([], pa.large_binary())
        self.ids, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.depth = int(self.size.max())
        self.columns = -(-self.depth // PACK)
        wide = np.array([p[1].ljust(self.columns * PACK, b"\0") for p in pieces], f"S{self.columns * PACK}").view(np.uint8)
        wide = wide.reshape(len(pieces), -1).astype(np.int64) + 1
        past = np.arange(self.columns * PACK) >= self.size[:, None]
        power = 257 ** np.arange(PACK - 1, -1, -1, dtype=np.int64)
        self.low, self.high = ((np.where(past, fill, wide).reshape(len(pieces), self.columns, PACK) @ power).T for fill in (0, 256))

    def edges(self, buf: np.ndarray, unit_end: np.ndarray):
        """(position * (depth + 1) + length, piece) of every occurrence inside a unit, sorted."""
        left = unit_end - np.arange(len(buf))
        key = packed(buf, left)
        order = suffix_array(key, left, self.depth)
        first = key[order]
        lo, hi = np.searchsorted(first, self.low[0]), np.searchsorted(first, self.high[0], side="right")
        for c in range(1, self.columns):
            use = np.flatnonzero((self.size > c * PACK) & (lo < hi))
            a = _bound(key, left, order, c * PACK, lo[use], hi[use], self.low[c, use], False)
            b = _bound(key, left, order, c * PACK, a, hi[use], self.high[c, use], True)
            lo[use], hi[use] = a, b
        n = hi - lo
        total = np.cumsum(n)
        piece = np.repeat(np.arange(len(n)), n)
        pos = order[np.arange(total[-1]) + np.repeat(lo - total + n, n)]
        by, key = sorted_by(pos * (self.depth + 1) + self.size[piece], (len(buf) + 1) * (self.depth + 1))
        return key, piece[by]

    def units(self, units: pa.LargeBinaryArray):
        """Token ids of all units, and where each unit's begin (one more entry than units)."""
        if not len(units):
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        buf, ends = w.text_bytes(units)
        size, ends = np.diff(ends), ends[1:]
        key, piece = self.edges(buf, np.repeat(ends, size))
        start = np.flatnonzero((buf & 0xC0) != 0x80)
        length = np.diff(np.append(start, len(buf)))
        unit = np.searchsorted(ends, start, side="right")

        def find(at, n):
            want = at * (self.depth + 1) + n
            i = np.minimum(np.searchsorted(key, want), max(0, len(key) - 1))
            return np.where((n <= self.depth) & (key[i] == want), piece[i], -1) if len(key) else np.full(len(at), -1)

        chars = np.bincount(unit, minlength=len(units))
        long = chars[unit] > LONG
        done = [self._relax(start[~long], length[~long], unit[~long], find)]
        for u in np.flatnonzero(chars > LONG):
            mine = unit == u if len(units) < 8 else slice(*np.searchsorted(unit, [u, u + 1]))
            done.append(self._heap(start[mine], length[mine], find))
        start = np.concatenate([d[0] for d in done])
        length = np.concatenate([d[1] for d in done])
        order = np.argsort(start)
        start, length = start[order], length[order]
        found = find(start, length)
        n = np.where(found >= 0, 1, length)
        total = np.cumsum(n)
        of = np.repeat(np.arange(len(n)), n)
        at = start[of] + np.arange(total[-1]) - (total - n)[of]
        ids = np.where(found[of] >= 0, self.id[found[of]], self.bytes[buf[at]])
        first = np.concatenate([[0], total])[np.searchsorted(start, np.concatenate([[0], ends]))]
        return ids, first

    def _relax(self, start, length, unit, find):
        """Join symbols of all units together, the best edge of each unit in a round."""
        out = []

        def scores(i):
            pair = np.full(len(i), -np.inf)
            ok = i + 1 < len(start)
            ok[ok] &= unit[i[ok]] == unit[i[ok] + 1]
            p = find(start[i[ok]], length[i[ok]] + length[i[ok] + 1])
            pair[ok] = np.where(p >= 0, self.score[p], -np.inf)
            return pair

        value = scores(np.arange(len(start)))
        while len(start):
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            best = np.repeat(np.maximum.reduceat(value, first), np.diff(np.append(first, len(start))))
            over = best == -np.inf
            if over.any():
                out.append((start[over], length[over]))
                start, length, unit, value, best = start[~over], length[~over], unit[~over], value[~over], best[~over]
                if not len(start):
                    break
            at = np.flatnonzero(value == best)
            at = at[np.concatenate([[True], unit[at[1:]] != unit[at[:-1]]])]
            length[at] += length[at + 1]
            keep = np.ones(len(start), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one symbol is gone for each join further left
            start, length, unit, value = start[keep], length[keep], unit[keep], value[keep]
            value[at] = scores(at)
            left = at[at > 0] - 1
            value[left] = scores(left)
        return np.concatenate([o[0] for o in out] or [np.zeros(0, np.int64)]), np.concatenate([o[1] for o in out] or [np.zeros(0, np.int64)])

    def _heap(self, start, length, find):
        """The same joins for one long unit, with a heap of edges."""
        n = len(start)
        size, after, before = length.tolist(), [*range(1, n), -1], [-1, *range(n - 1)]
        at = start.tolist()
        pair = find(start[:-1], length[:-1] + length[1:])
        heap = [(-self.score[p], i, size[i], size[i + 1]) for i, p in enumerate(pair.tolist()) if p >= 0]
        heapq.heapify(heap)

        def push(i):
            j = after[i]
            p = int(find(np.array([at[i]]), np.array([size[i] + size[j]]))[0])
            if p >= 0:
                heapq.heappush(heap, (-self.score[p], i, size[i], size[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if size[i] != a or j < 0 or size[j] != b:
                continue
            size[i], size[j] = a + b, 0
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        keep = np.array(size) > 0
        return start[keep], np.array(size)[keep]

    def encode(self, texts: pa.Array):
        """Ids of all texts in one array, and where each text's begin. Units
        stay known from call to call; once they take over ``KNOWN`` bytes,
        those of the last call do."""
        texts.validate(full=True)
        none, space = (pa.scalar(x, pa.large_string()) for x in ("", SPACE))
        text = pc.replace_substring(texts.cast(pa.large_string()).fill_null(none), " ", SPACE)
        text = pc.if_else(pc.equal(text, none), none, pc.binary_join_element_wise(space, text, none))
        buf, row = w.text_bytes(text)
        a, b, c = SPACE.encode()
        mark = np.flatnonzero((buf[:-2] == a) & (buf[1:-1] == b) & (buf[2:] == c))
        is_row = np.zeros(len(buf) + 1, bool)
        is_row[row] = True
        begin = mark[is_row[mark] | (np.diff(mark, prepend=-4) != 3)]
        cuts = np.append(begin, len(buf))
        units = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(cuts), pa.py_buffer(buf)])
        # The units known come first in the dictionary, in their order; new ones follow.
        both = pa.concat_arrays([self.known, units]).dictionary_encode()
        flat = both.indices.to_numpy()[len(self.known) :]
        ids, first = self.units(both.dictionary[len(self.known) :])
        self.known = both.dictionary
        self.first = np.concatenate([self.first, len(self.ids) + first[1:]])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        out, total = self._ids(flat)
        at = total[np.searchsorted(begin, row)]
        if self.known.nbytes + self.first.nbytes + self.ids.nbytes > KNOWN:
            keep = np.unique(flat)
            self.known, (self.ids, self.first) = self.known.take(pa.array(keep)), self._ids(keep)
        return out, at

    def _ids(self, units: np.ndarray):
        """Ids of units known, and where each unit's begin."""
        n = self.first[units + 1] - self.first[units]
        total = np.concatenate([[0], np.cumsum(n)])
        return self.ids[np.arange(total[-1]) - np.repeat(total[:-1] - self.first[units], n)], total


class Decoder:
    def __init__(self, pieces: list[tuple[int, bytes, float]], bytes_: list[int]):
        text = {i: p.replace("▁".encode(), b" ") for i, p, _ in pieces} | {i: bytes([b]) for b, i in enumerate(bytes_)}
        self.n = max(text) + 1
        parts = [text.get(i, b"") for i in range(self.n + 1)]  # the last one is empty, for ids of no piece
        self.size = np.array([len(t) for t in parts], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The texts of the ids between neighbours of ``at``."""
        ids = np.where((ids >= 0) & (ids < self.n), ids, self.n)
        n = self.size[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        data = self.flat[np.arange(total[-1]) - np.repeat(total[:-1] - self.at[ids], n)].tobytes()
        ends = total[at].tolist()
        return [data[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _tasks(model, verify: bool):
    def run(batches):
        encoder, decoder = Encoder(*model.value), Decoder(*model.value)
        for batch in batches:
            for part in w.pieces(batch, "text", SLICE):
                texts = part.column("text")
                ids, at = encoder.encode(texts)
                columns = [*part.columns, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids), mask=texts.is_null())]
                names = [*part.schema.names, "token_ids"]
                if verify:
                    columns.append(pa.array([t is None or t == d for t, d in zip(texts.to_pylist(), decoder.decode(ids, at), strict=True)]))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(docs: DataFrame, model_path: str, verify: bool = False) -> DataFrame:
    """``docs`` with the ids of ``text`` as ``token_ids``. With ``verify`` the
    task decodes them again: ``round_trip`` says that this gave the text."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("token_ids", *["round_trip"] * verify)
    model = spark.sparkContext.broadcast((load(model_path), byte_ids(model_path)))
    more = [StructField("token_ids", ArrayType(IntegerType()))] + [StructField("round_trip", BooleanType())] * verify
    return docs.mapInArrow(_tasks(model, verify), StructType([*docs.schema.fields, *more]))


def _by_ids(batch: pa.RecordBatch):
    """``batch`` in slices of at most SLICE / 4 ids (or one row)."""
    size = np.asarray(batch.column("token_ids").value_lengths().fill_null(0), np.int64)
    total = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(total, total[i] + SLICE // 4, side="right")) - 1)
        yield batch.slice(i, j - i), total[i : j + 1] - total[i]
        i = j


def decode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with the text of ``token_ids`` as ``decoded``."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("decoded")
    model = spark.sparkContext.broadcast((load(model_path), byte_ids(model_path)))

    def run(batches):
        decoder = Decoder(*model.value)
        for batch in batches:
            for part, at in _by_ids(batch):
                lists = part.column("token_ids")
                out = decoder.decode(lists.flatten().fill_null(-1).to_numpy(), at)
                text = pa.array(out, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "decoded"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("decoded", StringType())]))
