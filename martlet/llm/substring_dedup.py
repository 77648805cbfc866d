"""Substring dedup: remove word windows that start earlier elsewhere.

Method: prefix-partitioned suffix trees. The suffixes of a text are its word
positions, read ``window`` words deep, since a repeat counts from that depth
on. A suffix is filed under a prefix of variable length: up to the end of
the *anchor* of its window (the gram of ``GRAM`` words with the smallest
hash), 8 to 20 words. The suffixes of a prefix form one subtree; sorted by
their path they come as runs, and a run with two leaves or more is an
internal node at depth ``window``. Its earliest leaf stays, the others are
marked, and a word covered by a marked window goes. Maximal repeats are
then the unions of marked windows.

Steps, each a Spark job over rows that no single key can pile up in:

1. Anchors. Equal windows have equal anchors, so a text whose anchors occur
   in no other text has no repeat elsewhere. A task sends one row for each
   anchor of its batch of texts, so an anchor of a third of all documents is
   a row for each batch and not for each document.
2. Subtrees. Texts with shared anchors send the suffixes at those anchors,
   again one leaf for each node and batch: the earliest. Later leaves in
   the batch are marked at once.
3. Marks meet their texts by document.

Exact copies take no part in steps 1 and 2: a text of ``window`` words or
more that equals one of a smaller doc_id goes whole.

Cases: null or empty text has no words. Rows with a null doc_id have no
place in the order; they are compared with nothing but themselves. Repeated
rows of one doc_id are one document and are not held against each other.
Words are taken unchanged. Other columns of the input are left alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm import _words as w
from martlet.llm._common import ship, stored

GRAM = 8
GRAM_BASE = 0x9E3779B97F4A7C15
PATH_BASE = 0xC2B2AE3D27D4EB4F
PREFIX_BASE = 0xA24BAED4963EE407
U = np.uint64


def least_grams(grams: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` grams from each position on."""
    out, have = grams, 1
    while have * 2 <= width:
        out, have = np.minimum(out[:-have], out[have:]), have * 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


class Texts:
    """Words and windows of the texts of one piece of a batch."""

    def __init__(self, col, window: int):
        self.window = window
        self.buf, self.offsets = w.text_bytes(col)
        self.starts, self.ends, self.rows = w.word_spans(self.buf, self.offsets)
        self.words = w.word_hashes(self.buf, self.starts, self.ends)
        self.paths = w.gram_hashes(self.words, window, PATH_BASE)
        self.at = np.flatnonzero(w.within_rows(self.rows, window))  # windows inside one row
        self.n = len(self.offsets) - 1
        self.first_word = np.searchsorted(self.rows, np.arange(self.n + 1))

    def anchors(self) -> np.ndarray:
        """The anchor of each window of ``at``."""
        grams = w.gram_hashes(self.words, GRAM, GRAM_BASE)
        return least_grams(grams, self.window - GRAM + 1)[self.at] if len(self.at) else np.zeros(0, U)

    def repeats(self) -> np.ndarray:
        """Windows that start earlier in their own row."""
        key = w.mix(self.paths[self.at] ^ (self.rows[self.at].astype(U) + U(1)) * w.MUL)
        again = np.ones(len(key), bool)
        again[np.unique(key, return_index=True)[1]] = False
        return self.at[again]

    def removed(self, marked: np.ndarray) -> np.ndarray:
        """Words covered by windows that start at the given words."""
        total = np.zeros(len(self.words) + self.window + 1, np.int64)
        np.add.at(total, marked, 1)
        total = np.minimum(total, 1)
        total = np.concatenate([[0], np.cumsum(total)])
        i = np.arange(len(self.words))
        return total[i + 1] > total[np.maximum(i + 1 - self.window, 0)]

    def kept(self, gone: np.ndarray) -> list[bytes]:
        """The words that stay, joined by one space, of each row."""
        rows, starts, ends = self.rows[~gone], self.starts[~gone], self.ends[~gone]
        more = np.concatenate([rows[1:] == rows[:-1], np.zeros(len(rows[:1]), bool)])
        step = np.zeros(len(self.buf) + 2, np.int8)
        step[starts] = 1
        np.subtract.at(step, ends + more, 1)
        keep = np.cumsum(step[: len(self.buf)], dtype=np.int8).astype(bool)
        data = np.where(w.SPACE[self.buf], np.uint8(0x20), self.buf)[keep].tobytes()
        size = np.bincount(rows, weights=ends + more - starts, minlength=self.n)
        at = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
        return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _digests(marked: bool, window: int, texts: bool):
    def run(batches):
        for batch in batches:
            for part in w.pieces(batch, "text"):
                t = Texts(part.column("text"), window)
                hit = t.repeats()
                if marked:
                    lists = part.column("marks").fill_null([])
                    ends = np.diff(lists.offsets.to_numpy())
                    rows = np.repeat(np.arange(t.n), ends)
                    hit = np.concatenate([hit, t.first_word[rows] + lists.flatten().to_numpy()])
                gone = t.removed(hit.astype(np.int64))
                out = t.kept(gone)
                n = np.bincount(t.rows, minlength=t.n)
                cols = {
                    "doc_id": part.column("doc_id"), "fp": part.column("fp"), "n_words": pa.array(n, pa.int64()),
                    "n_removed": pa.array(np.bincount(t.rows[gone], minlength=t.n), pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string()),
                }
                if texts:
                    cols["kept"] = pa.array([x.decode() for x in out], pa.string())
                yield pa.RecordBatch.from_pydict(cols)

    return run


_DIGEST = "doc_id long, fp long, n_words long, n_removed long, kept_sha256 string"


def _anchor_rows(window: int):
    """One row for each anchor and batch; ``known`` if the batch itself has it in two texts."""

    def run(batches):
        for batch in batches:
            for part in w.pieces(batch, "text"):
                t = Texts(part.column("text"), window)
                ids, fps = part.column("doc_id").to_numpy(), part.column("fp").to_numpy()
                rows = t.rows[t.at]
                anchors = t.anchors()
                order = np.lexsort((ids[rows], anchors)) if len(rows) else np.zeros(0, np.int64)
                a, r = anchors[order], rows[order]
                fresh = np.ones(len(a), bool)  # a text counts once; of exact copies the one of the smallest id
                fresh[1:] = (a[1:] != a[:-1]) | (fps[r[1:]] != fps[r[:-1]])
                a, r = a[fresh], r[fresh]
                new = np.ones(len(a), bool)
                new[1:] = a[1:] != a[:-1]
                run_of = np.cumsum(new) - 1
                size = np.bincount(run_of) if len(a) else np.zeros(0, np.int64)
                known = size[run_of] > 1 if len(a) else np.zeros(0, bool)
                keep = new | known
                # only the first row of an anchor is dealt by the anchor; the others are known to be shared
                slot = np.where(new, a, w.mix(a ^ r.astype(U) * w.MUL))
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array(slot[keep].view(np.int64)), "anchor": pa.array(a[keep].view(np.int64)),
                    "doc_id": pa.array(ids[r[keep]]), "fp": pa.array(fps[r[keep]]), "known": pa.array(known[keep]),
                })

    return run


def _runs(columns: list[str], decide):
    """Walk sorted rows batch by batch: ``decide`` gets the columns and what is
    carried from the batch before (no columns at the end)."""

    def run(batches):
        carry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
            out, carry = decide(cols, carry)
            if out is not None and out.num_rows:
                yield out
        if carry is not None:
            out, _ = decide(None, carry)
            if out is not None and out.num_rows:
                yield out

    return run


def _shared_anchors(cols, carry):
    """Rows whose anchor occurs in two texts. The last row of a batch waits
    until the next batch shows whether it is alone."""
    names = ["slot", "anchor", "doc_id", "fp", "known"]
    if cols is None:
        part, hit = carry, np.full(len(carry["slot"]), bool(carry["known"].any()))
    else:
        if carry is not None:
            cols = {c: np.concatenate([carry[c], cols[c]]) for c in names}
        slot, fp = cols["slot"], cols["fp"]
        new = np.ones(len(slot), bool)
        new[1:] = slot[1:] != slot[:-1]
        hit = cols["known"].astype(bool)
        hit[1:] |= ~new[1:] & (fp[1:] != fp[:-1])
        start = np.flatnonzero(new)  # a run is shared as a whole, with the exact copies in it
        hit = np.repeat(np.logical_or.reduceat(hit, start), np.diff(np.append(start, len(slot))))
        if not hit[-1]:  # all rows of the open run wait: exact copies, at most one for each batch of texts
            wait = int(start[-1])
            carry = {c: cols[c][wait:] for c in names}
        else:
            wait = len(slot) - 1
            carry = {c: cols[c][wait:] for c in names} | {"known": np.ones(1, bool)}
        part, hit = {c: cols[c][:wait] for c in names}, hit[:wait]
    out = pa.RecordBatch.from_arrays([pa.array(part[c][hit]) for c in names[1:4]], names[1:4])
    return out, carry


def _suffix_rows(window: int):
    """Leaves of the subtrees: for each node the earliest of the batch; the others are marks."""

    def run(batches):
        for batch in batches:
            for part in w.pieces(batch, "text"):
                t = Texts(part.column("text"), window)
                ids, fps = part.column("doc_id").to_numpy(), part.column("fp").to_numpy()
                lists = part.column("anchors")
                of = np.repeat(np.arange(t.n), np.diff(lists.offsets.to_numpy()))
                pair = lambda rows, a: w.mix(a ^ (rows.astype(U) + U(1)) * w.MUL)
                anchors, rows = t.anchors(), t.rows[t.at]
                hit = np.isin(pair(rows, anchors), pair(of, lists.flatten().to_numpy().view(U)))
                at, anchors, rows = t.at[hit], anchors[hit], rows[hit]
                own = t.repeats()
                first = ~np.isin(at, own)  # later starts in the same row are known without a search
                at, anchors, rows = at[first], anchors[first], rows[first]
                grams = w.gram_hashes(t.words, GRAM, GRAM_BASE)
                size = np.full(len(at), window)
                for k in range(window - GRAM, -1, -1):
                    size[grams[at + k] == anchors] = k + GRAM
                total = np.zeros(len(t.words) + 1, U)
                np.cumsum(t.words * w.powers(PREFIX_BASE, len(t.words)), out=total[1:])
                back = w.powers(pow(PREFIX_BASE, -1, 1 << 64), len(t.words) + 1)
                prefix = (w.mix((total[at + size] - total[at]) * back[at]) >> U(33)).astype(np.int64)
                path, doc = t.paths[at].view(np.int64), ids[rows]
                order = np.lexsort((doc, path, prefix)) if len(at) else np.zeros(0, np.int64)
                p, h, d = prefix[order], path[order], doc[order]
                new = np.ones(len(p), bool)
                new[1:] = (p[1:] != p[:-1]) | (h[1:] != h[:-1])
                least = d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(p) else d
                later = d > least
                pos = (at - t.first_word[rows])[order]
                h = np.where(later, w.mix(h.view(U) ^ at[order].astype(U) * w.MUL).view(np.int64), h)  # dealt anywhere
                yield pa.RecordBatch.from_pydict({
                    "prefix": pa.array(np.where(later, -1, p)), "path": pa.array(h),
                    "doc_id": pa.array(d), "fp": pa.array(fps[rows][order]), "pos": pa.array(pos.astype(np.int32)),
                })

    return run


def _later_leaves(cols, carry):
    """Every leaf of a node but those of the smallest doc_id."""
    if cols is None:
        return None, None
    p, h, d = cols["prefix"], cols["path"], cols["doc_id"]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (h[1:] != h[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    if carry is not None and (p[0], h[0]) == carry[:2]:
        least[np.cumsum(new) == 1] = carry[2]
    later = (d > least) | (p < 0)
    out = pa.RecordBatch.from_arrays([pa.array(cols[c][later]) for c in ("doc_id", "fp", "pos")], ["doc_id", "fp", "pos"])
    return out, (p[-1], h[-1], least[-1])


def substring_dedup(docs: DataFrame, window: int = 20, texts: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_words,
    n_removed, kept_sha256 and, with ``texts``, the kept words (``kept``).

    The words are joined by one space. ``window`` is the least length of a
    repeat in words, at least 9.
    """
    if window <= GRAM:
        raise ValueError(f"window must be over {GRAM} words")
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("fp"))
    wide = _DIGEST + (", kept string" if texts else "")
    own = stored(rows.mapInArrow(_digests(False, window, texts), wide))

    # Exact copies: two hashes and the length stand for the text.
    same = ["fp", "kept_sha256", "n_words"]
    first = stored(own.filter("doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("first_id")))
    own = own.join(first, same, "left").withColumn("copy", F.coalesce(F.expr("doc_id > first_id"), F.lit(False)) & (F.col("n_words") >= window))
    copies = own.filter("copy").select("doc_id", "fp").distinct()

    known = rows.filter("doc_id is not null")
    shared = (
        known.mapInArrow(_anchor_rows(window), "slot long, anchor long, doc_id long, fp long, known boolean")
        .repartition("slot").sortWithinPartitions("slot", "fp", "doc_id")
        .mapInArrow(_runs(["slot", "anchor", "doc_id", "fp", "known"], _shared_anchors), "anchor long, doc_id long, fp long")
    )
    lists = shared.groupBy("doc_id", "fp").agg(F.collect_set("anchor").alias("anchors")).join(copies, ["doc_id", "fp"], "left_anti")
    picked = stored(known.join(lists, ["doc_id", "fp"]))
    marks = (
        picked.mapInArrow(_suffix_rows(window), "prefix long, path long, doc_id long, fp long, pos int")
        .repartition("prefix", "path").sortWithinPartitions("prefix", "path", "doc_id")
        .mapInArrow(_runs(["prefix", "path", "doc_id", "fp", "pos"], _later_leaves), "doc_id long, fp long, pos int")
        .groupBy("doc_id", "fp").agg(F.collect_set("pos").alias("marks"))
    )
    again = picked.select("doc_id", "fp", "text").join(marks, ["doc_id", "fp"]).mapInArrow(_digests(True, window, texts), wide)
    value = ["n_removed", "kept_sha256", *["kept"] * texts]
    again = again.dropDuplicates(["doc_id", "fp"]).select("doc_id", "fp", *[F.col(c).alias(f"new_{c}") for c in value])
    nothing = {"n_removed": F.col("n_words"), "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest()), "kept": F.lit("")}
    return own.join(again, ["doc_id", "fp"], "left").select(
        "doc_id", "n_words", *[F.when(F.col("copy"), nothing[c]).otherwise(F.coalesce(f"new_{c}", c)).alias(c) for c in value]
    )
