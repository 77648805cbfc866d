"""Quality classifier: attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. Each passage is encoded
from the shares of its characters and words (no language, source or id);
gated attention weighs the encoded passages, and the weighted sum is scored
by a logistic unit. Only the document has a label, so attention is learnt
with the rest of the network, by gradient descent on a bounded sample of
labelled documents (``max_train``). Features are computed by Spark tasks;
the network of a few thousand weights is trained on the driver and sent to
the tasks that score.

Cases: null and empty texts are one passage without words and get a score;
null labels are left out, repeated labels of a document count as their
smallest, and of several texts of one doc_id the least is learnt from; with no label of one class every score is the share of label 1
(0.5 without labels). Repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from martlet.llm import _words as w
from martlet.llm._common import ship

PASSAGE = 100
#: Bytes of text whose features a task holds at a time.
SLICE = 1 << 20
PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.zeros(256, np.int64)  # 0: bytes of other characters
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[0x20] = 4
_CLASS[0x09:0x0E] = 5
_CLASS[0x00:0x09] = 6
_CLASS[np.frombuffer(PUNCT, np.uint8)] = 7 + np.arange(len(PUNCT))
N_CLASS = 7 + len(PUNCT)
N_FEATURES = N_CLASS + 6


def passages(col) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the text each is of (ascending)."""
    buf, offsets = w.text_bytes(col)
    starts, ends, rows = w.word_spans(buf, offsets)
    n = len(offsets) - 1
    words = np.bincount(rows, minlength=n)
    size = np.maximum(1, -(-words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(size)])
    of = np.repeat(np.arange(n), size)
    within = np.arange(len(rows)) - np.concatenate([[0], np.cumsum(words)])[rows]
    bag = first[rows] + within // PASSAGE
    out = np.zeros((len(of), N_FEATURES), np.float32)
    total = np.bincount(bag, minlength=len(of)).astype(np.float64)
    if len(buf):
        at = np.searchsorted(starts, np.arange(0, len(buf)), side="right") - 1 if len(starts) < 2 else np.repeat(
            np.arange(-1, len(starts)), np.diff(np.concatenate([[0], starts, [len(buf)]])))
        doc = np.repeat(np.arange(n), np.diff(offsets))
        at = np.where((at >= 0) & (rows[np.maximum(at, 0)] == doc), bag[np.maximum(at, 0)], first[doc]) if len(starts) else first[doc]
        count = np.bincount(at * N_CLASS + _CLASS[buf], minlength=len(of) * N_CLASS).reshape(-1, N_CLASS)
        share = count / np.maximum(1, count.sum(1, keepdims=True))
        out[:, :N_CLASS] = np.sqrt(share)
    if len(starts):
        code = w.word_hashes(buf, starts, ends)
        same = np.concatenate([[False], (code[1:] == code[:-1]) & (bag[1:] == bag[:-1])])
        key = w.mix(code ^ (bag.astype(np.uint64) + np.uint64(1)) * w.MUL)
        first_seen = np.zeros(len(key), bool)
        first_seen[np.unique(key, return_index=True)[1]] = True
        marks = np.isin(buf[ends - 1], np.frombuffer(PUNCT, np.uint8))
        upper = _CLASS[buf[starts]] == 2
        length = ends - starts
        for k, v in enumerate((same, ~first_seen, marks, upper, np.minimum(length, 40) / 40.0)):
            out[:, N_CLASS + k] = np.bincount(bag, weights=v.astype(float), minlength=len(of)) / np.maximum(1, total)
        out[:, N_CLASS + 5] = np.log1p(total) / 5
    return out, of


def _feature_rows(batches):
    for batch in batches:
        for part in w.pieces(batch, "text", SLICE):
            x, of = passages(part.column("text"))
            rows = np.searchsorted(of, np.arange(part.num_rows + 1))
            values = pa.array(x.ravel())
            lists = pa.ListArray.from_arrays(pa.array((rows * N_FEATURES).astype(np.int32)), values)
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "y": part.column("y"), "x": lists})


class Network:
    """Passage encoder, gated attention and scorer, with hand-written gradients."""

    def __init__(self, mean, scale, hidden: int = 16, attention: int = 8, seed: int = 1):
        rnd = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        make = lambda *s: rnd.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"E": make(len(mean), hidden), "e": np.zeros(hidden), "V": make(hidden, attention), "U": make(hidden, attention),
                  "a": make(attention), "c": make(hidden), "b": np.zeros(1)}

    def forward(self, x, start):
        """``start``: the first passage of each bag, in order."""
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["a"]
        size = np.diff(np.append(start, len(x)))
        of = np.repeat(np.arange(len(start)), size)
        s = np.exp(s - np.maximum.reduceat(s, start)[of])
        alpha = s / np.add.reduceat(s, start)[of]
        z = np.add.reduceat(h * alpha[:, None], start)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return y, (x, h, t, g, alpha, z, of)

    def gradients(self, y, target, weight, state, start, decay):
        x, h, t, g, alpha, z, of = state
        p = self.p
        d = (y - target) * weight
        dz = d[:, None] * p["c"]
        dalpha = (h * dz[of]).sum(1)
        ds = alpha * (dalpha - np.add.reduceat(alpha * dalpha, start)[of])
        dt, dg = ds[:, None] * p["a"] * g * (1 - t * t), ds[:, None] * p["a"] * t * g * (1 - g)
        dh = dz[of] * alpha[:, None] + dt @ p["V"].T + dg @ p["U"].T
        dh *= 1 - h * h
        grad = {"E": x.T @ dh, "e": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "a": (t * g).T @ ds, "c": z.T @ d, "b": d.sum(keepdims=True)}
        return {k: v + decay * p[k] * (k in "EVUac") for k, v in grad.items()}


def train(bags: list[np.ndarray], labels: np.ndarray, rounds: int = 200, rate: float = 0.03, decay: float = 1e-4) -> Network | float:
    """A network fit by Adam on all bags at once, or the share of label 1 where one class is missing."""
    if not len(bags):
        return 0.5
    if labels.min() == labels.max():
        return float(labels.mean())
    x = np.concatenate(bags).astype(np.float64)
    start = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    net = Network(x.mean(0), x.std(0) + 0.02)
    weight = np.full(len(labels), 1 / len(labels))
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    for i in range(1, rounds + 1):
        y, state = net.forward(x, start)
        for k, g in net.gradients(y, labels, weight, state, start, decay).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v2[k] = 0.99 * v2[k] + 0.01 * g * g
            net.p[k] = net.p[k] - rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(v2[k] / (1 - 0.99**i)) + 1e-8)
    return net


def held_out(doc_id):
    """Rows that are kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = 4000) -> Network | float:
    """Learn from at most ``max_train`` labelled documents that are not held
    out, those whose ids hash lowest."""
    ship(docs.sparkSession)
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    )
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
        .mapInArrow(_feature_rows, "doc_id long, y int, x array<float>").toArrow()
    )
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable") if rows.num_rows else []
    xs = rows.column("x").combine_chunks() if rows.num_rows else []
    bags = [np.asarray(xs[int(i)].values).reshape(-1, N_FEATURES) for i in order]
    return train(bags, rows.column("y").to_numpy()[order].astype(float) if rows.num_rows else np.zeros(0))


def score(docs: DataFrame, model: Network | float, cut: float = 0.7) -> DataFrame:
    """One row for each row of ``docs``: all its columns, ``score`` and ``predicted``."""
    ship(docs.sparkSession)
    docs = docs.drop(*[c for c in ("score", "predicted") if c in docs.columns])

    def run(batches):
        for batch in batches:
            for part in w.pieces(batch, "text", SLICE):
                if isinstance(model, float):
                    y = np.full(part.num_rows, model)
                else:
                    x, of = passages(part.column("text"))
                    y = model.forward(x, np.searchsorted(of, np.arange(part.num_rows)))[0]
                cols = [*part.columns, pa.array(y), pa.array((y >= cut).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=[*part.schema.names, "score", "predicted"])

    wide = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, wide)
