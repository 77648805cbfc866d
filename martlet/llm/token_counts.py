"""Token counts by trie-shared dynamic programming.

Texts are cut before each run of spaces into pre-tokens. The distinct
pre-tokens of a batch form a trie, built level by level; a node stands for a
prefix that any number of pre-tokens share. The best score of a node is the
best over the pieces that end there of the piece's score plus the best of
the node where the piece starts, so a shared prefix is computed once. The
node where a pre-token ends stores its count, and a text's count is the sum
over its pre-tokens.

Unigram scores are the model's piece scores; of segmentations with equal
scores the one of fewer tokens counts. A character that is no piece scores
less than any piece and counts as its UTF-8 bytes. Only nodes of the last
(longest piece) levels are held. Pre-tokens of over ``LONG`` characters are
computed on their own, so they add no levels.

Cases: null and empty texts have 0 tokens; repeated rows each get a row.
Columns called ``n_tokens`` are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from martlet.llm import _words as w
from martlet.llm._common import ship
from martlet.llm.pieces import UNIT, load

LONG = 64
BASE = np.uint64(0x9E3779B97F4A7C15)
U = np.uint64


class Counter:
    def __init__(self, pieces: list[tuple[int, bytes, float]]):
        text = [p[1].decode() for p in pieces]
        self.score = {t: p[2] for t, p in zip(text, pieces, strict=True)}
        self.unknown = min(self.score.values()) - 10
        self.longest = max(map(len, text))
        wide = np.zeros((len(text), self.longest), np.uint32)
        size = np.array([len(t) for t in text])
        for i, t in enumerate(text):
            wide[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), np.uint32)[::-1]
        h = np.zeros(len(text), U)
        for j in range(self.longest):
            h = np.where(j < size, w.mix(h * BASE + wide[:, j].astype(U) + U(1)), h)
        order = np.argsort(h)
        self.hash, self.value = h[order], np.array([p[2] for p in pieces])[order]

    def lookup(self, h: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[i] == h, self.value[i], -np.inf)

    def counts(self, tokens: list[str]) -> np.ndarray:
        """The count of each of some distinct pre-tokens."""
        out = np.zeros(len(tokens), np.int64)
        size = np.array([len(t) for t in tokens], np.int64)
        for i in np.flatnonzero(size > LONG):
            out[i] = self.alone(tokens[i])
        short = np.flatnonzero((size > 0) & (size <= LONG))
        if not len(short):
            return out
        short = short[np.argsort(-size[short], kind="stable")]
        length = size[short]
        chars = np.frombuffer("".join(tokens[i] for i in short).encode("utf-32-le", "surrogatepass"), np.uint32)
        start = np.cumsum(length) - length
        node = np.zeros(len(short), np.int64)
        levels = [(np.zeros(1, np.int64), np.zeros(1, U), np.zeros(1), np.zeros(1, np.int64))]  # parent, character, score, tokens
        for depth in range(1, int(length[0]) + 1):
            n = int(np.searchsorted(-length, -depth, side="right"))  # those that reach this depth
            key = node[:n] * (1 << 21) + chars[start[:n] + depth - 1]
            key, node = np.unique(key, return_inverse=True)
            parent, char = key >> 21, (key & ((1 << 21) - 1)).astype(U)
            levels.append((parent, char, None, None))
            best, count = np.full(len(key), -np.inf), np.zeros(len(key), np.int64)
            at, h = np.arange(len(key)), np.zeros(len(key), U)
            for back in range(1, min(depth, self.longest) + 1):
                up, c = levels[-back][:2]
                h = w.mix(h * BASE + c[at] + U(1))
                at = up[at]
                piece, step = self.lookup(h), np.ones(len(key), np.int64)
                if back == 1:
                    step = np.where(piece == -np.inf, 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF), 1)
                    piece = np.where(piece == -np.inf, self.unknown, piece)
                score, tokens_ = levels[-back - 1][2][at] + piece, levels[-back - 1][3][at] + step
                better = (score > best) | (score == best) & (tokens_ < count)
                best, count = np.where(better, score, best), np.where(better, tokens_, count)
            levels[-1] = (parent, char, best, count)
            ends = np.flatnonzero(length[:n] == depth)
            out[short[ends]] = count[node[ends]]
            del levels[: max(0, len(levels) - self.longest - 1)]
        return out

    def alone(self, token: str) -> int:
        """The same recurrence for one pre-token."""
        best = [(0.0, 0)]
        for j in range(1, len(token) + 1):
            options = []
            for i in range(max(0, j - self.longest), j):
                piece = self.score.get(token[i:j])
                if piece is not None:
                    options.append((best[i][0] + piece, best[i][1] - 1))
            if token[j - 1] not in self.score:
                n = len(token[j - 1].encode("utf-8", "surrogatepass"))
                options.append((best[j - 1][0] + self.unknown, best[j - 1][1] - n))
            best.append(max(options))
        return -best[-1][1]

    def texts(self, texts: list[str | None]) -> np.ndarray:
        seen: dict[str, int] = {}
        rows = [[seen.setdefault(u, len(seen)) for u in UNIT.findall("▁" + t.replace(" ", "▁"))] if t else [] for t in texts]
        count = self.counts(list(seen))
        total = np.concatenate([[0], np.cumsum(count[np.fromiter((u for r in rows for u in r), np.int64)])])
        edge = np.cumsum([0, *map(len, rows)])
        return total[edge[1:]] - total[edge[:-1]]


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with the number of tokens of ``text`` as ``n_tokens``."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("n_tokens")
    model = spark.sparkContext.broadcast(load(model_path))

    def run(batches):
        counter = Counter(model.value)
        for batch in batches:
            for part in w.pieces(batch, "text"):
                n = counter.texts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64())], names=[*part.schema.names, "n_tokens"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("n_tokens", LongType())]))
