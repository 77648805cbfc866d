r"""Chat formatting by token-level assembly.

A turn becomes ``<|im_start|>role\ntext<|im_end|>\n``. Role and text are
encoded apart from the template, as ordinary text, and the ids of the
template's marks are reserved ids outside the vocabulary; so no text can
make a mark. In role and text each ``\`` is doubled and ``<|`` becomes
``<\|``, so the marks are also plain in the decoded string; ``unescape``
undoes it. A new line in a role is escaped as well. The loss mask is the prefix sum of +1 where an assistant's text
begins and -1 where it ends.

``format_turns`` needs no shuffle: it gives one row for each turn, and a
conversation is the concatenation of its turns in order of (turn, role,
text). ``read_back`` sorts the turns and walks them with running digests, so
a conversation of any length takes bounded memory.

Cases: a null role or text counts as empty; repeated rows are repeated
turns; null turns come first; null conv_ids form one conversation.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm import _words as w
from martlet.llm._common import ship

START, END = "<|im_start|>", "<|im_end|>"
#: Fixed value: the pattern that cuts texts for the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"((?:[^\\\n]|\\.)*)\n", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def load(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Assembler:
    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.start, self.end = max(ranks.values()) + 1, max(ranks.values()) + 2
        self.line = self.encoding.encode_ordinary("\n")

    def turns(self, roles: list[str], texts: list[str]):
        """Ids and loss mask of all turns in one array each, and where each turn's begin."""
        ids, edge, steps = [], [0], []
        for role, text in zip(roles, texts, strict=True):
            head = [self.start, *self.encoding.encode_ordinary(escape(role).replace("\n", "\\\n")), *self.line]
            body = self.encoding.encode_ordinary(escape(text))
            if role == "assistant":
                steps += [(edge[-1] + len(head), 1), (edge[-1] + len(head) + len(body), -1)]
            ids += [*head, *body, self.end, *self.line]
            edge.append(len(ids))
        step = np.zeros(len(ids) + 1, np.int64)
        if steps:
            at, by = np.array(steps).T
            np.add.at(step, at, by)
        return np.array(ids, np.int32), np.cumsum(step)[: len(ids)].astype(np.int8), np.array(edge, np.int32)

    def text(self, ids) -> str:
        """The string of a stretch of ids, marks included."""
        out, at = [], 0
        for i in [*np.flatnonzero(ids >= self.start).tolist(), len(ids)]:
            out.append(self.encoding.decode(ids[at:i].tolist()))
            if i < len(ids):
                out.append(START if ids[i] == self.start else END)
            at = i + 1
        return "".join(out)


def format_turns(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """One row for each turn: conv_id, turn, role, ``text_key`` (orders equal
    turns), ``token_ids`` and ``loss_mask``."""
    spark = conversations.sparkSession
    ship(spark)
    ranks = spark.sparkContext.broadcast(load(vocabulary))
    empty = lambda c: F.coalesce(c, F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), empty("role").alias("role"), empty("text").alias("text"))

    def run(batches):
        assembler = Assembler(ranks.value)
        for batch in batches:
            for part in w.pieces(batch, "text", 4 << 20):
                ids, mask, edge = assembler.turns(part.column("role").to_pylist(), part.column("text").to_pylist())
                edge = pa.array(edge)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("conv_id", "turn", "role")), part.column("text"),
                     pa.ListArray.from_arrays(edge, pa.array(ids)), pa.ListArray.from_arrays(edge, pa.array(mask))],
                    names=["conv_id", "turn", "role", "text_key", "token_ids", "loss_mask"])

    return rows.mapInArrow(run, "conv_id long, turn long, role string, text_key string, token_ids array<int>, loss_mask array<tinyint>")


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self):
        return {"conv_id": self.conv, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def read_back(turns: DataFrame, vocabulary: str) -> DataFrame:
    """One row for each conversation, read from the ids and masks alone:
    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    spark = turns.sparkSession
    ranks = spark.sparkContext.broadcast(load(vocabulary))
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        assembler, open_ = Assembler(ranks.value), None
        for batch in batches:
            out = []
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                if open_ is None or open_.conv != conv:
                    if open_ is not None:
                        out.append(open_.row())
                    open_ = _Digest(conv)
                ids = batch.column("token_ids")[i].values.to_numpy()
                mask = batch.column("loss_mask")[i].values.to_numpy()
                formatted = assembler.text(ids)
                inner = formatted[len(START) : -len(END) - 1]
                cut = _HEAD.match(inner)
                head, body = cut.group(1), inner[cut.end() :]
                loss = unescape(assembler.text(ids[mask > 0]))
                open_.turns += 1
                open_.all.update(f"{unescape(head)}\n{unescape(body)}\n".encode())
                open_.loss.update(loss.encode())
                open_.loss_chars += len(loss)
                open_.chars += len(formatted)
            if out:
                yield pa.RecordBatch.from_pylist(out)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([open_.row()])

    order = ["conv_id", "turn", "role", "text_key"]
    return turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "token_ids", "loss_mask").mapInArrow(run, schema)
