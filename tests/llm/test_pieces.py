"""What the SentencePiece operator matches, and its suffix array."""

import random

import numpy as np
import pyarrow as pa
import pytest

from martlet.llm import pieces
from martlet.llm._common import tokenizer

MODEL = tokenizer("piece_bpe_32k.model")


@pytest.fixture()
def matched(monkeypatch):
    """The number of units matched, by call."""
    calls, units = [], pieces.Encoder.units
    monkeypatch.setattr(pieces.Encoder, "units", lambda self, u: calls.append(len(u)) or units(self, u))
    return calls


def encoded(texts, size):
    class Model:
        value = (pieces.load(MODEL), pieces.byte_ids(MODEL))

    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i : i + size], pa.string())}) for i in range(0, len(texts), size)]
    out = [r for b in pieces._tasks(Model, True)(batches) for r in b.to_pylist()]
    assert all(r["round_trip"] for r in out)
    return [r["token_ids"] for r in out]


def test_units_of_a_large_vocabulary_are_matched_once(matched):
    texts = [" ".join(f"w{j}" for j in range(i, i + 2000)) for i in range(100000, 240000, 2000)]
    ids = encoded(texts * 2, 10)
    assert ids[:70] == ids[70:] and sum(matched) == 140000


def test_units_of_the_last_call_stay_known(matched, monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")
    monkeypatch.setattr(pieces, "KNOWN", 4000)
    often = " ".join(f"often{j}" for j in range(20))
    texts = [x for i in range(40) for x in (often, " ".join(f"{i}x{j}" for j in range(30)) + " 日本", None, "")]
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert encoded(texts, 4) == [None if t is None else sp.encode(t) for t in texts]
    assert sum(matched) == 20 + 1 + 40 * 30


def test_suffixes_end_with_their_unit():
    r = random.Random(3)
    for _ in range(30):
        units = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))).encode() for _ in range(r.randint(1, 30))]
        buf, size = np.frombuffer(b"".join(units), np.uint8), [len(u) for u in units]
        end = np.repeat(np.cumsum(size), size)
        left = end - np.arange(len(buf))
        order = pieces.suffix_array(pieces.packed(buf, left), left, 16)
        found = [buf[p : min(end[p], p + 16)].tobytes() for p in order]
        assert found == sorted(found) and sorted(order) == list(range(len(buf)))


def test_wide_keys_are_sorted_too():
    key = np.random.default_rng(0).integers(0, 50, 1000)
    for most in (50, 1 << 62):
        order, k = pieces.sorted_by(key, most)
        assert (order == np.argsort(key, kind="stable")).all() and (k == np.sort(key)).all()


def test_wide_and_cut_columns():
    encoder = pieces.Encoder(pieces.load(MODEL), pieces.byte_ids(MODEL))
    texts = ["a b", None, "", "▁ c  日本"]
    got = [[x.tolist() for x in encoder.encode(pa.array(["zz", *texts], t)[1:])] for t in (pa.string(), pa.large_string())]
    assert got[0] == got[1] and len(got[0][1]) == 5
