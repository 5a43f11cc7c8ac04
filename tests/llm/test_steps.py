"""How much a Python worker holds at a time, in packing and in the n-gram join."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from bazaarlens.llm import ngram_join, packing
from bazaarlens.llm.common import KEPT, tidy

TEXTS = [f"{'alpha beta gamma delta ' * 170}{i}" for i in range(240)] + ["", "one two " * 40_000, None, "last"]


class Docs:
    """Gives back the function that would run in the tasks."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        return run


def asked(monkeypatch, where, name, size):
    seen, real = [], getattr(where, name)
    monkeypatch.setattr(where, name, lambda *a, **b: seen.append(size(*a)) or real(*a, **b))
    return seen


def test_texts_are_tokenised_by_their_characters_not_by_rows(spark, monkeypatch):
    seen = asked(monkeypatch, packing.Encoder, "encoded", lambda self, texts: (len(texts), sum(map(len, texts))))
    path = public_tokenizers.path("word_bpe_49k.json")
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS)], ["doc_id", "text"])
    out = pa.Table.from_batches(list(packing.tokenised(Docs(), path)(iter([batch]))))
    assert all(n == 1 or size <= packing.STEP for n, size in seen) and sum(n for n, _ in seen) == len(TEXTS)
    assert out["doc_id"].to_pylist() == list(range(len(TEXTS)))
    want = packing.Encoder(path).encoded([x or "" for x in TEXTS])
    assert out["ids"].to_pylist() == [ids.tobytes() for ids, _ in want]
    assert out["x"].to_pylist() == [(total / len(ids) ** 0.5).tolist() for ids, total in want]
    # the encoder stays for the next task, until another function runs
    assert KEPT
    list(tidy(lambda batches: batches)(iter([])))
    assert not KEPT


def test_texts_are_hashed_by_a_bounded_number_of_bytes(monkeypatch):
    seen = asked(monkeypatch, ngram_join, "grams", lambda data, ends, n: (len(ends) - 1, len(data)))
    columns = [pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS), pa.array([0] * len(TEXTS), pa.int64())]
    dealt = list(ngram_join._dealt(5, 3, 2, 32)(iter([pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "mark"])])))
    assert all(n == 1 or size <= ngram_join.STEP for n, size in seen) and sum(n for n, _ in seen) == len(TEXTS)
    sizes = [np.frombuffer(x, np.uint32) for b in dealt for x, ids in zip(b["sizes"].to_pylist(), b["ids"].to_pylist()) if ids]
    words = [(x or "").split() for x in TEXTS]
    want = [len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) or min(1, len(w)) for w in words]
    assert np.concatenate(sizes).tolist() == want


def block(grams, counts, rows):
    parts = {
        "grams": grams.view(np.uint8).reshape(-1, 8)[:, : ngram_join.GRAM_BYTES].tobytes(),
        "counts": counts.astype(np.uint32).tobytes(), "rows": rows.tobytes(), "sizes": counts.astype(np.uint32).tobytes(),
    }
    names = ["block", "grams", "counts", "rows", "sizes", "ids", "marks"]
    return pa.table({x: pa.array([0] if x == "block" else [parts.get(x)], pa.int32() if x == "block" else pa.binary()) for x in names})


def test_a_block_takes_rows_only_of_shared_grams():
    """Rows and sizes are not spread over the grams that stand once, which are most."""
    count = 400_000
    grams = np.arange(count, dtype=np.uint64)
    grams[-1] = grams[5]
    table = block(grams, np.full(count // 100, 100), np.arange(count // 100, dtype=np.int64))
    tracemalloc.start()
    found = ngram_join._shared_columns((pa.scalar(0),), table, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.frombuffer(found["rows"][0].as_py(), np.int64).tolist() == [0, count // 100 - 1]
    assert np.frombuffer(found["counts"][0].as_py(), np.uint32).tolist() == [2, 2]
    assert peak < 40 * count  # bytes a gram


def test_texts_without_a_word_make_blocks_without_grams(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (None, " \n"), (2, "")], "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.linked(docs).collect()), key=repr)
    assert got == [(1, 0, 1), (2, 0, 2), (2, 0, 2), (None, 0, None)]
    assert ngram_join.without_copies(docs).count() == 4
