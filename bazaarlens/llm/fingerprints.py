"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs, the pieces between line feeds. A paragraph is
hashed to a wide vector, and the fingerprint is the sum of the vectors modulo powers of two:

* EXACT lanes of 16 bits, cut from a 512-bit hash of the paragraph, summed modulo 2^16;
* NEAR lanes of 32 bits: every window of WINDOW bytes inside the paragraph adds +1 or -1 to
  one lane, summed modulo 2^32.

So equal multisets have equal fingerprints whatever the order, and a paragraph is inserted
or deleted by adding or subtracting its vector (`add`, `remove`). The first lanes carry the
equality. The others are a linear sketch of the windows: the squared length of a difference
estimates by how many windows two documents differ, which gives the likeness

    1 - |a - b|^2 / (|a|^2 + |b|^2), cut to 0 .. 1,

with an error of about sqrt(2 / NEAR).

Edge cases: a null text counts as empty, and so has the fingerprint of one empty paragraph.
Texts that are equal up to the order of paragraphs have equal fingerprints. A very long text
is the sum of its paragraphs, and a very long paragraph is read in pieces. Repeated rows and
other columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import STEP_BYTES, range_bounds, range_number, shuffle_partitions

EXACT, NEAR, WINDOW = 32, 256, 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The exact and near lanes of each text."""
    exact = np.zeros((len(texts), EXACT), np.uint16)
    near = np.zeros((len(texts), NEAR), np.uint32)
    first = 0
    while first < len(texts):
        if len(texts[first]) > STEP_BYTES:
            exact[first], near[first] = _long(texts[first])
            first += 1
            continue
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= STEP_BYTES):
            size += len(texts[last]) + 1
            last += 1
        exact[first:last], near[first:last] = _step(texts[first:last])
        first = last
    return exact, near


def _long(text: bytes, most: int = STEP_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """The lanes of a long text: the sum over its paragraphs, a few at a time."""
    exact, near = np.zeros(EXACT, np.uint16), np.zeros(NEAR, np.uint32)
    at = 0
    while at <= len(text):
        end = text.rfind(b"\n", at, at + most) if at + most < len(text) else len(text)
        if end < 0:  # a long paragraph: its hash, and its windows in pieces
            end = text.find(b"\n", at + most)
            end = len(text) if end < 0 else end
            exact += np.frombuffer(hashlib.blake2b(text[at:end]).digest(), np.uint16)
            for a in range(at, end, most):
                near += _step([text[a : min(a + most + WINDOW - 1, end)]])[1][0]
                if a + most < end:  # the next piece has these windows whole
                    near -= _step([text[a + most : min(a + most + WINDOW - 1, end)]])[1][0]
        else:
            more = _step([text[at:end]])
            exact += more[0][0]
            near += more[1][0]
        at = end + 1
    return exact, near


def _step(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    rows = len(texts)
    split = [t.split(b"\n") for t in texts]
    digests = b"".join(hashlib.blake2b(p).digest() for ps in split for p in ps)
    starts = np.concatenate([[0], np.cumsum([len(ps) for ps in split])[:-1]])
    lanes = np.frombuffer(digests, np.uint16).reshape(-1, EXACT)
    exact = np.add.reduceat(lanes, starts, axis=0, dtype=np.uint16)
    # windows start anywhere but at a line feed, and end at one with zeros behind
    data = np.frombuffer(b"\n".join(texts) + b"\n" * WINDOW, np.uint8)
    size = len(data) - WINDOW + 1
    window = np.lib.stride_tricks.sliding_window_view(data, WINDOW).copy().view(np.uint64).reshape(-1)[:size]
    broken = np.flatnonzero(data == 10)
    room = (np.repeat(broken, np.diff(broken, prepend=-1)) - np.arange(len(data)))[:size]
    short = np.flatnonzero(room < WINDOW)
    beyond = 8 * (WINDOW - room[short]) % 64
    mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> beyond.astype(np.uint64)
    window[short] = np.where(room[short] > 0, window[short] & mask, 0)
    mixed = (window * _MIX) ^ (window * _MIX >> np.uint64(29))
    mixed = mixed * _MIX2 >> np.uint64(55)
    ends = np.cumsum([len(t) + 1 for t in texts])
    row = np.repeat(np.arange(rows), np.diff(np.concatenate([[0], ends])))
    size = min(size, len(row))
    use = (room[:size] > 0)
    slot = (row[:size] * (2 * NEAR) + mixed[:size].astype(np.int64))[use]
    counts = np.bincount(slot, minlength=rows * 2 * NEAR).reshape(rows, 2, NEAR)
    near = (counts[:, 0] - counts[:, 1]).astype(np.int64).astype(np.uint32)
    return exact, near


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of both multisets together."""
    return a[0] + b[0], a[1] + b[1]


def remove(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of a without the paragraphs of b."""
    return a[0] - b[0], a[1] - b[1]


def text_of(exact: np.ndarray, near: np.ndarray) -> list[str]:
    """Fingerprints as text: base64 of all lanes, least byte first."""
    return [base64.b64encode(e.astype("<u2").tobytes() + n.astype("<u4").tobytes()).decode() for e, n in zip(exact, near)]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """From 0 to 1, row by row; 1 for equal fingerprints."""
    x, y = (n[1].view(np.int32).astype(np.float64) for n in (a, b))
    apart, whole = ((a[1] - b[1]).view(np.int32).astype(np.float64) ** 2).sum(1), (x**2).sum(1) + (y**2).sum(1)
    near = np.clip(1 - apart / np.maximum(whole, 1), 0, 1)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    # different multisets never count as equal
    return np.where(same, 1.0, np.where(whole == 0, 0.0, np.minimum(near, 1 - 1e-9)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and the fingerprint of every text."""

    def map_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            made = text_of(*vectors([x.encode() for x in texts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(made, pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(map_texts, "doc_id long, n_chars long, fingerprint string")


def _prefix(text: Column) -> Column:
    """The first seven bytes as a number, which rises with the text."""
    first = F.hex(F.substring(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 1, 7))
    return F.conv(F.rpad(first, 14, "0"), 16, 10).cast("long")


def _ranges(docs: DataFrame, parts: int) -> Column:
    """The number of a row's range of key; a key that fills several ranges, such as that of rows
    without a doc_id, is cut further by the beginning of the text."""
    shares = [i / parts for i in range(1, parts)]
    found = [min(int(x), (1 << 63) - 1) for x in docs.approxQuantile("key", shares, 0.25 / parts)] if shares else []
    number = range_number(F.col("key"), sorted(set(found)))
    for key, times in sorted(Counter(found).items()):
        if times > 1:
            within = range_bounds(docs.where(F.col("key") == key), "prefix", times + 1)
            inside = range_number(F.col("prefix"), within)
            number += F.when(F.col("key") == key, inside).when(F.col("key") > key, len(within)).otherwise(0)
    return number


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text and the next document.

    The next document is the next in descending doc_id, the first again after the last;
    nulls stand last, and rows with one doc_id in the order of their texts. The edited text
    has the last floor(n / 2) code points replaced by the first as many of the next text.

    Documents are dealt into ranges of doc_id, and of the text where one doc_id or none has very
    many rows, with the first document of the following range at the end of each, sorted, and
    read as a stream; a task holds one batch.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = shuffle_partitions(spark)
    # ~x is -x - 1: the key rises where doc_id falls, and a null comes last
    docs = docs.withColumn("key", F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)))
    docs = docs.withColumn("prefix", _prefix(F.col("text")))
    docs = docs.withColumn("range", _ranges(docs, 4 * parts))
    # one row a range: where it begins, and the range before it, or the last for the first
    start = F.struct("key", "prefix")
    found = docs.groupBy("range").agg(F.min(start).alias("start")).orderBy("range").collect()
    firsts = [(r["range"], r["start"]) for r in found]
    begin = [F.struct(*[F.lit(s[x]).cast("long").alias(x) for x in ("key", "prefix")]) for _, s in firsts]
    place = F.array_position(F.array(*begin), start)
    ranges = F.array(*[F.lit(firsts[i - 1][0]) for i in range(len(firsts))])
    before = F.try_element_at(ranges, F.nullif(place.cast("int"), F.lit(0)))
    deal = F.array(
        F.struct("range", F.lit(False).alias("guest")), F.struct(before.alias("range"), F.lit(True).alias("guest"))
    )
    dealt = docs.withColumn("copy", F.explode(F.filter(deal, lambda x: x["range"].isNotNull())))
    dealt = dealt.select("doc_id", "text", "key", "copy.range", "copy.guest")
    dealt = dealt.repartitionByRange(parts, "range").sortWithinPartitions("range", "guest", "key", "text")

    def map_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows()
        held = None  # the last own row of the range, and the lanes of its text
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ranges, guests = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            exact, near = vectors([x.encode() for x in texts])
            for i, at in enumerate(ranges):
                if held is not None and held[0] == at:
                    out.add(held, (texts[i], exact[i], near[i]))
                # only the first guest of a range is anybody's next
                held = (at, ids[i], texts[i], exact[i], near[i]) if not guests[i] else None
                if out.full():
                    yield out.batch()
        yield out.batch()

    return dealt.select("doc_id", "text", "range", "guest").mapInArrow(map_pairs, _Rows.SCHEMA)


class _Rows:
    """Pairs that wait for their edited text to be fingerprinted, a batch at a time."""

    SCHEMA = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, following: tuple) -> None:
        _, doc_id, text, exact, near = row
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[0][:half]).encode()
        self.rows.append((doc_id, len(text), edited, exact, near, following[1], following[2]))
        self.size += len(edited)

    def full(self) -> bool:
        return self.size > STEP_BYTES or len(self.rows) >= 2000

    def batch(self) -> pa.RecordBatch:
        rows, self.rows, self.size = self.rows, [], 0
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in self.SCHEMA.split(", ")]
        if not rows:
            return pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names)
        ids, sizes, edited, *lanes = zip(*rows)
        own, after = tuple(map(np.stack, lanes[:2])), tuple(map(np.stack, lanes[2:]))
        changed = vectors(list(edited))
        columns = [
            ids, sizes, [hashlib.sha256(x).hexdigest() for x in edited],
            text_of(*own), text_of(*changed), likeness(own, changed), likeness(own, after),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
