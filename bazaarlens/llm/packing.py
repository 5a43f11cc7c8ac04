"""Packing documents into sequences along a space-filling curve.

1. Every text is tokenised once; its ids, ended by END, are written to the shared folder
   with a vector of DIMENSIONS numbers: each id has random weights, a fixed hash, and the
   vector is their sum over the document divided by the root of its length.
2. The vectors are centred and scaled over the corpus, cut into cells, and the cell's place
   on a Hilbert curve is the document's key, with a hash of doc_id behind it to keep equal
   documents apart. Documents are range-sorted by the key, so neighbours are alike.
3. Along the curve the tokens form one stream, cut every `length` tokens; a document's place
   in it is the number of tokens before it: the total of the ranges before its own, and a
   running sum inside the range. The end of the stream is cut into powers of two. So no
   sequence needs padding.

Only light columns are read to find ranges and totals, one number a range reaches the
driver, and a task holds one batch. Each range has about as many documents as another.

Edge cases: a null or empty text has END alone. A text longer than a sequence is cut over
several. Repeated rows are packed each by itself. A null doc_id stays null. An empty table
gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import KEPT, range_bounds, range_number, shuffle_partitions, steps, tidy, written
from bazaarlens.llm.hashing import PrefixHash
from bazaarlens.llm.units import Known, Ragged, byte_characters, pieces, stretches

END, LENGTH = 2, 4096
DIMENSIONS, BITS = 4, 10
#: Characters of the texts that are tokenised at a time, or one text.
STEP = 1 << 17
#: What keeps a text from being split here: characters that do not lower-case and normalise
#: one by one, alike in every Unicode version; special tokens; contractions.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\u012f\u0131-\u017f]")
_SPECIAL = re.compile("<\\||'(?:[stmdSTMD]|[rR][eE]|[vV][eE]|[lL][lL])")
#: Fixed value: how the tokenizer's file splits words.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for the usual characters: white space, letters, numbers, others; END_MARK ends a text.
_SPACE, _LETTER, _NUMBER, _OTHER, _END_CLASS = range(5)
END_MARK = "\x01"
_LAST = END_MARK.encode()
_CLASS = np.array(
    [
        _END_CLASS
        if c == 1
        else {"L": _LETTER, "N": _NUMBER}.get(
            unicodedata.category(chr(c))[0], _SPACE if chr(c).isspace() else _OTHER
        )
        for c in range(0x180)
    ],
    np.int8,
)


class Encoder:
    """Ids of texts by a tokenizer's file, without special tokens.

    If the file lower-cases and splits words as expected, texts of usual characters are split
    here by numpy, and the merges are applied once to each different word; any other text goes to
    the tokenizer, cut at blanks if it is long. Words are told apart by hashes of their characters.

    The merges are tiktoken's, by ranks: a word's last byte and its end mark form a token first, and a
    token's rank is its place among the file's merges, each of which makes a token of its own.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path) as file:
            told = json.load(file)
        self.path, self.whole, self.merges = path, None, None
        model, end_mark = told["model"], told["model"].get("end_of_word_suffix")
        added = {x["content"]: x["id"] for x in told.get("added_tokens") or []}
        self.size = max([*model["vocab"].values(), *added.values()]) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        splits = [x.get("pattern", {}).get("Regex") for x in (told["pre_tokenizer"] or {}).get("pretokenizers", [])]
        kinds = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [])]
        if kinds == ["NFC", "Replace", "Lowercase"] and splits == [_SPLIT, None] and end_mark:
            self._read_merges(model, end_mark, added)
        self.by_word = self.merges is not None
        self.pool, self.sums, self.weights = Ragged(self.kind), np.zeros((1 << 12, DIMENSIONS)), _weights(self.size)
        self.known = Known(self._learn, self._keep)

    def _read_merges(self, model: dict, end_mark: str, added: dict[str, int]) -> None:
        raw = {c: bytes([b]) for b, c in byte_characters().items()}

        def spelled(token: str) -> bytes:
            ends = token.endswith(end_mark)
            token = token[: -len(end_mark)] if ends else token
            return b"".join(raw[c] for c in token) + (_LAST if ends else b"")

        made = [spelled(a) + spelled(b) for a, b in (x.split(" ") if isinstance(x, str) else x for x in model["merges"])]
        single = [bytes([b]) for b in range(256)]
        ranks = {x: i for i, x in enumerate([*single, *(x + _LAST for x in single if x != _LAST), *made])}
        ids = {spelled(x): i for x, i in model["vocab"].items() if x not in added}
        if len(ranks) != 511 + len(made) or not all(x in ids for x in ranks if _LAST not in x[:-1] and x != _LAST):
            return  # a token has two merges, or none
        self.id_of = np.array([END if x == _LAST else ids.get(x, 0) for x in ranks])
        self.ends = np.array([x.endswith(_LAST) for x in ranks])
        import tiktoken

        pattern = f"[^{END_MARK}]*{END_MARK}"
        self.merges = tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def _keep(self, rows: np.ndarray) -> None:
        self.pool.keep(rows)
        self.sums[: len(rows)] = self.sums[rows]

    def _learn(self, places: np.ndarray) -> None:
        """The ids of the words at these places of the different ones of this step, and the sum
        of their weights."""
        whole, start, stop = self.step
        words = [whole[a:b] for a, b in zip(start[places].tolist(), stop[places].tolist())]
        ended = "".join(w if w == END_MARK else w + END_MARK for w in words)
        ranks = np.array(self.merges.encode_ordinary(ended), np.int64)
        ids, stops = self.id_of[ranks], np.flatnonzero(self.ends[ranks]) + 1
        starts = np.concatenate([[0], stops[:-1]])
        rows = self.pool.rows
        self.pool.add(ids.astype(self.kind), stops - starts)
        while self.pool.rows > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        self.sums[rows : self.pool.rows] = np.add.reduceat(self.weights[ids].astype(np.float64), starts)

    def _usual(self, held: list[str], ends: list[bool]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of texts of usual characters, with END, and the sums of their weights; the last
        text may go on."""
        whole = "".join(x.lower() + (END_MARK if e else " ") for x, e in zip(held, ends))
        codes = np.frombuffer(whole.encode("utf-16-le"), "<u2")
        kind = _CLASS[codes]
        new = np.ones(len(kind) + 1, bool)
        new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER) | (kind[1:] == _END_CLASS)
        word = kind != _SPACE
        start, stop = np.flatnonzero(new[:-1] & word), np.flatnonzero(new[1:] & word) + 1
        if not len(start):
            return [np.zeros(0, self.kind)], np.zeros((1, DIMENSIONS))
        hashes, one, which = np.unique(PrefixHash(codes).pieces(start, stop), return_index=True, return_inverse=True)
        self.step = whole, start[one], stop[one]
        row = self.known.rows(hashes)[which]
        ids, count = self.pool.take(row)
        cut = np.flatnonzero(kind[start] == _END_CLASS) + 1
        first = np.concatenate([[0], cut[cut < len(start)]])
        return np.split(ids, np.cumsum(count)[first[1:] - 1]), np.add.reduceat(self.sums[row], first)

    def _tokenizer(self):
        """The tokenizer itself, loaded when the first text needs it."""
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return self.whole

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text, END included, and the sum of their weights."""
        usual = [i for i, x in enumerate(texts) if self.by_word and not _UNUSUAL.search(x) and not _SPECIAL.search(x)]
        out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        parts: list[np.ndarray] = []
        total, done = np.zeros(DIMENSIONS), 0
        for held, ends in stretches([texts[i] for i in usual]):
            found, sums = self._usual(held, ends)
            for k, (ids, added) in enumerate(zip(found, sums)):
                parts.append(ids)
                total = total + added
                if k < sum(ends):
                    out[usual[done]] = np.concatenate(parts), total
                    parts, total, done = [], np.zeros(DIMENSIONS), done + 1
        for i, x in enumerate(texts):
            if i not in out:
                cut = [x] if not self.by_word or _SPECIAL.search(x) else pieces(x)
                ids = [y for p in cut for y in self._tokenizer().encode(p, add_special_tokens=False).ids]
                ids = np.array([*ids, END], self.kind)
                out[i] = ids, self.weights[ids].sum(0, dtype=np.float64)
        return [out[i] for i in range(len(texts))]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, END included."""
        return [ids for ids, _ in self.encoded(texts)]


def _encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker, with the words it knows."""
    if path not in KEPT:
        KEPT[path] = Encoder(path)
    return KEPT[path]


def _weights(size: int) -> np.ndarray:
    return np.random.default_rng(5).normal(0, 1, (size, DIMENSIONS)).astype(np.float32)


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, tokens (count), ids (packed), x (vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for whole in batches:
            texts = [x or "" for x in whole.column(1).to_pylist()]
            for first, last in steps(np.cumsum([0, *map(len, texts)]), STEP):
                batch = whole.slice(first, last - first)
                found = encoder.encoded(texts[first:last])
                packed, counts = [x.tobytes() for x, _ in found], [len(x) for x, _ in found]
                vectors = [(total / len(x) ** 0.5).tolist() for x, total in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(vectors, pa.list_(pa.float64()))],
                    ["doc_id", "tokens", "ids", "x"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(run, keeps=True), "doc_id long, tokens long, ids binary, x array<double>")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells, given as rows of coordinates below 2 ** bits.

    From the lowest cell of each cube, the axes are exchanged or turned as the curve turns
    there; what remains, read across the axes bit by bit, is the place in Gray code.
    """
    axes = [c.astype(np.int64) for c in cells.T]
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(len(axes)):
            upper = (axes[i] & q) != 0
            swap = (axes[0] ^ axes[i]) & low
            turned = axes[0] ^ low
            axes[0] = np.where(upper, turned, axes[0] ^ swap)
            if i:
                axes[i] = np.where(upper, axes[i], axes[i] ^ swap)
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(axes[-1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    place = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for a in axes:
            place = place << 1 | ((a ^ turn) >> level & 1)
    return place


def _cuts(total: int, length: int) -> np.ndarray:
    """Where the sequences after the last whole one start: its rest in powers of two."""
    start, rest = total - total % length, total % length
    found = [start]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            found.append(found[-1] + (1 << bit))
    return np.array(found)


def packed(docs: DataFrame, path: str, *, length: int = LENGTH) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    length must be a power of two.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    table = written(tokenised(docs, path))
    each = [F.element_at("x", i + 1) for i in range(DIMENSIONS)]
    told = table.agg(F.sum("tokens"), *[F.avg(x) for x in each], *[F.stddev_pop(x) for x in each]).first()
    total = told[0] or 0
    mean = np.array([x or 0.0 for x in told[1 : 1 + DIMENSIONS]])
    spread = np.array([x or 1.0 for x in told[1 + DIMENSIONS :]])

    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        scaled = (np.stack(x.to_numpy()) - mean) / spread if len(x) else np.zeros((0, DIMENSIONS))
        cells = np.clip((scaled + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        return pd.Series(hilbert(cells, BITS))

    spare = 62 - DIMENSIONS * BITS
    behind = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << spare) - 1))
    keyed = table.withColumn("key", F.shiftleft(place("x"), spare).bitwiseOR(behind)).drop("x")
    bounds = range_bounds(keyed, "key", 4 * parts)
    ranged = keyed.withColumn("range", range_number(F.col("key"), bounds))
    sums = {r["range"]: r["sum"] for r in ranged.groupBy("range").agg(F.sum("tokens").alias("sum")).collect()}
    base = np.concatenate([[0], np.cumsum([sums.get(i, 0) for i in range(len(bounds) + 1)])])
    ends = _cuts(total, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        now, at = None, 0
        for batch in batches:
            out: dict[str, list] = {x: [] for x in names}
            for doc_id, tokens, ids, number in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "tokens", "ids", "range"))):
                if number != now:
                    now, at = number, int(base[number])
                kind = "<u2" if len(ids) == 2 * tokens else "<u4"
                four = np.frombuffer(ids, kind).astype("<u4")
                done = 0
                while done < tokens:
                    if at < ends[0]:
                        sequence, offset, room = at // length, at % length, length - at % length
                    else:
                        i = int(np.searchsorted(ends, at, "right")) - 1
                        sequence, offset, room = ends[0] // length + i, at - ends[i], ends[i + 1] - at
                    take = int(min(room, tokens - done))
                    crc = zlib.crc32(four[done : done + take].tobytes())
                    for name, value in zip(names, (doc_id, done, take, crc, tokens, int(sequence), int(offset))):
                        out[name].append(value)
                    done, at = done + take, at + take
            yield pa.RecordBatch.from_arrays([pa.array(out[x], pa.int64()) for x in names], names)

    dealt = ranged.repartitionByRange(parts, "range").sortWithinPartitions("range", "key", "doc_id")
    return dealt.select("doc_id", "tokens", "ids", "range").mapInArrow(
        tidy(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
