"""Aligns the tokens of two tokenizers over whole texts and counts linked pairs corpus-wide.

Tokenizer A is a byte-level BPE, B a sentencepiece model with byte fallback. Both read a blank and
the text, so their tokens cover the same bytes. Where tokens of both end, a group ends; every A
token and B token that share bytes are linked.

1. Neither vocabulary joins what stands before a single blank with that blank, so a text is a
   sequence of units that begin with a blank, with groups inside units. A Python worker aligns each
   different unit once (`units.Known`).
2. External spill counting. A task gathers records (pair of ids, document, times) and, every RUN
   records, radix-partitions them by B id into runs, sorted by B id, A id and document and
   compressed with zstd. A run's head has its pairs with their sums.
3. The heads of a radix are merged, FAN_IN at a time and level by level, by a heap over their
   blocks, which adds up each pair. The last merge comes out B-major, so the end of a B id gives its
   highest count. A radix's pairs are bounded by the vocabularies, not by the corpus.
4. The counts stream back: the runs of a radix, FAN_IN at a time, are read against its counts, and
   add what their pairs contribute to each document; the parts of a document meet with its row.

A hot pair is one entry of each run's head. Groups of runs and of one dealing's parts are bounded
by FAN_IN, RUN and RADIXES whatever the table's size.

Edge cases: a text that is null or empty, or whose joined token bytes of A or B differ from the
blank and the text, has no tokens: all numbers are zero and the groups are ''. Strings of special
tokens are plain text. Very long texts are cut at blanks; a stretch without a blank is held
whole. Rows that share a doc_id, and null ones, are documents of their own. Equal counts are all
highest. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import KEPT, tidy, written
from bazaarlens.llm.hashing import PrefixHash
from bazaarlens.llm.units import Known, Ragged, byte_characters, stretches

#: Records of a dealing, radixes of B ids, runs merged at a time.
RUN, RADIXES, FAN_IN = 1 << 20, 64, 64
#: Pairs of a block of a run that a merge holds.
BLOCK = 1 << 14
#: Bits of a document's number in its dealing.
_DOC_BITS = 20
#: Fixed value: how a byte-level BPE splits texts.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of more than one byte.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SPACE = np.zeros(256, bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True


class ByteLevel:
    """Ids of a byte-level BPE file and the bytes of each; special tokens are plain text."""

    def __init__(self, path: str):
        with open(path) as file:
            told = json.load(file)
        model, split = told["model"], told["pre_tokenizer"] or {}
        plain = not told["normalizer"] and split.get("use_regex") and not split.get("add_prefix_space")
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or not plain or model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is no byte-level BPE")
        raw = {c: bytes([b]) for b, c in byte_characters().items()}
        added = {x["content"] for x in told.get("added_tokens") or []}
        ids = {b"".join(raw[c] for c in x): i for x, i in model["vocab"].items() if x not in added}
        made = ["".join(x.split(" ") if isinstance(x, str) else x) for x in model["merges"]]
        ranks = {x: i for i, x in enumerate([*(bytes([b]) for b in range(256)), *(b"".join(raw[c] for c in x) for x in made)])}
        if len(ranks) != 256 + len(made):
            raise ValueError(f"a token of {path} has two merges")
        import tiktoken

        self.merges = tiktoken.Encoding("merges", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.id_of = np.array([ids[x] for x in ranks])
        self.size = int(self.id_of.max()) + 1
        self.bytes = [b""] * self.size
        for x, rank in ranks.items():
            self.bytes[self.id_of[rank]] = x

    def encode(self, text: str) -> np.ndarray:
        return self.id_of[np.array(self.merges.encode_ordinary(text), np.int64)]


class Pieces:
    """Ids of a sentencepiece model, which puts a blank before the text, and the bytes of each."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.bytes = []
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


class Aligner:
    """Numbers, links and group texts of units, each different one aligned once."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.size_a, self.size_b = (np.array([len(x) for x in t.bytes]) for t in (self.a, self.b))
        most = max(self.a.size, self.b.size)
        self.told = [b"%d%b" % (i, end) for end in (b",", b"|", b";") for i in range(most)]
        self.most = most
        # of each unit: n_a, n_b, n_groups, n_links, whether a tokenizer loses bytes
        self.numbers = np.zeros((1 << 12, 5), np.int64)
        self.pairs, self.groups = Ragged(np.uint64), []
        self.known = Known(self._learn, self._keep)

    def _keep(self, rows: np.ndarray) -> None:
        self.pairs.keep(rows)
        self.groups = [self.groups[i] for i in rows.tolist()]
        self.numbers[: len(rows)] = self.numbers[rows]

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """A's ids, B's ids and the lengths in bytes of the units that keep their bytes, behind
        one another, and which these are."""
        joined = "".join(units)
        raw = joined.encode()
        a, b = self.a.encode(joined), self.b.encode(joined[1:])
        lengths = np.array([len(u.encode()) for u in units])
        if b"".join([self.a.bytes[i] for i in a]) == raw and b"".join([self.b.bytes[i] for i in b]) == raw:
            cuts = np.cumsum(lengths)
            if np.isin(cuts, np.cumsum(self.size_a[a])).all() and np.isin(cuts, np.cumsum(self.size_b[b])).all():
                return a, b, lengths, list(range(len(units)))
        if len(units) == 1:
            none = np.zeros(0, np.int64)
            return none, none, none, []
        # a unit that loses bytes is found by halving
        half = len(units) // 2
        x, y = self._encoded(units[:half]), self._encoded(units[half:])
        return *(np.concatenate([p, q]) for p, q in zip(x[:3], y[:3])), [*x[3], *(half + i for i in y[3])]

    def _learn(self, places: np.ndarray) -> None:
        raw, start, stop = self.step
        units = [raw[p:q].decode() for p, q in zip(start[places].tolist(), stop[places].tolist())]
        odd = {i for i, u in enumerate(units) if u[1:2].isspace() or u[-1].isspace()}
        # what stands between other units is read in a row; a unit with blanks at its edge, alone
        parts = [([i for i in range(len(units)) if i not in odd]), *([i] for i in odd)]
        found = [(p, self._encoded([units[i] for i in p])) for p in parts if p]
        order = np.array([p[i] for p, x in found for i in x[3]], np.int64)
        a, b, lengths = (np.concatenate([x[k] for _, x in found]) for k in range(3))
        numbers, keys, counts, texts = self._aligned(a, b, lengths)
        own = Ragged(np.uint64)
        own.add(keys, counts)
        own.add(np.zeros(0, np.uint64), np.zeros(1, np.int64))
        at = np.full(len(units), len(order))
        at[order] = np.arange(len(order))
        self.pairs.add(*own.take(at))
        lost = np.array([[0, 0, 0, 0, 1]])
        rows = len(self.groups)
        texts.append(b"")
        self.groups += [texts[i] for i in at.tolist()]
        while len(self.groups) > len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
        self.numbers[rows : len(self.groups)] = np.concatenate([numbers, lost])[at]

    def _aligned(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray):
        """Of units behind one another: numbers, links as pair keys, links a unit, group texts."""
        total, n = int(lengths.sum()), len(lengths)
        stop_a, stop_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        is_a, is_b = np.zeros(total + 1, np.int64), np.zeros(total + 1, np.int64)
        is_a[stop_a] = is_b[stop_b] = 1
        both = is_a & is_b
        upto_a, upto_b, groups = np.cumsum(is_a), np.cumsum(is_b), np.cumsum(both)
        of = np.concatenate([[0], np.repeat(np.arange(n), lengths)])  # the unit of a byte's end
        end = np.flatnonzero(is_a | is_b)
        in_a, in_b = upto_a[end] - is_a[end], upto_b[end] - is_b[end]
        keys = (b[in_b] * self.a.size + a[in_a]).astype(np.uint64)
        count = lambda ends: np.bincount(of[ends], minlength=n)
        links = count(end)
        numbers = np.stack([count(stop_a), count(stop_b), count(np.flatnonzero(both)), links, np.zeros(n, np.int64)], 1)
        # the tokens in the order of the groups' text: A's of a group, then B's
        group_a, group_b = groups[stop_a] - both[stop_a], groups[stop_b] - both[stop_b]
        told = np.zeros(len(a) + len(b), np.int64)
        told[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = a + self.most * both[stop_a]
        told[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = b + 2 * self.most * both[stop_b]
        words = [self.told[i] for i in told.tolist()]
        cuts = np.cumsum(numbers[:, 0] + numbers[:, 1]).tolist()
        texts = [b"".join(words[p:q])[:-1] for p, q in zip([0, *cuts], cuts)]
        return numbers, keys, links, texts

    def read(self, held: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the units of pieces of texts, and where each piece begins among them."""
        raw = "".join([" " + x for x in held]).encode()
        data = np.frombuffer(raw, np.uint8)
        sizes = np.array([len(x.encode()) + 1 for x in held])
        starts = np.cumsum(sizes) - sizes
        space = _SPACE[data]
        near = space | (data >= 128) if any(_WIDE_SPACE.search(x) for x in held) else space
        cut = np.zeros(len(data), bool)
        cut[1:-1] = (data[1:-1] == 0x20) & ~near[:-2] & ~near[2:]
        cut[starts] = True
        # a blank right after a piece's own is no cut, and neither is one right before the next
        begin = np.flatnonzero(cut)
        stop = np.append(begin[1:], len(data))
        hashes, one, which = np.unique(PrefixHash(data).pieces(begin, stop), return_index=True, return_inverse=True)
        self.step = raw, begin[one], stop[one]
        return self.known.rows(hashes)[which], np.searchsorted(begin, starts)


def _aligner(a_path: str, b_path: str) -> Aligner:
    """One for all tasks of a Python worker, with the units it knows."""
    if (a_path, b_path) not in KEPT:
        KEPT[a_path, b_path] = Aligner(a_path, b_path)
    return KEPT[a_path, b_path]


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on, in as few bytes as the largest needs, compressed."""
    size = next(s for s in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * s)
    return bytes([size]) + zstandard.ZstdCompressor(level=3).compress(values.astype(f"<u{size}").tobytes())


def unpack(packed: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(packed[1:])
    return np.frombuffer(raw, f"<u{packed[0]}").astype(np.uint64)


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys with the sums of their times."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first)


_DOCUMENT = "struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>"
_FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
_PACKED = ["keys", "sums", "spans", "docs", "times"]
_DEALT = "dealing long, radix int, " + ", ".join(f"{x} binary" for x in _PACKED) + f", documents array<{_DOCUMENT}>"
_DOCUMENTS = pa.list_(pa.struct([pa.field(x, pa.string() if x == "groups_sha256" else pa.int64()) for x in _FIELDS]))


class Dealing:
    """Documents of a task and their records, until there are enough for a dealing."""

    def __init__(self, size_a: int, size_b: int, radixes: int):
        self.size_a, self.size_b, self.radixes = size_a, size_b, radixes
        self.clear()

    def clear(self) -> None:
        self.documents: list[tuple] = []
        self.without: list[int] = []  # documents without tokens
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, docs: np.ndarray, times: np.ndarray) -> None:
        found = summed(keys << np.uint64(_DOC_BITS) | docs.astype(np.uint64), times)
        self.keys.append(found[0])
        self.times.append(found[1])
        self.held += len(keys)
        if self.held > 4 * RUN:  # of a long text
            found = summed(np.concatenate(self.keys), np.concatenate(self.times))
            self.keys, self.times, self.held = [found[0]], [found[1]], min(len(found[0]), 2 * RUN)

    def batch(self, number: int) -> pa.RecordBatch:
        """The runs of all radixes, and the documents."""
        keys, times = summed(np.concatenate([np.zeros(0, np.uint64), *self.keys]), np.concatenate([np.zeros(0, np.int64), *self.times]))
        docs = (keys & np.uint64((1 << _DOC_BITS) - 1)).astype(np.int64)
        stays = ~np.isin(docs, self.without)
        keys, docs, times = keys[stays] >> np.uint64(_DOC_BITS), docs[stays], times[stays]
        radix = (keys // np.uint64(self.size_a)) % np.uint64(self.radixes)
        order = np.argsort(radix, kind="stable")
        cuts = np.searchsorted(radix[order], np.arange(self.radixes + 1))
        out: dict[str, list] = {x: [] for x in ("radix", *_PACKED)}
        for r in range(self.radixes):
            own = order[cuts[r] : cuts[r + 1]]
            if len(own):
                key, doc, n = keys[own], docs[own], times[own]
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                pairs = key[first]
                out["radix"].append(r)
                for name, values in (
                    ("keys", np.diff(pairs, prepend=np.uint64(0))),
                    ("sums", np.add.reduceat(n, first)),
                    ("spans", np.diff(np.append(first, len(key)))),
                    ("docs", doc),
                    ("times", n),
                ):
                    out[name].append(pack(values))
        rows = len(out["radix"])
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (rows + 1), pa.int64()),
                pa.array([*out["radix"], None], pa.int32()),
                *(pa.array([*out[x], None], pa.binary()) for x in _PACKED),
                pa.array([*[None] * rows, [dict(zip(_FIELDS, d)) for d in self.documents]], _DOCUMENTS),
            ],
            ["dealing", "radix", *_PACKED, "documents"],
        )
        self.clear()
        return batch


def dealt(docs: DataFrame, a_path: str, b_path: str, *, run: int = RUN, radixes: int = RADIXES) -> DataFrame:
    """The runs of every dealing, and its documents with what they need no counts for."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = _aligner(a_path, b_path)
        dealing = Dealing(aligner.a.size, aligner.b.size, radixes)
        number = TaskContext.get().partitionId() << 32
        numbers, groups = np.zeros(5, np.int64), None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).fill_null("").to_pylist()
            full = [i for i, x in enumerate(texts) if x]
            dealing.documents += [(ids[i], 0, 0, 0, 0, "") for i, x in enumerate(texts) if not x]
            done = 0
            for held, ends in stretches([texts[i] for i in full]):
                rows, first = aligner.read(held)
                last = np.append(first[1:], len(rows))
                more = np.add.reduceat(aligner.numbers[rows], first)
                base = len(dealing.documents)
                closed = np.cumsum(ends) - ends
                of = np.repeat(closed + base, last - first)
                both, times = np.unique(of.astype(np.int64) << 32 | rows, return_counts=True)
                keys, counts = aligner.pairs.take(both & ((1 << 32) - 1))
                dealing.add(keys, np.repeat(both >> 32, counts), np.repeat(times, counts))
                for p, q, added, end in zip(first.tolist(), last.tolist(), more, ends):
                    numbers = numbers + added
                    text = b";".join([aligner.groups[i] for i in rows[p:q].tolist()])
                    if groups is None:
                        groups = hashlib.sha256(text)
                    else:
                        groups.update(b";" + text)
                    if end:
                        if numbers[4]:
                            dealing.without.append(len(dealing.documents))
                            dealing.documents.append((ids[full[done]], 0, 0, 0, 0, ""))
                        else:
                            dealing.documents.append((ids[full[done]], *numbers[:4].tolist(), groups.hexdigest()))
                        numbers, groups, done = np.zeros(5, np.int64), None, done + 1
                if ends[-1] and dealing.held >= run:
                    yield dealing.batch(number)
                    number += 1
            if len(dealing.documents) >= 1 << _DOC_BITS - 1:
                yield dealing.batch(number)
                number += 1
        if dealing.documents:
            yield dealing.batch(number)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tidy(read, keeps=True), _DEALT)


class Run:
    """A sorted run of pairs, read block by block."""

    def __init__(self, keys: bytes, sums: bytes, block: int):
        open_ = lambda packed: (packed[0], zstandard.ZstdDecompressor().stream_reader(io.BytesIO(packed[1:])))
        self.streams, self.block, self.last = (open_(keys), open_(sums)), block, 0
        self.load()

    def load(self) -> None:
        steps, self.sums = (
            np.frombuffer(stream.read(self.block * size), f"<u{size}").astype(np.uint64) for size, stream in self.streams
        )
        self.keys = np.cumsum(steps, dtype=np.uint64) + np.uint64(self.last)
        self.last = int(self.keys[-1]) if len(self.keys) else self.last

    def upto(self, key: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes what stands up to the key."""
        cut = int(np.searchsorted(self.keys, np.uint64(key), "right"))
        out = self.keys[:cut], self.sums[:cut]
        self.keys, self.sums = self.keys[cut:], self.sums[cut:]
        return out


def merged(runs: list[tuple[bytes, bytes]], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of all runs in order with their sums. The heap has the last key of the block that
    each run holds; no run can have more up to the least of these."""
    opened = [Run(*r, block) for r in runs]
    heap = [(int(r.keys[-1]), i) for i, r in enumerate(opened) if len(r.keys)]
    heapq.heapify(heap)
    while heap:
        key = heap[0][0]
        parts = [opened[i].upto(key) for _, i in heap]
        while heap and heap[0][0] == key:
            _, i = heapq.heappop(heap)
            opened[i].load()
            if len(opened[i].keys):
                heapq.heappush(heap, (int(opened[i].keys[-1]), i))
        yield summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def _heads(table: pa.Table) -> list[tuple[bytes, bytes]]:
    return list(zip(table["keys"].to_pylist(), table["sums"].to_pylist()))


_HEAD = pa.schema([("dealing", pa.int64()), ("radix", pa.int32()), ("keys", pa.binary()), ("sums", pa.binary())])


def _merged_run(key: tuple, table: pa.Table) -> pa.Table:
    """Runs of one radix as one run."""
    found = list(merged(_heads(table)))
    keys, sums = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    row = [[key[1].as_py()], [key[0].as_py()], [pack(np.diff(keys, prepend=np.uint64(0)))], [pack(sums)]]
    return pa.table(row, _HEAD)


def _with_maxima(key: tuple, table: pa.Table, size_a: int) -> pa.Table:
    """The counts of one radix, and which are the highest of their B id."""
    out: list[list[np.ndarray]] = [[], [], []]
    keys, sums = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def close(upto: int) -> None:
        """Pairs before the place, of B ids that have ended."""
        b = keys[:upto] // np.uint64(size_a)
        first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
        highest = np.repeat(np.maximum.reduceat(sums[:upto], first), np.diff(np.append(first, upto)))
        for place, values in zip(out, (keys[:upto], sums[:upto], (sums[:upto] == highest).astype(np.uint64))):
            place.append(values)

    for more, added in merged(_heads(table)):
        keys, sums = np.concatenate([keys, more]), np.concatenate([sums, added])
        ended = int(np.searchsorted(keys, keys[-1] // np.uint64(size_a) * np.uint64(size_a)))
        if ended:
            close(ended)
            keys, sums = keys[ended:], sums[ended:]
    if len(keys):
        close(len(keys))
    keys, sums, best = (np.concatenate(x) for x in out)
    packed = [pack(np.diff(keys, prepend=np.uint64(0))), pack(sums), pack(best)]
    return pa.table([[key[0].as_py()], *([x] for x in packed)], pa.schema([("radix", pa.int32()), *((x, pa.binary()) for x in ("keys", "sums", "best"))]))


_BACK = pa.schema([("dealing", pa.int64()), *((x, pa.binary()) for x in ("docs", "low", "high", "best"))])


def _contributions(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """What the pairs of each run give its documents."""
    out: dict[str, list] = {x: [] for x in _BACK.names}
    if runs.num_rows:
        pairs, sums, best = (unpack(counts[x][0].as_py()) for x in ("keys", "sums", "best"))
        pairs = np.cumsum(pairs, dtype=np.uint64)
        low, high = (sums & np.uint64((1 << 24) - 1)).astype(np.float64), (sums >> np.uint64(24)).astype(np.float64)
    for row in range(runs.num_rows):
        keys, spans, docs, times = (unpack(runs[x][row].as_py()) for x in ("keys", "spans", "docs", "times"))
        place = np.repeat(np.searchsorted(pairs, np.cumsum(keys, dtype=np.uint64)), spans.astype(np.int64))
        docs, times = docs.astype(np.int64), times.astype(np.float64)
        # sums of parts of 24 bits are exact in doubles
        parts = [np.bincount(docs, x[place] * times).astype(np.uint64) for x in (low, high, best.astype(np.float64))]
        has = np.flatnonzero(np.bincount(docs))
        out["dealing"].append(runs["dealing"][row].as_py())
        out["docs"].append(pack(np.diff(has, prepend=0)))
        for name, values in zip(("low", "high", "best"), parts):
            out[name].append(pack(values[has]))
    return pa.table(out, _BACK)


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finished(dealings: pa.Table, parts: pa.Table) -> pa.Table:
    """The documents of one dealing with the sums over its radixes."""
    documents = dealings["documents"].combine_chunks().flatten()
    n = len(documents)
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for row in range(parts.num_rows):
        docs, low, high, more = (unpack(parts[x][row].as_py()).astype(np.int64) for x in ("docs", "low", "high", "best"))
        at = np.cumsum(docs)
        best[at] += more
        total[at] += (high << 24) + low
    columns = dict(zip(_FIELDS, documents.flatten()))
    columns |= {"n_best": pa.array(best), "count_sum": pa.array(total)}
    return pa.table({x.split(" ")[0]: columns[x.split(" ")[0]] for x in _RESULT.split(", ")})


def aligned(
    docs: DataFrame, a_path: str, b_path: str, *, run: int = RUN, radixes: int = RADIXES, fan_in: int = FAN_IN
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    size_a = ByteLevel(a_path).size
    table = written(dealt(docs, a_path, b_path, run=run, radixes=radixes))
    documents = table.where("radix IS NULL").select("dealing", "documents")
    runs = table.where("radix IS NOT NULL")
    parts = lambda n: F.pmod(F.xxhash64("dealing"), F.lit(max(1, math.ceil(n / fan_in)))).cast("int")
    dealings = left = documents.count()
    heads = runs.select("dealing", "radix", "keys", "sums")
    while left > fan_in:
        heads = heads.groupBy(parts(left).alias("part"), "radix").applyInArrow(
            lambda key, t: _merged_run((key[1], key[0]), t), "dealing long, radix int, keys binary, sums binary"
        )
        left = math.ceil(left / fan_in)
    counts = heads.groupBy("radix").applyInArrow(
        lambda key, t: _with_maxima(key, t, size_a), "radix int, keys binary, sums binary, best binary"
    )
    whole = max(1, math.ceil(dealings / fan_in))
    counts = written(counts).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(whole - 1))))
    records = runs.select("dealing", "radix", "keys", "spans", "docs", "times", parts(dealings).alias("part"))
    back = records.groupBy("radix", "part").cogroup(counts.groupBy("radix", "part"))
    back = back.applyInArrow(_contributions, "dealing long, docs binary, low binary, high binary, best binary")
    return documents.groupBy("dealing").cogroup(back.groupBy("dealing")).applyInArrow(_finished, _RESULT)
