"""Removes every byte that lies in a string of SPAN bytes which also starts elsewhere.

Suffixes are compared by prefix polynomial hashes: a binary search over the length finds how
far two suffixes agree, so a comparison takes log2(SPAN) hash lookups. Sorting all suffixes
of a corpus is not needed to that end. In three steps:

1. Anchors. Of the GRAM-byte pieces in each window of SPAN bytes the one with the least hash
   is the window's anchor, so equal windows have equal anchors at equal places. Neighbouring
   windows with one anchor are a run; its context is all bytes the run covers. Runs are dealt
   by anchor into blocks. A context that occurs twice repeats all windows of its runs. A run
   whose anchor, but not context, occurs elsewhere is open: it stands at an end of a match.
2. Suffix sort. For open runs, and one run of each repeated context they may match, the
   SPAN-byte windows are sorted as suffixes by a merge sort with hashed comparisons, inside groups of
   one anchor at one place. Neighbours that agree over SPAN bytes repeat each other; their
   bytes are compared, and after a collision the block is sorted again with other hashes.
3. All spans of a document are joined to its text and removed.

Hot groups: runs with one context are counted in each task, and only one goes on, so a
passage of a third of all documents sends one run a task. At the ends of such a passage an
anchor has as many contexts. An anchor with COMMON contexts in one dealing is called common;
its runs pass the block by, and their windows are matched one by one, by hashes of 128 bits,
again counted in each task before they meet. So no block gathers what more than about a
hundredth of the documents share.

Edge cases: matches never cross documents. A null text counts as empty; texts under SPAN
bytes lose nothing. Equal rows are copies of one another, so a long text in two equal rows
goes whole. A null doc_id stays null. Very long texts are read in overlapping pieces. An
empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import blocks_for, shuffle_partitions, steps, utf8, written
from bazaarlens.llm.hashing import PrefixHash, mixed

SPAN, GRAM = 200, 100
#: Pieces of a text that is longer; they overlap by SPAN - 1 bytes.
PIECE_LOG2 = 20
#: Runs that a task gathers before it deals them out.
GATHERED = 1 << 19
#: An anchor with so many contexts among them is common.
COMMON = 128
_RUN = np.dtype(
    [("anchor", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("start", "<u4")]
    + [(name, "u1") for name in ("more", "lead", "often", "mark")]
)
_FOUND = np.dtype([("start", "<u4"), ("end", "<u4")])
_OPEN = np.dtype([("anchor", "<u8"), ("start", "<u4"), ("more", "u1"), ("lead", "u1"), ("known", "u1"), ("common", "u1")])
_WINDOW = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("known", "<u4")])


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every so many neighbouring values."""
    width = 1
    out = values
    while 2 * width <= size:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs(data: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The runs of some texts of at most 2 ** PIECE_LOG2 bytes together."""
    count = len(data) - SPAN + 1
    if count <= 0:
        return np.zeros(0, _RUN)
    hashes = PrefixHash(data)
    gram = mixed(hashes.windows(GRAM))
    low = np.uint64((1 << PIECE_LOG2) - 1)
    # at equal hashes the first counts: the place stands in the low bits
    ranked = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    anchor = (_least(ranked, SPAN - GRAM + 1) & low).astype(np.int64)
    usable = np.zeros(len(data) + 1, np.int8)
    long = np.diff(ends) >= SPAN
    usable[ends[:-1][long]] += 1
    usable[ends[1:][long] - SPAN + 1] -= 1
    at = np.flatnonzero(np.cumsum(usable)[:count])
    if not len(at):
        return np.zeros(0, _RUN)
    own = anchor[at]
    text = np.searchsorted(ends, at, "right") - 1
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])]))
    start, last = at[new], at[np.append(new[1:], len(at)) - 1]
    out = np.zeros(len(new), _RUN)
    out["anchor"] = gram[own[new]]
    out["context"] = hashes.pieces(start, last + SPAN)
    out["doc"] = docs[text[new]]
    out["start"] = start - ends[text[new]]
    out["more"] = last - start
    out["lead"] = own[new] - start
    return out


def _pieces(data: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> Iterator[np.ndarray]:
    most = 1 << PIECE_LOG2
    for a, b in steps(ends, most):
        if ends[b] - ends[a] <= most:
            yield runs(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], docs[a:b])
            continue
        for start in range(int(ends[a]), int(ends[b]) - SPAN + 1, most - SPAN + 1):
            piece = data[start : min(start + most, int(ends[b]))]
            found = runs(piece, np.array([0, len(piece)]), docs[a:b])
            found["start"] += np.uint32(start - ends[a])
            yield found


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of sorted columns change, the start included."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _settled(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts runs by anchor and context; tells which contexts occur twice."""
    own = own[np.lexsort((own["context"], own["anchor"]))]
    first = _firsts(own["anchor"], own["context"])
    size = np.diff(np.append(first, len(own)))
    often = np.repeat(np.maximum.reduceat(own["often"], first) > 0, size) | (np.repeat(size, size) > 1)
    return own, often


def _by_doc(rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    rows = rows[np.argsort(rows["doc"], kind="stable")]
    cuts = [*_firsts(rows["doc"]).tolist(), len(rows)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(rows["doc"][a]), rows[a:b]


def _spans(rows: np.ndarray) -> bytes:
    """The bytes that runs cover, neighbours joined."""
    rows = rows[np.argsort(rows["start"], kind="stable")]
    start, end = rows["start"], rows["start"] + rows["more"] + np.uint32(SPAN)
    return _joined(start, end).tobytes()


def _joined(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sorted spans with those that touch or overlap as one."""
    out = np.zeros(0, _FOUND)
    if len(start):
        reach = np.maximum.accumulate(end)
        new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
        out = np.zeros(len(new), _FOUND)
        out["start"], out["end"] = start[new], reach[np.append(new[1:], len(start)) - 1]
    return out


def _opened(rows: np.ndarray, common: bool) -> bytes:
    part = np.zeros(len(rows), _OPEN)
    for name in ("anchor", "start", "more", "lead"):
        part[name] = rows[name]
    part["known"] = rows["often"]
    part["common"] = common
    return part.tobytes()


def _dealt(blocks: int, many: int):
    """Batches (doc, text) to packed runs by block of anchors, spans known already, and open
    runs of common anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []

        def deal() -> pa.RecordBatch:
            own = np.concatenate([np.zeros(0, _RUN), *gathered])
            gathered.clear()
            block_of: list[int] = []
            packed: list[bytes | None] = []
            doc_of: list[int | None] = []
            spans: list[bytes | None] = []
            opened: list[bytes | None] = []
            if len(own):
                own, often = _settled(own)
                for doc, rows in _by_doc(own[often]):
                    block_of.append(doc % blocks)
                    packed.append(None)
                    doc_of.append(doc)
                    spans.append(_spans(rows))
                    opened.append(None)
                first = _firsts(own["anchor"], own["context"])
                own["often"] = often
                own = own[first]
                first = _firsts(own["anchor"])
                size = np.diff(np.append(first, len(own)))
                common = np.repeat(size >= many, size)
                for doc, rows in _by_doc(own[common]):
                    block_of.append(doc % blocks)
                    packed.append(None)
                    doc_of.append(doc)
                    spans.append(None)
                    opened.append(_opened(rows, True))
                # the block is told by one marked entry
                marks = own[first[size >= many]]
                marks["mark"], marks["often"] = 1, 0
                own = np.concatenate([own[~common], marks])
                block = (own["anchor"] >> np.uint64(40)) % np.uint64(blocks)
                order = np.argsort(block, kind="stable")
                own, cuts = own[order], np.searchsorted(block[order], np.arange(blocks + 1, dtype=np.uint64))
                for b in np.flatnonzero(np.diff(cuts)):
                    block_of.append(int(b))
                    packed.append(own[cuts[b] : cuts[b + 1]].tobytes())
                    doc_of.append(None)
                    spans.append(None)
                    opened.append(None)
            columns = {"block": block_of, "runs": packed, "doc": doc_of, "spans": spans, "open": opened}
            kinds = [pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_pydict(columns, pa.schema(list(zip(columns, kinds))))

        held = 0
        for batch in batches:
            docs = batch.column(0).to_numpy()
            for found in _pieces(*utf8(batch.column(1)), docs):
                gathered.append(found)
                held += len(found)
                if held >= GATHERED:
                    yield deal()
                    held = 0
        yield deal()

    return run


_KNOWN = pa.schema([("doc", pa.int64()), ("spans", pa.binary()), ("open", pa.binary())])


def _matched(key: tuple, table: pa.Table) -> pa.Table:
    """One block of anchors: spans of repeated contexts, and open runs, by document."""
    kept = table.filter(pc.is_valid(table["doc"]))
    out: dict[str, list] = {x: kept[x].to_pylist() for x in ("doc", "spans", "open")}
    own = np.frombuffer(b"".join(x for x in table["runs"].to_pylist() if x), _RUN)
    common = np.unique(own["anchor"][own["mark"] > 0])
    own = own[own["mark"] == 0]
    if len(own):
        own, often = _settled(own)
        first = _firsts(own["anchor"])
        size = np.diff(np.append(first, len(own)))
        # an anchor with a run that is not settled and with another context
        unsettled = np.add.reduceat((~often).astype(np.int64), first)
        contexts = np.zeros(len(own), np.int64)
        contexts[_firsts(own["anchor"], own["context"])] = 1
        is_common = np.isin(own["anchor"], common)
        asks = np.repeat((unsettled > 0) & (np.add.reduceat(contexts, first) > 1), size) | is_common
        for doc, rows in _by_doc(own[often]):
            out["doc"].append(doc)
            out["spans"].append(_spans(rows))
            out["open"].append(None)
        chosen = asks & (~often | (contexts == 1))
        own["often"] = often
        for which in (False, True):
            for doc, rows in _by_doc(own[chosen & (is_common == which)]):
                out["doc"].append(doc)
                out["spans"].append(None)
                out["open"].append(_opened(rows, which))
    return pa.table(out, _KNOWN)


def _windows(raw: bytes, doc: int, rows: np.ndarray) -> np.ndarray:
    """All windows of some runs, with two hashes."""
    data = np.frombuffer(raw, np.uint8)
    count = rows["more"].astype(np.int64) + 1
    start = np.repeat(rows["start"].astype(np.int64) - np.cumsum(count) + count, count) + np.arange(count.sum())
    out = np.zeros(len(start), _WINDOW)
    out["h1"] = PrefixHash(data).pieces(start, start + SPAN)
    out["h2"] = Suffixes(data, 1).hashes.pieces(start, start + SPAN)
    out["doc"], out["start"], out["known"] = doc, start, np.repeat(rows["known"], count)
    return out


def _paired(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows sorted by their hashes; which occur twice."""
    own = own[np.lexsort((own["h2"], own["h1"]))]
    first = _firsts(own["h1"], own["h2"])
    size = np.diff(np.append(first, len(own)))
    twice = np.repeat((size > 1) | (np.maximum.reduceat(own["known"], first) > 0), size) if len(own) else np.zeros(0, bool)
    return own, twice


def _window_spans(own: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for doc, rows in _by_doc(own[own["known"] == 0]):
        at = np.sort(rows["start"])
        yield doc, _joined(at, at + np.uint32(SPAN)).tobytes()


_MET = "block int, runs binary, contexts binary, windows binary, doc long, spans binary"


def _contexts(blocks: int):
    """Batches (doc, text, open) to packed contexts of open runs by block of anchors; of
    common anchors to windows by block of hashes, and spans known already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _MET.split(", ")]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
        for batch in batches:
            out: list[tuple] = []
            found: list[np.ndarray] = []
            for doc, text, lists in zip(*(c.to_pylist() for c in batch.columns)):
                if not lists:
                    continue
                raw = text.encode()
                rows = np.unique(np.frombuffer(b"".join(lists), _OPEN))
                common = rows["common"] > 0
                if common.any():
                    found.append(_windows(raw, doc, rows[common]))
                rows = rows[~common]
                block = (rows["anchor"] >> np.uint64(40)) % np.uint64(blocks)
                for b in np.unique(block).tolist():
                    some = rows[block == b]
                    texts = b"".join(raw[s : s + m + SPAN] for s, m in zip(some["start"].tolist(), some["more"].tolist()))
                    out.append((b, np.array([doc], "<i8").tobytes() + some.tobytes(), texts, None, None, None))
            own, twice = _paired(np.concatenate([np.zeros(0, _WINDOW), *found]))
            out += [(doc % blocks, None, None, None, doc, spans) for doc, spans in _window_spans(own[twice])]
            own["known"] = twice
            own = own[_firsts(own["h1"], own["h2"])]
            block = own["h1"] % np.uint64(blocks)
            order = np.argsort(block, kind="stable")
            cuts = np.searchsorted(block[order], np.arange(blocks + 1, dtype=np.uint64))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                out.append((b, None, None, own[order[cuts[b] : cuts[b + 1]]].tobytes(), None, None))
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


class Suffixes:
    """Suffixes of some bytes, compared over SPAN bytes by their hashes."""

    def __init__(self, data: np.ndarray, turn: int = 0):
        self.data = data
        # after a collision all bytes get other values
        self.hashes = PrefixHash(np.random.default_rng(turn).permutation(256).astype(np.uint8)[data] if turn else data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes agree, SPAN at most, by binary search over the length."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), SPAN, np.int64)
        whole = self.hashes.raw(a, a + SPAN) == self.hashes.raw(b, b + SPAN)
        low[whole] = SPAN
        high[~whole] -= 1
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live] + 1) // 2
            x, y = a[live], b[live]
            agree = self.hashes.raw(x, x + middle) == self.hashes.raw(y, y + middle)
            low[live[agree]] = middle[agree]
            high[live[~agree]] = middle[~agree] - 1
            live = live[low[live] < high[live]]
        return low

    def before(self, a: np.ndarray, b: np.ndarray, *, equal: bool) -> np.ndarray:
        """a stands before b, or, if asked, equals it."""
        agree = self.common(a, b)
        same = agree == SPAN
        shift = np.where(same, 0, agree)
        return np.where(same, equal, self.data[a + shift] < self.data[b + shift])

    def sorted(self, places: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The order of the places inside each group: a merge sort of all groups at once.

        group must be sorted. Two runs are merged by finding, for each element, how many of
        the other run stand before it, by binary search.
        """
        first = _firsts(group)
        size = np.diff(np.append(first, len(group)))
        base = np.repeat(first, size)
        whole = np.repeat(size, size)
        order = np.arange(len(places))
        width = 1
        while True:
            live = np.flatnonzero(whole > width)
            if not len(live):
                return order
            inside = live - base[live]
            side = inside // width % 2
            start = base[live] + inside // (2 * width) * (2 * width)
            limit = base[live] + whole[live]
            mine = np.where(side == 0, start, np.minimum(start + width, limit))
            other = np.where(side == 0, np.minimum(start + width, limit), start)
            other_end = np.where(side == 0, np.minimum(start + 2 * width, limit), np.minimum(start + width, limit))
            low, high = other.copy(), other_end.copy()
            x = places[order[live]]
            todo = np.flatnonzero(low < high)
            while len(todo):
                middle = (low[todo] + high[todo]) // 2
                y = places[order[middle]]
                ahead = np.where(
                    side[todo] == 0, self.before(y, x[todo], equal=False), self.before(y, x[todo], equal=True)
                )
                low[todo[ahead]] = middle[ahead] + 1
                high[todo[~ahead]] = middle[~ahead]
                todo = todo[low[todo] < high[todo]]
            to = start + (live - mine) + (low - other)
            moved = order.copy()
            moved[to] = order[live]
            order = moved
            width *= 2

    def repeats(self, places: np.ndarray, group: np.ndarray) -> np.ndarray | None:
        """Which places agree with another of their group over SPAN bytes; None if a hash
        has lied."""
        order = self.sorted(places, group)
        now, following = places[order[:-1]], places[order[1:]]
        pair = np.flatnonzero(group[:-1] == group[1:])
        pair = pair[self.hashes.raw(now[pair], now[pair] + SPAN) == self.hashes.raw(following[pair], following[pair] + SPAN)]
        along = np.arange(SPAN)
        for i in range(0, len(pair), 4096):
            part = pair[i : i + 4096]
            if (self.data[now[part][:, None] + along] != self.data[following[part][:, None] + along]).any():
                return None
        out = np.zeros(len(places), bool)
        out[order[pair]] = True
        out[order[pair + 1]] = True
        return out


def _sorted(key: tuple, table: pa.Table) -> pa.Table:
    """One block of open runs: the spans that the suffix sort finds, by document."""
    kept = table.filter(pc.is_valid(table["doc"]))
    out: dict[str, list] = {x: kept[x].to_pylist() for x in ("doc", "spans")}
    schema = pa.schema([("doc", pa.int64()), ("spans", pa.binary())])
    own, twice = _paired(np.frombuffer(b"".join(x for x in table["windows"].to_pylist() if x), _WINDOW))
    for doc_id, spans in _window_spans(own[twice]):
        out["doc"].append(doc_id)
        out["spans"].append(spans)
    rows, docs = [], []
    table = table.filter(pc.is_valid(table["contexts"]))
    for part in table["runs"].to_pylist():
        rows.append(np.frombuffer(part[8:], _OPEN))
        docs.append(np.full(len(rows[-1]), np.frombuffer(part[:8], "<i8")[0]))
    own, doc = np.concatenate([np.zeros(0, _OPEN), *rows]), np.concatenate([np.zeros(0, np.int64), *docs])
    data = np.frombuffer(b"".join(table["contexts"].to_pylist()), np.uint8)
    if not len(own):
        return pa.table(out, schema)
    begin = np.concatenate([[0], np.cumsum(own["more"].astype(np.int64) + SPAN)])[:-1]
    # blocks may be large: anchors are taken together until they have many windows
    order = np.argsort(own["anchor"], kind="stable")
    windows = np.cumsum(own["more"][order].astype(np.int64) + 1)
    first = _firsts(own["anchor"][order])
    cut, cuts = 0, []
    for a in first.tolist():
        if a and windows[a - 1] - cut > 1 << 20:
            cuts.append(a)
            cut = windows[a - 1]
    for part in np.split(order, cuts):
        count = own["more"][part].astype(np.int64) + 1
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        of = np.repeat(part, count)
        # what stands together has one anchor at one place of the window
        place = own["lead"][of].astype(np.int64) - step
        by = np.lexsort((place, own["anchor"][of]))
        of, step, place = of[by], step[by], place[by]
        new = _firsts(own["anchor"][of], place)
        size = np.diff(np.append(new, len(of)))
        several = np.repeat(size > 1, size)
        of, step, group = of[several], step[several], np.repeat(np.arange(len(new)), size)[several]
        if not len(of):
            continue
        start, stop = begin[part].min(), (begin[part] + own["more"][part] + SPAN).max()
        turn, found = 0, None
        while found is None:
            found = Suffixes(data[start:stop], turn).repeats(begin[of] + step - start, group)
            turn += 1
        found &= own["known"][of] == 0
        at = own["start"][of[found]].astype(np.int64) + step[found]
        whose = doc[of[found]]
        by = np.lexsort((at, whose))
        at, whose = at[by], whose[by]
        edges = [*_firsts(whose).tolist(), len(whose)]
        for a, b in zip(edges[:-1], edges[1:]):
            out["doc"].append(int(whose[a]))
            out["spans"].append(_joined(at[a:b], at[a:b] + SPAN).tobytes())
    return pa.table(out, schema)


def document(docs: DataFrame) -> Column:
    """One number for doc_id and text, so that rows which share an id do not mix."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def removed_spans(texts: DataFrame, common: int = COMMON) -> DataFrame:
    """doc and packed spans, several rows a document; texts: doc, text."""
    blocks = blocks_for(texts, "text", shuffle_partitions(texts.sparkSession))
    dealt = texts.mapInArrow(_dealt(blocks, common), "block int, runs binary, doc long, spans binary, open binary")
    known = written(dealt.groupBy("block").applyInArrow(_matched, "doc long, spans binary, open binary"))
    opened = known.where("open IS NOT NULL").groupBy("doc").agg(F.collect_list("open").alias("open"))
    asked = texts.join(opened, "doc", "left").select("doc", "text", "open")
    met = asked.mapInArrow(_contexts(blocks), _MET).groupBy("block").applyInArrow(_sorted, "doc long, spans binary")
    return known.where("spans IS NOT NULL").select("doc", "spans").union(met)


def without_repeats(docs: DataFrame, *, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of every document."""
    texts = docs.select(F.col("doc_id").cast("long"), "text", document(docs).alias("doc"))
    spans = removed_spans(texts.select("doc", "text"), common)
    spans = spans.groupBy("doc").agg(F.collect_list("spans").alias("spans"))
    joined = texts.join(spans, "doc", "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, lists in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode()
                found = np.sort(np.frombuffer(b"".join(lists or []), _FOUND), order=["start", "end"])
                whole = _joined(found["start"], found["end"])
                kept, at = [], 0
                for a, b in whole.tolist():
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join([*kept, raw[at:]])
                out.append((doc_id, len(raw), len(raw) - len(rest), len(whole), rest))
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
