"""Similarity join of documents on word n-grams, by a blocked sparse matrix product.

Rows of the incidence matrix are the different sets of n-grams (documents with one set are
one row), columns are n-grams. Two rows link when 100 * overlap >= percent * union.

1. Each task hashes the n-grams of its texts and deals them out, packed, into blocks of
   columns. A block counts in how many rows each column stands and drops the columns of a
   single row: they add nothing to any overlap.
2. Size-derived bounds: a row with n grams needs an overlap of at least percent * n / 100,
   so rows with fewer shared columns go. The shared columns of a row are ordered by count.
   Two linking rows meet in one of the first n - ceil(percent * n / 100) + 1 columns of both
   orders, where the single columns come first; only a column in both of these prefixes
   proposes them. At their first common column, no more than the columns from there on can
   overlap, which rules out most proposals where many rows share a column.
3. Pairs inside one group need not all be made. Each row is first multiplied with one row of
   its columns: of the rows that have a column earliest in their order, the one it meets most
   often. Linked rows form components; then every proposed pair of rows in different
   components is multiplied. Links are lost nowhere: a pair that is left out is in one
   component already.
4. Components of all links; the smallest doc_id names each.

A product is taken for pairs only, in blocks: both rows are brought together and their
columns counted. Hot groups: rows of one set are a single row. A gram that COMMON rows of one dealing have is
called common: its rows pass its block by, and the block learns only that it is common. All
common grams stand last in every order, by hash, so no block gathers a column that holds more
than about a hundredth of the rows. A column that many rows share proposes one pair a row, and
then pairs across components only; joins on a hot row or column are plain joins, which adaptive
execution splits.

Edge cases: a null or empty text, or one without words, has an empty set and links with
nothing. A text with fewer words than n has its whole sequence as its only gram. A null
doc_id keeps its row; it never names a component of others. Rows that share a doc_id are
documents of their own. Very long texts are hashed in pieces that end at a space. An empty table gives no rows. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import (
    STEP_BYTES,
    blocks_for,
    checkpointed,
    components,
    give_back,
    shuffle_partitions,
    steps,
    tidy,
    utf8,
    written,
)
from bazaarlens.llm.hashing import PrefixHash, mixed

#: Hashed grams that a task gathers before it deals them out.
GATHERED = 1 << 20
#: Bytes of the texts that are hashed at a time, or one text.
STEP = 1 << 18
#: A gram that so many rows of one dealing have is common: see the docstring.
COMMON, COMMON_COUNT = 32, (1 << 32) - 1
#: Bytes kept of a gram's hash; the block it goes to tells some bits more.
GRAM_BYTES = 6
_NO_ID = -(1 << 63)
_LOW = np.uint64((1 << 8 * GRAM_BYTES) - 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts behind one another, and where each text's begin."""
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    # words are runs of other characters, cut where a text ends
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    stop = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return PrefixHash(data).pieces(start, stop), np.searchsorted(start, ends)


def _words_of(data: np.ndarray, most: int = STEP_BYTES) -> np.ndarray:
    """The same for one long text, in pieces that end at a space; a word longer than two pieces is
    hashed by itself."""
    out, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = at + most
        while end < len(data):
            space = np.flatnonzero(_SPACE[data[end : end + most]])
            if len(space):
                end += int(space[0])
                break
            end += most
        end = min(end, len(data))
        space = np.flatnonzero(_SPACE[data[at : at + most]])
        first = at + (int(space[-1]) + 1 if len(space) else 0)
        if end - first <= 2 * most:
            first = end
        piece = data[at:first]
        out.append(_words(piece, np.array([0, len(piece)]))[0])
        if first < end:
            digest = hashlib.blake2b(data[first:end].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(digest, np.uint64))
        at = end
    return np.concatenate(out)


def _grams_of(words: np.ndarray, n: int) -> np.ndarray:
    count = len(words)
    if not count:
        return words
    size = min(n, count)
    row = words[: count - size + 1].copy()
    for k in range(1, size):
        row = row * np.uint64(0x9E3779B97F4A7C15) + words[k : count - size + 1 + k]
    # a short sequence is no n-gram of another text
    return np.unique(mixed(row + np.uint64(size)))


def grams(data: np.ndarray, ends: np.ndarray, n: int, most: int = STEP_BYTES) -> list[np.ndarray]:
    """The sorted different hashes of the word n-grams of each text."""
    data = _LOWER[data]
    if len(ends) == 2 and len(data) > most:
        return [_grams_of(_words_of(data, most), n)]
    words, at = _words(data, ends)
    return [_grams_of(words[a:b], n) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _block_of(gram: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(gram ^ np.uint64(0x9E3779B97F4A7C15)) % np.uint64(blocks)).astype(np.int64)


def _often(flat: np.ndarray, least: int) -> np.ndarray:
    """The grams that stand in so many rows or more."""
    ordered = np.sort(flat)
    if len(ordered) < least:
        return ordered[:0]
    return np.unique(ordered[least - 1 :][ordered[least - 1 :] == ordered[: len(ordered) - least + 1]])


def _dealt(n: int, blocks: int, targets: int, many: int):
    """Batches (doc_id, text, mark) to packed grams by block of columns, and rows of documents."""
    names = ["block", "grams", "counts", "rows", "sizes", "ids", "marks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        rows: list[int] = []
        sizes: list[int] = []
        ids: list[int] = []
        marks: list[int] = []

        def deal() -> pa.RecordBatch:
            out: dict[str, list] = {x: [] for x in names}

            def put(block: int, **parts: np.ndarray) -> None:
                out["block"].append(block)
                for name in names[1:]:
                    out[name].append(parts[name].tobytes() if name in parts else None)

            keys = list(sets)
            lengths = np.array([len(sets[k]) for k in keys], np.int64)
            flat = np.concatenate([sets[k] for k in keys]) if keys else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(len(keys)), lengths)
            key_array, size_array = np.array(keys, np.int64), lengths.astype(np.uint32)
            common = _often(flat, many)
            if len(common):
                is_common = np.isin(flat, common)
                gram, row, size = flat[is_common], key_array[owner[is_common]], size_array[owner[is_common]]
                gram = gram & _LOW | (_block_of(gram, blocks).astype(np.uint64) & np.uint64(0xFFFF)) << np.uint64(48)
                target = (row.view(np.uint64) % np.uint64(targets)).astype(np.int64)
                order = np.argsort(target, kind="stable")
                cuts = np.searchsorted(target[order], np.arange(targets + 1))
                for t in np.flatnonzero(np.diff(cuts)).tolist():
                    own = order[cuts[t] : cuts[t + 1]]
                    put(t, grams=gram[own], rows=row[own], sizes=size[own])
                # one entry that stands for all, of no row
                owner = np.concatenate([owner[~is_common], np.full(len(common), len(keys))])
                flat = np.concatenate([flat[~is_common], common])
                key_array, size_array = np.append(key_array, 0), np.append(size_array, np.uint32(0))
            block = _block_of(flat, blocks)
            order = np.argsort(block, kind="stable")
            flat, owner = flat[order], owner[order]
            cuts = np.searchsorted(block[order], np.arange(blocks + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[b], cuts[b + 1])
                some, counts = np.unique(owner[own], return_counts=True)
                low = flat[own].view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES]
                put(b, grams=low, counts=counts.astype(np.uint32), rows=key_array[some], sizes=size_array[some])
            for b in range(0, len(ids), 4096):
                part = slice(b, b + 4096)
                put(
                    b // 4096 % blocks,
                    rows=np.array(rows[part], np.int64),
                    sizes=np.array(sizes[part], np.uint32),
                    ids=np.array(ids[part], np.int64),
                    marks=np.array(marks[part], np.int64),
                )
            sets.clear()
            for x in (rows, sizes, ids, marks):
                x.clear()
            columns = [pa.array(out["block"], pa.int32()), *(pa.array(out[x], pa.binary()) for x in names[1:])]
            return pa.RecordBatch.from_arrays(columns, names)

        held = 0
        for batch in batches:
            found, marked = batch.column(0).fill_null(_NO_ID).to_pylist(), batch.column(2).to_pylist()
            data, ends = utf8(batch.column(1))
            for a, b in steps(ends, STEP):
                for doc_id, mark, own in zip(found[a:b], marked[a:b], grams(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], n)):
                    row = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)
                    ids.append(doc_id)
                    marks.append(mark)
                    rows.append(row)
                    sizes.append(len(own))
                    if len(own) and row not in sets:
                        sets[row] = own
                        held += len(own)
                if held >= GATHERED or len(ids) >= GATHERED // 8:
                    yield deal()
                    held = 0
        yield deal()

    return run


def _unpack(values: list[bytes | None], kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in values if x), kind)


_COLUMNS = "target int, rows binary, sizes binary, grams binary, counts binary, ids binary, marks binary"
_SCHEMA = pa.schema([("target", pa.int32()), *((x, pa.binary()) for x in ("rows", "sizes", "grams", "counts", "ids", "marks"))])


def _shared_columns(key: tuple, table: pa.Table, targets: int) -> pa.Table:
    """One block of columns: the grams that several rows have, with counts, packed by the
    rows they belong to; and the documents, as they are."""
    parts = {x: table[x].to_pylist() for x in table.column_names}
    gram_parts = [i for i, x in enumerate(parts["counts"]) if x is not None]
    pick = lambda name: [parts[name][i] for i in gram_parts]
    low = _unpack(pick("grams"), np.uint8).reshape(-1, GRAM_BYTES)
    gram = np.zeros((len(low), 8), np.uint8)
    gram[:, :GRAM_BYTES] = low
    del low
    repeats, row, size = (_unpack(pick(x), k) for x, k in (("counts", np.uint32), ("rows", np.int64), ("sizes", np.uint32)))
    for i in gram_parts:
        parts["grams"][i] = None
    # the block's number makes grams of different blocks differ
    gram = gram.view(np.uint64).reshape(-1)
    gram |= np.uint64((key[0].as_py() & 0xFFFF) << 48)
    order = np.argsort(gram, kind="stable")
    gram = gram[order]
    # columns that stand in one place only are most; the rest is small
    same = gram[1:] == gram[:-1]
    twice = (np.concatenate([same, [False]]) | np.concatenate([[False], same]))[: len(gram)]
    gram = gram[twice]
    owner = np.searchsorted(np.cumsum(repeats, dtype=np.int64), order[twice], "right")
    del order
    row, size = row[owner], size[owner]
    order = np.lexsort((row, gram))
    gram, row, size = gram[order], row[order], size[order]
    once = np.concatenate([[True], (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])])[: len(gram)]
    gram, row, size = gram[once], row[once], size[once]
    start = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)])
    counts = np.diff(np.append(start, len(gram)))
    many = np.repeat(counts, counts)
    # an entry of size 0 tells that the gram is common
    many = np.where(np.repeat(np.minimum.reduceat(size, start) if len(start) else size, counts) == 0, COMMON_COUNT, many)
    keep = (many >= 2) & (size > 0)
    gram, row, size, many = gram[keep], row[keep], size[keep], many[keep].astype(np.uint32)
    target = (row.view(np.uint64) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    gram, row, size, many = gram[order], row[order], size[order], many[order]
    cuts = np.searchsorted(target[order], np.arange(targets + 1))
    out: dict[str, list] = {x: [] for x in _SCHEMA.names}

    def put(target: int | None, **values: bytes) -> None:
        out["target"].append(target)
        for name in _SCHEMA.names[1:]:
            out[name].append(values.get(name))

    for t in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[t], cuts[t + 1])
        put(t, **{x: v[own].tobytes() for x, v in (("rows", row), ("sizes", size), ("grams", gram), ("counts", many))})
    for i, (ids, gram_part, count_part) in enumerate(zip(parts["ids"], parts["grams"], parts["counts"])):
        if gram_part is not None and count_part is None:
            many = np.full(len(gram_part) // 8, COMMON_COUNT, np.uint32).tobytes()
            put(key[0].as_py(), rows=parts["rows"][i], sizes=parts["sizes"][i], grams=gram_part, counts=many)
        if ids is not None:
            put(None, rows=parts["rows"][i], sizes=parts["sizes"][i], ids=ids, marks=parts["marks"][i])
    give_back()
    return pa.table(out, _SCHEMA)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents that blocks have passed on: doc_id, mark, row, size."""
    for batch in batches:
        row, size, doc_id, mark = (_unpack(c.to_pylist(), k) for c, k in zip(batch.columns, (np.int64, np.uint32, np.int64, np.int64)))
        known = pa.array(doc_id, mask=doc_id == _NO_ID)
        yield pa.RecordBatch.from_arrays(
            [known, pa.array(mark), pa.array(row), pa.array(size.astype(np.int32))], ["doc_id", "mark", "row", "size"]
        )


_SETS = "row long, size int, grams binary, prefix array<struct<gram:long,place:int>>"


def _bounded(key: tuple, table: pa.Table, percent: int) -> pa.Table:
    """Rows whose shared columns reach the bound: all of them, rarest first, and the prefix
    with each column's place among the columns of the row, those of the row alone included."""
    kinds = {"rows": np.int64, "sizes": np.uint32, "grams": np.uint64, "counts": np.uint32}
    row, size, gram, many = (_unpack(table[x].to_pylist(), k) for x, k in kinds.items())
    # a set that several dealings have seen comes from each; it counts once
    order = np.lexsort((gram, many, row))
    row, size, gram = row[order], size[order].astype(np.int64), gram[order]
    once = np.concatenate([[True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])])[: len(row)]
    row, size, gram = row[once], size[once], gram[once]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])[: len(row)])
    cuts = [*first.tolist(), len(row)]
    out: dict[str, list] = {"row": [], "size": [], "grams": [], "prefix": []}
    for a, b in zip(cuts[:-1], cuts[1:]):
        whole = int(size[a])
        least = -(-percent * whole // 100)
        if b - a >= least:
            single = whole - (b - a)
            chosen = gram[a : b - least + 1].view(np.int64).tolist()
            out["row"].append(int(row[a]))
            out["size"].append(whole)
            out["grams"].append(np.sort(gram[a:b]).tobytes())
            out["prefix"].append([{"gram": g, "place": single + i} for i, g in enumerate(chosen)])
    give_back()
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.struct([("gram", pa.int64()), ("place", pa.int32())]))]
    return pa.table(list(out.values()), pa.schema(list(zip(out, kinds))))


def _products(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    side = lambda x: sets.select(F.col("row").alias(x), F.col("size").alias(f"size_{x}"), F.col("grams").alias(f"grams_{x}"))
    both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, ga, gb = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(a)):
                x, y = np.frombuffer(ga[i], np.uint64), np.frombuffer(gb[i], np.uint64)
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * overlap >= percent * (na[i] + nb[i] - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "size_a", "size_b", "grams_a", "grams_b").mapInArrow(tidy(run), "a long, b long")


def _possible(percent: int):
    """Sizes and places allow that x and y link and that this is their first column in both
    orders: at most what stands from here on can overlap. Of two rows that link, the first
    common column passes."""
    need = F.lit(percent) * (F.col("x.size") + F.col("y.size"))
    rest = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    sizes = F.least("x.size", "y.size") * F.lit(100) >= F.greatest("x.size", "y.size") * F.lit(percent)
    return (rest * F.lit(100 + percent) >= need) & sizes


def members(docs: DataFrame, *, mark: Column | None = None, n: int = 5, percent: int = 80, common: int = COMMON) -> DataFrame:
    """doc_id, mark, size (of the set) and component of every document; the component is a number,
    and null for an empty set."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text", (F.lit(0) if mark is None else mark).cast("long").alias("mark"))
    # several blocks a shuffle partition, so that a task holds a part of its partition at a time
    targets = blocks_for(texts, "text", shuffle_partitions(spark))
    blocks = 3 * targets
    dealt = texts.mapInArrow(
        tidy(_dealt(n, blocks, targets, common)),
        "block int, grams binary, counts binary, rows binary, sizes binary, ids binary, marks binary",
    )
    found = written(dealt.groupBy("block").applyInArrow(lambda key, table: _shared_columns(key, table, targets), _COLUMNS))
    documents = found.where("ids IS NOT NULL").select("rows", "sizes", "ids", "marks")
    documents = documents.mapInArrow(_documents, "doc_id long, mark long, row long, size int")
    sets = found.where("ids IS NULL").groupBy("target").applyInArrow(lambda key, table: _bounded(key, table, percent), _SETS)
    sets = written(sets)
    entries = sets.select("row", "size", F.explode("prefix").alias("entry"))
    entries = entries.select("row", "size", F.col("entry.gram").alias("gram"), F.col("entry.place").alias("place"))

    # null-safe, so that both sides are shuffled for the join and hot columns can be split
    same = F.col("x.gram").eqNullSafe(F.col("y.gram"))
    # the row that has the column earliest in its order proposes itself to all others
    hubs = entries.groupBy("gram").agg(
        F.min(F.struct((F.col("place") / F.col("size")).alias("share"), "row", "size", "place")).alias("hub"),
        F.count("*").alias("many"),
    )
    hubs = hubs.where("many > 1").select("gram", "hub.row", "hub.size", "hub.place").alias("x")
    met = entries.alias("y").join(hubs, same).where(F.col("x.row") != F.col("y.row")).where(_possible(percent))
    met = met.groupBy(F.col("x.row").alias("a"), F.col("y.row").alias("b")).count()
    first = met.groupBy("b").agg(F.max_by("a", F.struct("count", "a")).alias("a"))
    links = checkpointed(_products(first, sets, percent))
    labels = checkpointed(components(sets.select(F.col("row").alias("node")), links))

    # what is left: pairs in one column, from different components
    told = entries.join(labels.select(F.col("node").alias("row"), F.col("component").alias("part")), "row")
    per_part = told.groupBy("gram", "part").count()
    split = per_part.groupBy("gram").agg(F.max_by("part", F.struct("count", "part")).alias("main"), F.count("*").alias("parts"))
    split = split.where("parts > 1").select("gram", "main").alias("x")
    told = told.alias("y").join(split, same).select("y.*", "x.main")
    x, y = told.where("part <> main").alias("x"), told.alias("y")
    rest = (
        x.join(y, same)
        .where(F.col("x.part") != F.col("y.part"))
        .where((F.col("y.part") == F.col("y.main")) | (F.col("x.row") < F.col("y.row")))
        .where(_possible(percent))
        .select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b"))
        .distinct()
    )
    more = _products(rest, sets, percent)
    across = (
        more.join(labels.toDF("a", "pa"), "a").join(labels.toDF("b", "pb"), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    )
    whole = components(labels.select(F.col("component").alias("node")).distinct(), across)
    row_part = labels.join(whole.toDF("component", "part"), "component").select(F.col("node").alias("row"), "part")
    # a row outside sets links with nothing but its copies
    told = documents.join(row_part, "row", "left")
    return told.select("doc_id", "mark", "size", F.when(F.col("size") > 0, F.coalesce("part", "row")).alias("component"))


def linked(docs: DataFrame, *, n: int = 5, percent: int = 80, common: int = COMMON) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    told = members(docs, n=n, percent=percent, common=common)
    names = told.groupBy("component").agg(F.min("doc_id").alias("component_id")).where("component IS NOT NULL")
    # null-safe, so that both sides are shuffled for the join and a hot component can be split
    named = told.join(names.withColumnRenamed("component", "of"), F.col("component").eqNullSafe(F.col("of")), "left")
    size, component = F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id"))
    return named.select("doc_id", size, component.otherwise(F.col("doc_id")).alias("component_id"))


def without_copies(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, of the smallest doc_id (nulls last), and all rows with an empty set.

    Rows are told apart by doc_id and a hash of the text; of equal ones any stays."""
    kept, mark = docs.columns, F.xxhash64(F.coalesce("text", F.lit("")))
    told = members(docs, mark=mark, n=n, percent=percent).where("component IS NOT NULL")
    rows = checkpointed(told.groupBy("component", "doc_id", "mark").agg(F.count("*").alias("often")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark"))
    firsts = rows.groupBy("component").agg(first.alias("first")).select(F.col("component").alias("of"), "first")
    rows = rows.join(firsts, F.col("component").eqNullSafe(F.col("of")))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    rows = rows.where(~stays | (F.col("often") > 1))
    rows = checkpointed(rows.select(F.col("doc_id").alias("its id"), F.col("mark").alias("its mark"), stays.alias("copied")))
    marked = docs.select(F.struct(*kept).alias("row"), F.col("doc_id").cast("long").alias("own id"), mark.alias("own mark"))
    same = F.col("own id").eqNullSafe(F.col("its id")) & (F.col("own mark") == F.col("its mark"))
    whole = marked.join(rows, same, "left_anti").select("row.*")
    copied = marked.join(rows.where("copied"), same, "left_semi").dropDuplicates(["own id", "own mark"])
    return whole.union(copied.select("row.*"))
