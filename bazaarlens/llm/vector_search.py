"""Nearest vectors by cosine over balanced posting lists.

Fit: centroids of a bounded sample, by k-means on the unit sphere; a cluster with too many
of the sample is split until the lists are balanced. The centroids are linked into a graph
of near neighbours, which is small and held in memory by every task.

Index: every vector goes to the list of its nearest centroid and, near a boundary, to those
whose distance is at most BOUNDARY times the nearest, COPIES lists at most. Lists that are
long all the same, because many vectors are alike, are cut into shards by a hash of vec_id.

Search: from entry points the centroid graph is walked through all centroids whose distance
is at most `ratio` times the nearest found; those lists are searched in full, with exact
cosines in double precision. `ratio` is the least that reaches RECALL on queries taken from
the sample, whose true neighbours in the sample are known.

Shards are dealt into groups of about BLOCK_ROWS rows; a query goes once to each group that
holds a list of it, with the shards to be read there. A group's rows come first in a sorted
stream, its queries behind them, a batch at a time, so a task holds one group and one batch
whatever the number of queries, and no posting is copied for them. A hot list is read by many
tasks. Each group returns the k best for a query, and the best of those are the result.

The number of lists grows with the root of the table, up to CENTROIDS, and the sample with it:
a query reads lists of about so many rows each, not a share of the table.

Edge cases: a vector takes no part if its id or itself is null, if it holds null, NaN or
infinite components, if it is zero, or if its length is not that of most vectors in the
sample (the smaller length at a tie). With fewer candidates than k, all are returned. Equal
scores go to the smaller vec_id. Rows with one vec_id count once per different vector, and
none of them is a neighbour of that id. An empty table gives no rows. Other columns do not
matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import checkpointed, shuffle_partitions, tidy

#: Bounds of the fit: vectors of the sample, at least and at most, centroids, and sample vectors a
#: centroid.
LEAST_SAMPLE, SAMPLE, CENTROIDS, LEAST_MEMBERS = 8192, 131072, 16384, 8
#: Distances that a walk through the centroids holds.
CELLS = 1 << 20
#: Replication of boundary vectors, degree of the centroid graph, aim of the calibration.
BOUNDARY, COPIES, DEGREE, RECALL = 1.1, 4, 24, 0.97
BLOCK_ROWS = 16384


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


@dataclass
class Index:
    """Unit centroids, their neighbours in the graph, entry points, ratio of the search."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    ratio: float

    def walk(self, units: np.ndarray, ratio: float) -> np.ndarray:
        """Distances to the centroids met: rows by centroids, infinite where not met."""
        rows, count = len(units), len(self.centroids)
        distance = np.full((rows, count), np.inf)
        distance[:, self.entries] = _chord(units @ self.centroids[self.entries].T)
        opened = np.zeros((rows, count), bool)
        while True:
            best = distance.min(1, keepdims=True)
            front = (distance <= best * ratio) & ~opened
            if not front.any():
                return distance
            opened |= front
            row, at = np.nonzero(front)
            near = self.links[at].reshape(-1)
            met = np.zeros((rows, count), bool)
            met[np.repeat(row, self.links.shape[1]), near] = True
            row, at = np.nonzero(met & np.isinf(distance))
            for i in range(0, len(row), 1 << 16):
                r, a = row[i : i + (1 << 16)], at[i : i + (1 << 16)]
                distance[r, a] = _chord((units[r] * self.centroids[a]).sum(1))

    def _parts(self, units: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        step = max(1, CELLS // len(self.centroids))
        for i in range(0, len(units), step):
            yield i, units[i : i + step]

    def lists(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lists that hold them."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, part in self._parts(units):
            distance = self.walk(part, BOUNDARY)
            at = np.argsort(distance, axis=1, kind="stable")[:, :COPIES]
            near = np.take_along_axis(distance, at, 1)
            row, place = np.nonzero(near <= BOUNDARY * near[:, :1] + 1e-12)
            out.append((i + row, at[row, place]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def probes(self, units: np.ndarray, sizes: np.ndarray | None = None, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lists that a search of each row reads; if these hold fewer than `least` vectors
        by their sizes, as many of the next nearest as it takes."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, part in self._parts(units):
            distance = self.walk(part, self.ratio)
            near = distance <= distance.min(1, keepdims=True) * self.ratio + 1e-12
            if sizes is not None:
                few = np.flatnonzero(near @ sizes < least)
                order = np.argsort(_chord(part[few] @ self.centroids.T), axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                row, place = np.nonzero(before < least)
                near[few[row], order[row, place]] = True
            row, at = np.nonzero(near)
            out.append((i + row, at))
        return tuple(np.concatenate(x) for x in zip(*out))


def _chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def _kmeans(units: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centers = units[random.choice(len(units), k, replace=False)].copy()
    for _ in range(rounds):
        own = (units @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, units)
        length = np.sqrt((sums * sums).sum(1, keepdims=True))
        centers = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centers)
    return centers, (units @ centers.T).argmax(1)


def fit(sample: np.ndarray, rows: int, *, k: int = 5, recall: float = RECALL, seed: int = 1) -> Index:
    """An index for about so many rows, from sample vectors."""
    random = np.random.default_rng(seed)
    units = _unit(sample)
    count = int(min(CENTROIDS, max(1, 2 * rows**0.5), max(1, len(units) // LEAST_MEMBERS)))
    centers, own = _kmeans(units, count, random)
    # balance: the largest cluster is split until it is under four times the mean
    limit, parts = 4 * max(LEAST_MEMBERS, len(units) // count), []
    waiting = [np.flatnonzero(own == i) for i in range(count)]
    while waiting:
        members = waiting.pop()
        if len(members) > limit and len(parts) + len(waiting) < 2 * count:
            _, side = _kmeans(units[members], 2, random)
            if 0 < side.sum() < len(side):
                waiting += [members[side == 0], members[side == 1]]
                continue
        if len(members):
            parts.append(members)
    centers = np.array([units[m].mean(0) for m in parts])
    length = np.sqrt((centers * centers).sum(1, keepdims=True))
    centers = np.where(length > 1e-9, centers / np.maximum(length, 1e-9), units[[m[0] for m in parts]])
    near = np.argsort(-(centers @ centers.T), axis=1, kind="stable")[:, : DEGREE + 1]
    # a ring keeps the graph in one piece
    links = np.concatenate([near, np.roll(np.arange(len(centers)), 1)[:, None]], axis=1)
    entries = random.choice(len(centers), min(16, len(centers)), replace=False)
    index = Index(centers, links, entries, 1.0)
    asked = random.choice(len(units), min(256, len(units)), replace=False)
    cosine = units[asked] @ units.T
    cosine[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-cosine, axis=1)[:, : min(k, len(units) - 1)]
    if true.size:
        distance = _chord(units[asked] @ centers.T)
        member = np.full((len(units), len(centers)), False)
        member[index.lists(units)] = True
        least = np.where(member[true], distance[:, None, :], np.inf).min(2) / distance.min(1)[:, None].clip(1e-12)
        index.ratio = float(np.quantile(least, recall)) + 1e-9
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, scaled by powers of two, which no cosine notices: so that squares
    neither overflow nor vanish."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    _, exponent = np.frexp(np.abs(rows).max(1, keepdims=True, initial=0))
    return np.ldexp(rows, -exponent)


class _Group:
    """The postings of a group, and searches among them."""

    def __init__(self, parts: list[pa.RecordBatch], k: int):
        table = pa.Table.from_batches(parts)
        self.k, self.ids = k, table["vec_id"].to_numpy()
        self.shard = table["shards"].combine_chunks().flatten().to_numpy()
        self.base = _matrix(table["embedding"].combine_chunks())
        self.length = np.sqrt((self.base * self.base).sum(1))
        self.units = self.base / self.length[:, None]
        # in these shards one id has several rows
        order = np.lexsort((self.ids, self.shard))
        same = (self.shard[order][1:] == self.shard[order][:-1]) & (self.ids[order][1:] == self.ids[order][:-1])
        self.repeated = set(self.shard[order][1:][same].tolist())

    def _near(self, a: int, b: int, names: np.ndarray, units: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Queries and rows of one shard that may be among a query's k best."""
        about = units @ self.units[a:b].T
        about[self.ids[a:b] == names[:, None]] = -np.inf
        some = min(self.k * COPIES, b - a)
        if not whole and some < b - a:
            last = -np.partition(-about, some - 1, axis=1)[:, some - 1 : some]
            return np.nonzero((about >= last - 1e-9) & (about > -np.inf))
        return np.nonzero(about > -np.inf)

    def search(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        names, q = batch["vec_id"].to_numpy(), _matrix(batch["embedding"])
        size = np.sqrt((q * q).sum(1))
        units, lists = q / size[:, None], batch["shards"]
        of = np.repeat(np.arange(len(names)), np.diff(lists.offsets.to_numpy()))
        shard = lists.flatten().to_numpy()
        order = np.argsort(shard, kind="stable")
        of, shard = of[order], shard[order]
        cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))[: len(shard)]
        queries, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(shard)]):
            a, b = np.searchsorted(self.shard, shard[i]), np.searchsorted(self.shard, shard[i], "right")
            step = max(1, 2 * CELLS // max(1, b - a))
            for c in range(i, j, step) if a < b else ():
                asked = of[c : min(c + step, j)]
                row, at = self._near(a, b, names[asked], units[asked], int(shard[i]) in self.repeated)
                queries.append(asked[row])
                rows.append(a + at)
        query, row = np.concatenate(queries), np.concatenate(rows)
        score = np.zeros(len(row))
        for i in range(0, len(row), 1 << 15):
            x, y = query[i : i + (1 << 15)], row[i : i + (1 << 15)]
            score[i : i + (1 << 15)] = (self.base[y] * q[x]).sum(1) / (self.length[y] * size[x])
        ids = self.ids[row]
        # the best row of each id, then the k best ids of each query
        order = np.lexsort((-score, ids, query))
        query, ids, score = query[order], ids[order], score[order]
        once = np.concatenate([[True], (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])])[: len(query)]
        query, ids, score = query[once], ids[once], score[once]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        first = np.searchsorted(query, query)
        best = np.arange(len(query)) - first < self.k
        columns = [pa.array(names[query[best]]), pa.array(ids[best]), pa.array(score[best])]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _searched(k: int):
    """Sorted rows (group, shards, asks, vec_id, embedding): the postings of a group, then its
    queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, group = None, [], None
        for whole in batches:
            keys = whole["group"].to_numpy().astype(np.int64) * 2 + whole["asks"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)].tolist()
            for a, b in zip(cuts, [*cuts[1:], len(keys)]):
                number, asks = divmod(int(keys[a]), 2)
                if number != now:
                    now, parts, group = number, [], None
                if not asks:
                    parts.append(whole.slice(a, b - a))
                    continue
                if parts:
                    group, parts = _Group(parts, k), []
                if group is not None:
                    for c in range(a, b, 1024):
                        yield group.search(whole.slice(c, min(1024, b - c)))

    return run


def nearest(vectors: DataFrame, queries: Column, *, k: int = 5) -> DataFrame:
    """The k nearest of each query: query_id, rank, vec_id, score.

    vectors: vec_id, embedding; queries: which of them are asked.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), queries.alias("asked"))
    rows = rows.where("vec_id IS NOT NULL").where(usable(F.col("embedding")))
    total = rows.count()
    # by id and vector, so that rows of one id are drawn apart; cut before the driver
    order = F.xxhash64("vec_id", "embedding", F.lit(4))
    wanted = int(min(SAMPLE, max(LEAST_SAMPLE, 2 * LEAST_MEMBERS * total**0.5)))
    share = min(1.0, 1.2 * wanted / max(total, 1))
    drawn = rows.where(order.cast("double") / 2.0**64 + 0.5 <= share).select(order.alias("at"), "embedding")
    drawn = drawn.orderBy("at").limit(wanted).toPandas()
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(drawn):
        return spark.createDataFrame([], schema)
    sizes = Counter(len(x) for x in drawn["embedding"])
    width = min(sizes, key=lambda n: (-sizes[n], n))
    index = fit(np.stack([x for x in drawn["embedding"] if len(x) == width]), total, k=k)
    shared = spark.sparkContext.broadcast(index)
    rows = rows.where(F.size("embedding") == width)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.slice(start, 1024)
                row, at = index.lists(_unit(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), *(c.take(pa.array(row)) for c in batch.columns)],
                    ["list", "vec_id", "embedding"],
                )

    postings = checkpointed(rows.select("vec_id", "embedding").mapInArrow(file, "list int, vec_id long, embedding array<double>"))
    # one number a centroid: how many shards its list has, and the number of the first
    counts = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}
    shards = np.array([max(1, -(-counts.get(i, 0) // BLOCK_ROWS)) for i in range(len(index.centroids))])
    first = np.concatenate([[0], np.cumsum(shards)])
    # a vector stands in COPIES lists at most, so these hold k others
    sizes, least = np.array([counts.get(i, 0) for i in range(len(index.centroids))]), (k + 1) * COPIES
    groups = max(shuffle_partitions(spark), -(-sum(counts.values()) // BLOCK_ROWS))
    of_list = lambda values: F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("list") + 1)
    shard = of_list(first[:-1]) + F.pmod(F.xxhash64("vec_id"), of_list(shards)).cast("int")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for every group, with the shards to be read there."""
        index = shared.value
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.slice(start, 1024)
                row, at = index.probes(_unit(_matrix(batch.column(1))), sizes, least)
                row, unit = np.repeat(row, shards[at]), np.concatenate([np.arange(first[i], first[i + 1]) for i in at])
                order = np.lexsort((unit, unit % groups, row))
                row, unit = row[order], unit[order]
                apart = (row[1:] != row[:-1]) | (unit[1:] % groups != unit[:-1] % groups)
                new = np.flatnonzero(np.concatenate([[True], apart]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((unit[new] % groups).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.append(new, len(unit)).astype(np.int32)), pa.array(unit.astype(np.int32))),
                        *(c.take(pa.array(row[new])) for c in batch.columns),
                    ],
                    ["group", "shards", "vec_id", "embedding"],
                )

    held = postings.withColumn("shard", shard).withColumn("group", F.col("shard") % groups)
    held = held.select("group", F.array("shard").alias("shards"), F.lit(False).alias("asks"), "vec_id", "embedding")
    parts = max(shuffle_partitions(spark), -(-groups // 4))

    def searched(asked: DataFrame) -> DataFrame:
        both = held.unionByName(asked.withColumn("asks", F.lit(True)))
        both = both.repartition(parts, "group").sortWithinPartitions("group", "asks", F.col("shards")[0])
        both = both.select("group", "shards", "asks", "vec_id", "embedding")
        return both.mapInArrow(tidy(_searched(k)), "query_id long, vec_id long, score double")

    wanted = rows.where("asked").select("vec_id", "embedding")
    found = searched(wanted.mapInArrow(ask, "group int, shards array<int>, vec_id long, embedding array<double>"))
    found = checkpointed(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    # only where one id has very many rows may a query have found fewer than k: it reads all lists
    met = found.groupBy("query_id").agg(F.count("*").alias("met")).where(F.col("met") >= k)
    short = checkpointed(wanted.join(met, F.col("vec_id") == F.col("query_id"), "left_anti"))
    if not short.isEmpty():
        last = F.lit(int(first[-1]) - 1)
        of_group = lambda g: F.struct(g.alias("group"), F.sequence(g, last, F.lit(groups)).alias("shards"))
        each = F.transform(F.sequence(F.lit(0), F.lit(min(groups, int(first[-1])) - 1)), of_group)
        found = found.unionByName(searched(short.select(F.inline(each), "vec_id", "embedding")))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
