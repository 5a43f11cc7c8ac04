"""What several operators of this folder need: the shared folder, Arrow text, components."""

from __future__ import annotations

import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of numpy work covers; a longer text is a step of its own.
STEP_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a folder of its own only where none is set and
    all run on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not current.isDefined() and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that all machines share")
        named = current.get() if current.isDefined() else tempfile.mkdtemp(prefix="bazaarlens-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


#: Bytes of an Arrow batch between Spark and a Python worker, where the session names none:
#: rows alone do not bound it, as texts may be long.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, and sends this package to the Python workers, once an
    application."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='bazaarlens-')}/{package.name}", "zip", package.parent, package.name
        )
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def checkpointed(frame: DataFrame) -> DataFrame:
    """The rows written to the shared folder, with the lineage cut."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, so that later reads prune columns."""
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def give_back() -> None:
    """Returns freed memory of this Python worker, which the next stage may need elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


#: What a Python worker keeps from task to task of one operator.
KEPT: dict[str, object] = {}


def tidy(run: Callable[[Batches], Batches], *, keeps: bool = False) -> Callable[[Batches], Batches]:
    """The same function over batches, with freed memory returned at the end of a task. What
    another operator has kept in this worker goes first, unless this one keeps it."""

    def wrapped(batches: Batches) -> Batches:
        if KEPT and not keeps:
            KEPT.clear()
            give_back()
        yield from run(batches)
        give_back()

    return wrapped


def free_name(name: str, frame: DataFrame) -> str:
    """The name, changed if a column has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += " "
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of text that one group of a dealing stands for, about.
BLOCK_BYTES = 64 << 20


def blocks_for(texts: DataFrame, column: str, least: int, most: int = 1 << 20) -> int:
    """How many blocks the texts are dealt into: as their bytes ask for, so that no block grows with
    the table."""
    size = texts.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0
    return max(least, min(most, -(-size // BLOCK_BYTES)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text starts and ends; a null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)
    return data[ends[0] : ends[-1]], ends - ends[0]


def steps(ends: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most so many bytes together, or one row."""
    first, rows = 0, len(ends) - 1
    while first < rows:
        last = int(np.searchsorted(ends, ends[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def range_bounds(frame: DataFrame, column: str, parts: int) -> list[int]:
    """At most parts - 1 values of the column that split its rows about evenly."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = frame.where(F.col(column).isNotNull()).approxQuantile(column, shares, 0.25 / parts)
    return sorted({min(int(x), (1 << 63) - 1) for x in found})


def range_number(column, bounds: list[int]):
    """How many bounds are at or below the value: native, and equal in every run."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    below = lambda array: F.size(F.filter(array, lambda x: x <= column))
    longs = lambda values: F.array(*[F.lit(x).cast("long") for x in values])
    # first among every step-th bound, then among the step that it names
    coarse = below(longs(bounds[::step]))
    fine = below(F.slice(longs(bounds), (coarse - 1) * step + 1, F.lit(step)))
    return F.when(column >= F.lit(bounds[0]), (coarse - 1) * step + fine).otherwise(F.lit(0))


def components(nodes: DataFrame, edges: DataFrame, most: int = 60) -> DataFrame:
    """The smallest node reachable from each node: columns node, component.

    nodes: node; edges: a, b in either direction, both among the nodes. Each round takes
    the least label of the neighbours, lets every label point to its own label, and cuts the
    lineage. A hot node is no hot group: the minimum is combined before the shuffle, and the
    label joins are plain left joins, which adaptive execution splits.
    """
    both = checkpointed(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    )
    touched = both.select(F.col("a").alias("node")).distinct()
    labels = checkpointed(touched.select("node", F.col("node").alias("label")))
    for _ in range(most):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        least = labels.join(near, "node", "left").select(
            "node", "label", F.least("label", "near").alias("to")
        )
        hop = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        moved = checkpointed(
            least.join(hop, "to", "left").select(
                "node",
                F.least("to", "beyond").alias("label"),
                (F.least("to", "beyond") < F.col("label")).alias("changed"),
            )
        )
        labels = moved.select("node", "label")
        if moved.where("changed").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(labels, "node", "left").select(
        "node", F.coalesce("label", "node").alias("component")
    )
