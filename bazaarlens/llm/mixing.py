"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its token share to the power of an exponent, normalised. The exponent
is bisected until the mix meets a target entropy, or until no source is read more often than
a repetition limit. The budget is given, or the least one that draws every document of every
source at least once. A source with r = weight * budget / tokens is read floor(r) times in
whole and once more in part, each time in a permutation of its own; the part stops with the
document that reaches the budget. The draws are dealt into blocks of equal budget, so that
every block holds the sources in the target weights, and permuted inside each block.

Tokens are the words `[^\\x20\\x09-\\x0D]+`. Everything is native. A running total inside a
source is taken over slices of its permutation, so that a source of a third of all rows is
spread over many tasks; only per-slice totals are added up, along each source.

Edge cases: a null source is a source of its own. A null or empty text has no tokens and is
drawn with the documents before it; a source without tokens is drawn once and has weight 0.
Equal rows are drawn each by itself; their order among themselves is not fixed, nor does it
change which texts are drawn. Very long texts are counted by one expression, and never
shuffled. An empty table gives no rows. Other columns do not matter to
`mixed`, and `resampled` keeps them all.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source that one slice of its permutation holds on average.
SLICE_ROWS = 5000
#: Up to so many bytes of sources, what is told of each source is broadcast to the texts.
BROADCAST_BYTES = 8 << 20
#: Digits of a permutation key that number the slices: at most 16 ** 7 slices a source.
SLICE_DIGITS = 7


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("-"))))


def source_totals(counted: DataFrame) -> DataFrame:
    """One row per source: documents and tokens."""
    return counted.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))


def _measures(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy of the weights and largest repetition at each exponent, by one aggregation.

    With shares p and exponent a, the weights are p^a / Z; H = ln Z - a * sum(p^a ln p) / Z.
    Against the least budget that covers all, r = (largest p^(1-a)) * p^(a-1).
    """
    p = F.col("p")
    columns: list[Column] = [F.max(p).alias("top"), F.min(p).alias("low")]
    for i, a in enumerate(exponents):
        columns += [F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"e{i}")]
    row = totals.agg(*columns).first()
    return [
        (math.log(row[f"z{i}"]) - a * row[f"e{i}"] / row[f"z{i}"], (row["top"] / row["low"]) ** (1 - a))
        for i, a in enumerate(exponents)
    ]


def find_exponent(shares: DataFrame, entropy: float | None, repetition: float | None, ways: int = 16) -> float:
    """The exponent in [0, 1] at which the mix meets the target; rounded to 1e-9.

    Lowering the exponent raises both entropy and repetition. An entropy target asks for the
    largest exponent whose entropy is at least the target (0 if none is); a repetition limit
    for the smallest exponent that keeps to it. The interval is bisected four times a job, by
    evaluating its fifteen dividing points in one aggregation that returns one row.
    """
    low, high = 0.0, 1.0
    enough = (lambda m: m[0] < entropy) if entropy is not None else (lambda m: m[1] <= repetition)
    if enough(_measures(shares, [0.0])[0]):
        return 0.0
    if not enough(_measures(shares, [1.0])[0]):
        return 1.0
    while high - low > 1e-13:
        points = [low + (high - low) * i / ways for i in range(1, ways)]
        held = [enough(m) for m in _measures(shares, points)]
        first = held.index(True) if True in held else len(points)
        low, high = ([low] + points)[first], (points + [high])[first]
    return round(high, 9)


def weights(
    counted: DataFrame,
    *,
    entropy: float | None = None,
    repetition: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """One row per source: docs, tokens, share, weight, budget, repetition.

    counted: source, tokens. The exponent is in every row.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give a target entropy or a repetition limit")
    totals = checkpointed(source_totals(counted))
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = totals.where("tokens > 0").select((F.col("tokens") / F.lit(float(max(whole, 1)))).alias("p"))
    exponent = find_exponent(shares, entropy, repetition) if whole else 1.0
    share = F.col("tokens") / F.lit(float(max(whole, 1)))
    raised = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent))).otherwise(F.lit(0.0))
    sized = totals.withColumn("share", share).withColumn("raised", raised)
    row = sized.agg(F.sum("raised"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("raised")))).first()
    total, cover = row[0] or 1.0, row[1] or 0.0
    ratio = budget / total if budget is not None else cover
    # rounded, so that a source which is to be read once is not read a token more
    tokens = F.round(F.col("raised") * F.lit(float(ratio))).cast("long")
    return checkpointed(
        sized.select(
            "source",
            "docs",
            "tokens",
            "share",
            (F.col("raised") / F.lit(float(total))).alias("weight"),
            F.lit(exponent).alias("exponent"),
            tokens.alias("budget"),
        ).withColumn("repetition", F.coalesce(F.try_divide("budget", "tokens"), F.lit(1.0)))
    )


def mixed(counted: DataFrame, plan: DataFrame, *, block_tokens: int, seed: int = 7) -> DataFrame:
    """One row per draw: the columns doc_id, source, tokens of `counted`, epoch, block, key.

    Reading the rows in the order of block and key gives the mix; `before` is the number of
    the source's tokens drawn before this document.
    """
    last = F.greatest(F.ceil("repetition"), F.lit(1)).cast("int")
    slices = F.ceil(F.col("docs") / SLICE_ROWS).cast("long")
    everything = plan.agg(F.sum("budget")).first()[0] or 0
    blocks = max(1, -(-everything // block_tokens))
    p = plan.select(
        F.col("source").alias("of"),
        F.col("tokens").alias("source_tokens"),
        F.col("budget").alias("source_budget"),
        last.alias("last"),
        slices.alias("slices"),
    )
    drawn = counted.select("doc_id", "source", "tokens").join(p, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    drawn = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(1), "last")))
    drawn = drawn.withColumn("key", _key(seed, F.col("epoch"), F.col("doc_id")))
    number = F.conv(F.substring("key", 1, SLICE_DIGITS), 16, 10).cast("long")
    drawn = checkpointed(
        drawn.withColumn("slice", F.floor(number * F.col("slices") / F.lit(16**SLICE_DIGITS)).cast("long"))
    )
    per_slice = drawn.groupBy("source", "epoch", "slice").agg(F.sum("tokens").alias("sum"))
    along = Window.partitionBy("source").orderBy("epoch", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select(
        F.col("source").alias("of"),
        F.col("epoch").alias("in"),
        F.col("slice").alias("at"),
        F.coalesce(F.sum("sum").over(along), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy("source", "epoch", "slice").orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    placed = placed.join(
        starts,
        F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("in")) & (F.col("slice") == F.col("at")),
    )
    before = F.col("start") + F.col("inner")
    block = F.least(
        F.floor(F.coalesce(F.try_divide(before.cast("double"), F.col("source_budget")), F.lit(0.0)) * F.lit(blocks)),
        F.lit(blocks - 1),
    ).cast("long")
    whole = F.col("epoch") * F.col("source_tokens") <= F.col("source_budget")
    return (
        placed.where(whole | (before < F.col("source_budget")))
        .select("doc_id", "source", "tokens", "epoch", block.alias("block"), before.alias("before"), "key")
    )


def resampled(
    docs: DataFrame,
    *,
    entropy: float | None = None,
    repetition: float | None = None,
    budget: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """The documents, each as often as the mix draws it, with their own columns.

    The part read of a source is the same set of documents as in `mixed`. It is told by the
    last permutation key drawn, one value a source, so texts are not shuffled; rows that
    share a doc_id share their keys and are drawn together.
    """
    counted = docs.select("doc_id", "source", token_count(F.col("text")).alias("tokens"))
    counted = checkpointed(counted)
    plan = weights(counted, entropy=entropy, repetition=repetition, budget=budget)
    draws = mixed(counted, plan, block_tokens=1 << 20, seed=seed)
    ends = draws.groupBy("source", "epoch").agg(F.max("key").alias("end"))
    # private names, which no column of the documents is likely to have
    of, stop = "source of draws", "last draw"
    ends = ends.groupBy(F.col("source").alias(of)).agg(F.max(F.struct("epoch", "end")).alias(stop))
    epoch, end = F.col(stop).getField("epoch"), F.col(stop).getField("end")
    read = F.filter(
        F.sequence(F.lit(1), epoch), lambda e: (e < epoch) | (_key(seed, e, F.col("doc_id")) <= end)
    )
    told = plan.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64)).first()[0] or 0
    side = F.broadcast(ends) if told <= BROADCAST_BYTES else ends
    joined = docs.join(side, docs["source"].eqNullSafe(ends[of]))
    return joined.withColumn(of, F.explode(read)).select(*[docs[c] for c in docs.columns])
