"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased letters with runs of anything else as one space. Its subwords are all
byte 2-, 3- and 4-grams, hashed to rows of an embedding table; their mean goes through a
linear softmax. Table and softmax are trained by stochastic gradient descent in numpy on
the driver, over short pieces cut from a bounded sample of labelled documents. Some of the
sampled documents are held back: they set the temperature of the softmax and the score
below which a prediction is rejected.

Because both steps are linear, a trained model is one table of subword by language values;
a prediction is the mean of the rows of all subwords of the whole text.

Bounds: at most PER_LANGUAGE documents a language and PIECES pieces of PIECE_BYTES bytes a
document reach the driver, whatever the size of the input. The sample is drawn evenly by a
hash of doc_id and text and spread over each whole text.

Edge cases: a null text, or one without a letter, is "und" with score 0 and rejected. Rows
with a null language, or no letter, teach nothing. A very long text is read in pieces of a
megabyte, cut at spaces; subwords across a cut do not count. Ties between languages go to the first by name. Repeated rows get equal results.
Without any labelled row every text is "und". Other columns are kept; those named like a
result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.common import STEP_BYTES, steps, tidy, utf8

UNKNOWN = "und"
#: Bounds of the training sample, by language and by document.
PER_LANGUAGE, PIECES, PIECE_BYTES = 500, 6, 240
#: Rows of the embedding table for each gram length, its width, and the gram lengths.
BUCKETS_LOG2, WIDTH, GRAMS = 15, 16, (2, 3, 4)
#: The least score kept is that of this share of the held-back pieces that are told rightly,
#: but never above SURE: a text in which one language has a clear majority is kept.
REJECTED_SHARE, SURE = 0.001, 0.5
_LETTER = regex.compile(r"\p{L}")
_ODD = np.uint32(0x9E3779B1)
#: Letters a-z stay, A-Z are lower-cased, other ASCII is a space, other bytes stay.
_FOLD = np.array(
    [x if x >= 128 or 97 <= x <= 122 else x + 32 if 65 <= x <= 90 else 32 for x in range(256)],
    np.uint8,
)


def folded(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts in lower case, other characters as single spaces, a space at each end."""
    rows = len(ends) - 1
    apart = np.full(len(data) + rows + 1, 32, np.uint8)
    place = np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(ends))
    apart[place] = _FOLD[data]
    keep = np.ones(len(apart), bool)
    starts = ends + np.arange(rows + 1)
    space = apart == 32
    keep[1:] = ~(space[1:] & space[:-1])
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return apart[keep], at[starts]


def subwords(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each gram length: the table row of every gram, and where each text's grams are.

    The space that ends a text starts the next, so grams do not cross two texts.
    """
    padded = np.concatenate([data, np.full(4, 32, np.uint8)]).astype(np.uint32)
    word = padded[:-4] | padded[1:-3] << np.uint32(8) | padded[2:-2] << np.uint32(16) | padded[3:-1] << np.uint32(24)
    for k, n in enumerate(GRAMS):
        gram = word if n == 4 else word & np.uint32((1 << 8 * n) - 1)
        row = (gram * _ODD >> np.uint32(32 - BUCKETS_LOG2)) + np.uint32(k << BUCKETS_LOG2)
        first = ends[:-1]
        last = np.maximum(ends[1:] + 1 - n + 1, first)
        yield row, first, np.minimum(last, len(data))


@dataclass
class Model:
    """Languages, the value of every table row for each, a bias, and the least score kept."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    least: float

    def scores(self, data: np.ndarray, ends: np.ndarray, most: int = STEP_BYTES) -> np.ndarray:
        """Probabilities, one row a text."""
        if len(ends) == 2 and len(data) > most:
            sums = [self._sums(part, np.array([0, len(part)])) for part in _pieces(data, most)]
            total, count = sum(s[0] for s in sums), sum(s[1] for s in sums)
        else:
            total, count = self._sums(data, ends)
        logits = total / np.maximum(count, 1)[:, None] + self.bias
        logits -= logits.max(1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(1, keepdims=True)

    def _sums(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sums of the rows of all subwords of each text, and how many these are."""
        rows = len(ends) - 1
        data, ends = folded(data, ends)
        total, count = np.zeros((rows, len(self.languages))), np.zeros(rows)
        for row, first, last in subwords(data, ends):
            for j in range(len(self.languages)):
                sums = np.concatenate([[0.0], np.cumsum(self.table[j][row], dtype=np.float64)])
                total[:, j] += sums[last] - sums[first]
            count += last - first
        return total, count


def _pieces(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """A long text in pieces that end before a space, where there is one."""
    at = 0
    while at < len(data):
        end = at + most
        if end < len(data):
            space = np.flatnonzero(_FOLD[data[at + 1 : end]] == 32)
            end = at + 1 + int(space[-1]) if len(space) else end
        yield data[at:end]
        at = end


def sample(docs: DataFrame, taught: Column, per_language: int = PER_LANGUAGE) -> pd.DataFrame:
    """Pieces of a bounded sample of labelled documents: lang, held, piece.

    Which documents is told by a hash of doc_id and text, so that rows of one doc_id, or without
    one, are drawn apart; equal rows count as one. The bound is kept before the driver.
    """
    usable = docs.where(taught & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.xxhash64("doc_id", "text", F.lit(9))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return pd.DataFrame({"lang": [], "held": [], "piece": []})
    # the share of the hash range that holds about twice the rows wanted; cut exactly below
    share = F.lit(0.0)
    for lang, count in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, 2.0 * per_language / count)).otherwise(share)
    near = usable.where(order.cast("double") / 2.0**64 + 0.5 <= share).where(F.col("text").rlike(r"\p{L}"))
    near = near.select("lang", order.alias("order"), "text").dropDuplicates(["lang", "order"])
    in_order = Window.partitionBy("lang").orderBy("order")
    near = near.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= per_language)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, order, piece = [], [], []
            for name, at, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "order", "text"))):
                if not _LETTER.search(text):
                    continue
                raw = text.encode()
                for i in range(min(PIECES, 1 + len(raw) // PIECE_BYTES)):
                    start = (len(raw) - PIECE_BYTES) * i // max(1, PIECES - 1) if i else 0
                    lang.append(name)
                    order.append(at)
                    # pieces of several lengths: short texts are told from short pieces
                    piece.append(raw[max(0, start) :][: PIECE_BYTES >> (at + i) % 4])
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(lang, pa.string()), "order": pa.array(order, pa.int64()), "piece": pa.array(piece, pa.binary())}
            )

    pieces = near.select("lang", "order", "text").mapInArrow(cut, "lang string, order long, piece binary").toPandas()
    pieces = pieces.sort_values(["order", "piece"], ignore_index=True)
    # a document is held back whole
    return pieces.assign(held=pieces["order"] % 5 == 0).drop(columns="order")


def train(pieces: pd.DataFrame, *, epochs: int = 4, rate: float = 0.5, seed: int = 3) -> Model:
    """The model of labelled pieces."""
    languages = sorted(set(pieces["lang"]))
    if not languages:
        return Model([], np.zeros((0, len(GRAMS) << BUCKETS_LOG2), np.float32), np.zeros(0), 0.0)
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.1, (len(GRAMS) << BUCKETS_LOG2, WIDTH)).astype(np.float32)
    output = np.zeros((len(languages), WIDTH), np.float32)
    bias = np.zeros(len(languages), np.float32)
    bags, answers = [], [languages.index(x) for x in pieces["lang"]]
    for piece in pieces["piece"]:
        raw = np.frombuffer(piece, np.uint8)
        data, ends = folded(raw, np.array([0, len(raw)]))
        rows = np.concatenate([r[a[0] : b[0]] for r, a, b in subwords(data, ends)])
        unique, counts = np.unique(rows, return_counts=True)
        bags.append((unique, (counts / max(1, len(rows))).astype(np.float32)))
    held = pieces["held"].to_numpy()
    taught = np.flatnonzero(~held) if (~held).any() else np.arange(len(pieces))
    done, total = 0, epochs * len(taught)
    for _ in range(epochs):
        for i in random.permutation(taught):
            rows, share = bags[i]
            step = rate * (1 - done / total)
            mean = share @ embedding[rows]
            logits = output @ mean + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[answers[i]] -= 1
            back = error @ output
            output -= step * np.outer(error, mean)
            bias -= step * 0.1 * error
            # scaled up: a mean over many rows gives each a small share of the gradient
            embedding[rows] -= (step * 20) * share[:, None] * back
            done += 1
    table = (output @ embedding.T).astype(np.float32)
    rest = [i for i in np.flatnonzero(held)] or list(taught)
    logits = np.array([table[:, bags[i][0]] @ bags[i][1] + bias for i in rest])
    truth = np.array([answers[i] for i in rest])

    def chances(scale: float) -> np.ndarray:
        x = logits * scale
        x = np.exp(x - x.max(1, keepdims=True))
        return x / x.sum(1, keepdims=True)

    # temperature: the scale with the least log loss on the pieces held back
    scales = np.geomspace(0.05, 4, 61)
    loss = [-np.log(chances(s)[np.arange(len(truth)), truth] + 1e-9).mean() for s in scales]
    scale = float(scales[int(np.argmin(loss))])
    odds = chances(scale)
    right = np.sort(odds.max(1)[odds.argmax(1) == truth])
    least = min(SURE, float(right[int(len(right) * REJECTED_SHARE)])) if len(right) else 0.0
    return Model(languages, np.ascontiguousarray(table * np.float32(scale)), bias * scale, least)


def identified(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The documents (or of them the columns to keep) with lang_pred, score and rejected.

    lang_pred is the likeliest language, whether rejected or not, or "und".
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in keep or docs.columns if c.lower() not in ("lang_pred", "score", "rejected")]
    docs = docs.select(*[F.col(c) for c in kept], F.col("text").alias("text to read"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN])
        for batch in batches:
            text = batch.column(len(kept))
            lettered = np.array([bool(x and _LETTER.search(x)) for x in text.to_pylist()], bool)
            best = np.full(len(text), len(model.languages))
            score = np.zeros(len(text))
            if model.languages:
                data, ends = utf8(text)
                for a, b in steps(ends):
                    odds = model.scores(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
                    best[a:b], score[a:b] = odds.argmax(1), odds.max(1)
            best[~lettered], score[~lettered] = len(model.languages), 0.0
            rejected = (best == len(model.languages)) | (score < model.least)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(rejected)],
                [*kept, "lang_pred", "score", "rejected"],
            )

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(tidy(predict), schema)
