"""Toxicity of texts that may be spelled to hide it: a noisy channel, then a linear score.

Restoration. A writer is thought to spell a word and a channel to disturb it: letters become
look-alike digits and signs, letters are drawn out, signs or spaces are put between letters.
What was observed gives a lattice of letters that may have been meant, each with a cost, and
the Viterbi algorithm finds the likeliest path under a character trigram model. The model is
counted over all documents. A letter that stands twice may be meant once. Neighbouring pieces
of up to SHORT characters, signs included, make one lattice, in which a blank is kept or
dropped, so that the model chooses the word boundaries. Signs at the
edges of a word may be letters or punctuation, which is cheap there and dear elsewhere; the
word is read in each way, as the model alone prefers the shorter one. Pieces of any length are
joined where they make a word that is a feature, unless the character model is clearly against it; a
letter with an accent is also read without it. In a row
of three or more single characters a word may also begin and end at each of them, up to LONGEST
letters, as a trigram tells little about boundaries there. Where
only blanks or only doubled letters can be read in two ways, each choice depends on the
letters next to it alone, and is made without the lattice.

Score. A text is the bag of its words and of their beginnings, as they stand and as restored.
Those that go with the label are found on a bounded sample of labelled documents, by a likelihood-ratio test
over counts of documents; a logistic regression weighs the logarithms of their counts.

Bounds: SAMPLE labelled documents, FEATURES features. Their texts stay on the executors; the
driver gets the features' hashes, and for each document of the sample which of them it has.
The character model has 27^3 counts.

Edge cases: a null or empty text has the score of a text without features. Without labels of
both kinds all scores are the share of label 1, or 0. A null label teaches nothing; of
several labels of one doc_id the largest counts, and of its rows one teaches. Very long texts are read whole. Rows that
share a doc_id are scored each by itself. Other columns do not matter.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Collection, Iterator
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import checkpointed, steps, utf8

#: Bounds of the fit: labelled documents, features, documents that a feature must occur in.
SAMPLE, FEATURES, LEAST_DOCS = 12000, 600, 4
#: Words that a task keeps at hand.
REMEMBERED = 400_000
#: Letters that a digit or sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
}
#: Costs, as negative logarithms of chances, of what the channel does.
LOOK, DRAWN_OUT, DOUBLED, PUT_BETWEEN, LOST = 1.0, 0.5, 2.0, 1.0, 12.0
#: What a word that is a feature in full may cost more than its pieces: features are likelier words.
KNOWN = 4.0
#: Characters of a piece that may be joined with its neighbours; pieces that one lattice holds,
#: and how many of them the next one holds again.
SHORT, PIECES, AGAIN = 3, 4096, 64
#: Letters of a word spelled in single characters, without those that only begin it.
LONGEST = 16
#: Combinations of the signs at both edges of a word that are all read.
MANY_EDGES = 36
_STRETCH = re.compile(rf"(?<!\S)\S{{1,{SHORT}}}(?:\s+\S{{1,{SHORT}}})+(?!\S)")
_SINGLES = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
_LETTER = re.compile(r"[^\W\d_]")
_TWICE = re.compile(r"([a-z])\1")
_WORD = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[0-9@$!|+(]|([a-z])\1\1|[a-z][.\-_*,~'/\u00b7\u2010-\u2015][a-z]")
#: Letters of a word that tell whether it may have a feature; pieces that are joined at most, where
#: one is longer than SHORT.
BEGINNING, JOINED = 4, 4
#: Characters of a piece or stretch up to which it is told beforehand whether it may have a feature.
TOLD = 40
_SIGNS = "".join(LOOKS_LIKE)
_TAIL = re.compile(r"[^\w]+$|^[^\w@$(]+")
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three neighbours among a-z (1 to 26) and everything else (0), over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(27**3, np.int64)
        for batch in batches:
            data, ends = utf8(batch.column(0))
            for a, b in steps(ends):
                symbol = _SYMBOL[data[ends[a] : ends[b]]]
                if len(symbol) > 2:
                    counts += np.bincount((symbol[:-2] * 27 + symbol[1:-1]) * 27 + symbol[2:], minlength=27**3)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(27**3)
    for r in rows:
        out[r["gram"]] = r["n"]
    return out


def costs(counts: np.ndarray) -> list[float]:
    """-log p(third | first two), smoothed by the shorter contexts."""
    three = counts.reshape(27, 27, 27)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + 27)
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(2, keepdims=True) + 5)
    return (-np.log(p3)).reshape(-1).tolist()


class Restorer:
    """Decodes disturbed words under a character model."""

    def __init__(self, model: list[float]):
        self.model = model

    def decode(self, seen: str) -> str:
        """The likeliest word behind one observed word."""
        lattice: list[list[tuple[str, float]]] = []
        i = 0
        while i < len(seen):
            c, end = seen[i], i + 1
            while end < len(seen) and seen[end] == c:
                end += 1
            if c.isalpha():
                if end - i > 2:
                    lattice.append([(c, DRAWN_OUT), (c + c, DRAWN_OUT)])
                elif end - i == 2 and "a" <= c <= "z":
                    lattice.append([(c + c, 0.0), (c, DOUBLED)])
                else:
                    lattice += [[(c, 0.0)]] * (end - i)
            elif c in LOOKS_LIKE:
                drawn = [(x, LOOK) for x in LOOKS_LIKE[c]] + [(x + x, LOOK) for x in LOOKS_LIKE[c] if end - i > 1]
                lattice.append(drawn + [("", LOST)])
            elif c == " ":
                lattice.append([(" ", 0.0), ("", PUT_BETWEEN)])
            else:
                lattice.append([("", PUT_BETWEEN)])
            i = end
        # a state is the last two symbols; it keeps its best path, from its end
        best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None)}
        for choices in lattice:
            following: dict[tuple[int, int], tuple] = {}
            for (a, b), (cost, path) in best.items():
                for letters, more in choices:
                    x, y, total = a, b, cost + more
                    for letter in letters:
                        z = ord(letter) - 96 if "a" <= letter <= "z" else 0
                        total += self.model[(x * 27 + y) * 27 + z]
                        x, y = y, z
                    known = following.get((x, y))
                    if known is None or total < known[0]:
                        following[x, y] = (total, (letters, path))
            best = following
        _, path = min(((cost + self.model[(a * 27 + b) * 27], path) for (a, b), (cost, path) in best.items()), key=lambda x: x[0])
        letters = []
        while path:
            letters.append(path[0])
            path = path[1]
        return "".join(reversed(letters))

    def once(self, word: str) -> str:
        """A word whose only oddities are doubled letters, each meant twice or once: what the
        lattice gives, as the letters before and after a double do not depend on the choice."""

        def choose(m: re.Match) -> str:
            b, c, d = (self._symbol(word, i) for i in (m.start() - 1, m.start(), m.end()))
            model = self.model
            twice = model[(b * 27 + c) * 27 + c] + model[(c * 27 + c) * 27 + d]
            return m[0] if twice <= model[(b * 27 + c) * 27 + d] + DOUBLED else m[1]

        return _TWICE.sub(choose, word)

    @staticmethod
    def _symbol(word: str, i: int) -> int:
        return ord(word[i]) - 96 if 0 <= i < len(word) and "a" <= word[i] <= "z" else 0

    def word(self, token: str) -> str:
        """A piece without spaces, restored if something in it can be read in two ways."""
        if not _ODD.search(token):
            return self.once(token) if _TWICE.search(token) else token
        core = _TAIL.sub("", token)
        if not any(c.isalpha() for c in core):
            return token
        if not _ODD.search(core):
            return self.once(core) if _TWICE.search(core) else token
        return self.decode(core)

    def readings(self, token: str) -> set[str]:
        """A piece without spaces as it stands, restored, and with each number of the signs at
        its edges read as letters, from none to all; what is farther out is punctuation."""
        found = self._readings(token)
        if not token.isascii():
            plain = without_accents(token)
            if plain != token:
                found |= self._readings(plain)
        return found

    def _readings(self, token: str) -> set[str]:
        if not _ODD.search(token):  # most pieces
            return {token, self.once(token)} if _TWICE.search(token) else {token}
        found = {token, self.word(token)}
        inside = [i for i, c in enumerate(token) if c.isalnum()]
        if not inside or not _LETTER.search(token):
            return found
        first, last = inside[0], inside[-1] + 1
        # equal signs in a row are read as one drawn-out sign
        starts = [first, *(i for i in range(first) if token[i] in LOOKS_LIKE and token[i] != token[i - 1 : i])]
        ends = [last, *(i for i in range(last + 1, len(token) + 1) if token[i - 1] in LOOKS_LIKE and token[i - 1] != token[i : i + 1])]
        if len(starts) * len(ends) == 1:
            if last - first < len(token):
                found.add(self.word(token[first:last]))
            return found
        if len(starts) * len(ends) > MANY_EDGES:  # each edge with the other one as none or all
            cuts = {(a, b) for a in starts for b in (last, ends[-1])} | {(a, b) for a in (first, min(starts)) for b in ends}
        else:
            cuts = {(a, b) for a in starts for b in ends}
        for a, b in cuts:
            piece = token[a:b]
            found.add(self.decode(piece) if _ODD.search(piece) else self.once(piece))
        return found

    def joined(self, stretch: str) -> str:
        """Neighbouring short pieces, with blanks where the model has them."""
        pieces = stretch.split()
        if all(len(p) > 1 and p.isalpha() for p in pieces):
            # the two letters on each side are the same whatever is chosen elsewhere
            model, symbol, out = self.model, self._symbol, [pieces[0]]
            for left, right in zip(pieces, pieces[1:]):
                a, b = symbol(left, len(left) - 2), symbol(left, len(left) - 1)
                c, d = symbol(right, 0), symbol(right, 1)
                kept = model[(a * 27 + b) * 27] + model[b * 729 + c] + model[c * 27 + d]
                dropped = model[(a * 27 + b) * 27 + c] + model[(b * 27 + c) * 27 + d] + PUT_BETWEEN
                out += [right] if dropped < kept else [" ", right]
            return "".join(out)
        return self.decode(" ".join(pieces))

    def seams(self, stretch: str) -> float:
        """What it costs more to read pieces of letters as one word than apart. Each blank's share
        depends on the two letters on both sides alone."""
        total = 0.0
        symbols = [self._symbol(stretch, i) for i in range(len(stretch))]
        at = lambda i: symbols[i] if 0 <= i < len(symbols) else 0
        model = self.model
        for i, c in enumerate(stretch):
            if c == " ":
                a, b, x, y = at(i - 2), at(i - 1), at(i + 1), at(i + 2)
                kept = model[(a * 27 + b) * 27] + model[b * 729 + x] + model[x * 27 + y]
                total += model[(a * 27 + b) * 27 + x] + model[(b * 27 + x) * 27 + y] + PUT_BETWEEN - kept
        return total

    def stretches(self, text: str) -> Iterator[str]:
        """Neighbouring short pieces that hold a letter, in parts that overlap."""
        for m in _STRETCH.finditer(text):
            found = m[0]
            if len(found) <= 2 * PIECES:
                parts = [found]
            else:
                pieces = found.split()
                parts = [" ".join(pieces[i : i + PIECES]) for i in range(0, len(pieces), PIECES - AGAIN)]
            yield from (x for x in parts if (x.isascii() and x.islower()) or any(c.isalpha() for c in x))

    def text(self, text: str) -> str:
        """A whole text in lower case, restored."""
        whole = _STRETCH.sub(lambda m: self.joined(m[0]) if any(c.isalpha() for c in m[0]) else m[0], text.lower())
        return " ".join(self.word(t) for t in whole.split())


def without_accents(token: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c))


def spellings(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word + "$", *(word[:n] for n in (4, 5, 6, 7, 8) if len(word) >= n)]


def features(word: str) -> set[int]:
    """Hashes of a word and of its beginnings."""
    return {zlib.crc32(x.encode()) for x in spellings(word)}


def may_begin(starts: Collection[str]) -> tuple[re.Pattern, re.Pattern]:
    """Finds where a reading may have a word with one of these beginnings; what it misses has none.

    The second pattern searches a piece where what the first finds is made a blank: characters that
    no beginning has, which are left out, end a word or are a letter of another word. A
    letter is a letter, drawn out or not, or a sign that looks like it; between two letters signs and
    blanks may be left out. No letter comes before a word, but the same one drawn out; beginnings that
    end with $ are whole words, so no letter follows.
    """
    tree: dict = {}
    for start in starts:
        at = tree
        for letter in re.sub(r"(.)\1+", r"\1", start):
            at = at.setdefault(letter, {})
        at[""] = {}
    letters = re.escape("".join(sorted({x for start in starts for x in start if x != "$" and not x.isascii()})))

    def pattern(at: dict) -> str:
        if "" in at:
            return ""
        signs = re.escape(_SIGNS)
        parts = []
        for letter, after in sorted(at.items()):
            if letter == "$":
                parts.append("(?![a-z])")
            else:
                like = "".join(x for x in LOOKS_LIKE if letter in LOOKS_LIKE[x])
                following = pattern(after)
                parts.append(f"[{letter}{re.escape(like)}]" + (f"[{letter}{signs} ]*{following}" if following else ""))
        return f"(?:{'|'.join(parts)})"

    return re.compile(f"[^a-z{re.escape(_SIGNS)}{letters}]+"), re.compile("(?<![a-z])" + pattern(tree))


class Reader:
    """Features of texts, each different word read once."""

    def __init__(
        self,
        model: list[float],
        chosen: list[int] | None = None,
        starts: frozenset[str] | None = None,
        full: frozenset[str] = frozenset(),
    ):
        self.restorer = Restorer(model)
        self.chosen = None if chosen is None else {x: i for i, x in enumerate(chosen)}
        # of the chosen features, if told: other words have none; and those that are whole words
        self.starts, self.full = starts, full
        told = bool(starts) and all(x.removesuffix("$").isalpha() for x in starts)
        self.other, self.may = may_begin(starts) if told else (None, None)
        self.spelled: dict[int, str] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def _word(self, token: str) -> tuple[int, ...]:
        if self.starts is not None and token.isascii() and token.isalpha() and not _TWICE.search(token):
            return self._chosen((token,))  # it can be read in one way
        if self._barren(token):
            return ()
        return self._chosen({word for x in self.restorer.readings(token) for word in _WORD.findall(x)})

    def _barren(self, piece: str) -> bool:
        """Whether no reading of a piece can have a feature, as far as that is told beforehand."""
        if self.may is None or len(piece) > TOLD:
            return False
        if self.may.search(self.other.sub(" ", piece)):
            return False
        if piece.isascii():
            return True
        # accents become blanks here, which may be left out like them
        plain = unicodedata.normalize("NFKD", piece)
        return len(plain) <= TOLD and not self.may.search(self.other.sub(" ", plain))

    def _stretch(self, stretch: str) -> tuple[int, ...]:
        """Of the words that joining makes; those that stand are counted already."""
        # a row of single characters has words that end anywhere
        if stretch.isascii() and self._barren(stretch) and not _SINGLES.search(" ".join(stretch.split())):
            return ()
        pieces = stretch.split()
        made = set(self.restorer.joined(stretch).split()) - set(pieces)
        words = {word for x in made for y in self.restorer.readings(x) for word in _WORD.findall(y)}
        for m in _SINGLES.finditer(" ".join(pieces)):
            row = m[0].replace(" ", "")
            if any(c.isalpha() for c in row):
                row = self.restorer.decode(row)
                words.update(row[i:j] for i in range(len(row)) for j in range(i + 3, min(i + LONGEST, len(row)) + 1))
        return self._chosen(words)

    def _chosen(self, words: Collection[str]) -> tuple[int, ...]:
        found: set[int] = set()
        for word in words:
            if self.chosen is None:
                found |= features(word)
            elif self.starts is None or (word + "$")[:BEGINNING] in self.starts:
                for spelled in spellings(word):
                    i = self.chosen.get(zlib.crc32(spelled.encode()))
                    if i is not None:
                        found.add(i)
                        self.spelled[i] = spelled
        return tuple(found)

    def _parted(self, tokens: list[str]) -> Iterator[str]:
        """Neighbouring pieces that together are a word which is a feature."""
        starts, full = self.starts, self.full
        for i in [i for i, x in enumerate(map(add, tokens, tokens[1:])) if x[:BEGINNING] in starts]:
            word = tokens[i] + tokens[i + 1]
            for j in range(i + 2, min(i + JOINED, len(tokens)) + 1):
                if word in full:
                    yield " ".join(tokens[i:j])
                word += tokens[j] if j < len(tokens) else ""

    def _made(self, stretch: str) -> tuple[int, ...]:
        """The features of the word made of all pieces of a stretch, where that reading is likely
        enough."""
        if self.restorer.seams(stretch) >= KNOWN:
            return ()
        alone = {x for piece in stretch.split(" ") for x in self._word(piece)}
        return tuple(x for x in self._chosen((stretch.replace(" ", ""),)) if x not in alone)

    def read(self, text: str) -> dict[int, int]:
        """How often each feature occurs."""
        text = text.lower()
        tokens = text.split()
        words = Counter(tokens)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        out: dict[int, int] = {}
        for word, times in words.items():
            found = self.known.get(word)
            if found is None:
                found = self.known[word] = self._word(word)
            for x in found:
                out[x] = out.get(x, 0) + times
        # a stretch has a blank and thus is no word; long ones are not kept at hand
        for stretch, times in Counter(self.restorer.stretches(text)).items():
            found = self.known.get(stretch)
            if found is None:
                found = self._stretch(stretch)
                if len(stretch) <= 64:
                    self.known[stretch] = found
            for x in found:
                out[x] = out.get(x, 0) + times
        if self.full:
            for stretch, times in Counter(self._parted(tokens)).items():
                key = "\n" + stretch  # a stretch of short pieces has an entry of its own
                found = self.known.get(key)
                if found is None:
                    found = self.known[key] = self._made(stretch)
                for x in found:
                    out[x] = out.get(x, 0) + times
        return out


class Model:
    """A character model, features, their weights and a bias, and the beginnings of features."""

    def __init__(
        self, characters: list[float], chosen: list[int], weights: np.ndarray, bias: float, spelled: frozenset[str] = frozenset()
    ):
        self.characters, self.chosen, self.weights, self.bias = characters, chosen, weights, bias
        self.starts = frozenset(x[:BEGINNING] for x in spelled)
        self.full = frozenset(x[:-1] for x in spelled if x.endswith("$"))

    def score(self, found: dict[int, int]) -> float:
        total = self.bias + sum(self.weights[i] * math.log1p(n) for i, n in found.items())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def regression(rows: list[dict[int, int]], labels: np.ndarray, width: int, penalty: float = 0.2) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method with a ridge; rows have counts of features."""
    x = np.zeros((len(rows), width + 1), np.float64)
    x[:, width] = 1
    for i, row in enumerate(rows):
        x[i, list(row)] = np.log1p(np.array(list(row.values()), float))
    ridge = np.full(width + 1, penalty)
    ridge[width] = 1e-3
    w = np.zeros(width + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:width], float(w[width])


def train(docs: DataFrame, labels: DataFrame, taught: Column) -> Model:
    """The model; labels: doc_id, toxic."""
    spark = docs.sparkSession
    characters = costs(trigram_counts(docs))
    told = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(taught)
    told = told.groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(6))
    total = told.count()
    # near the bound by a share of the hash range, then cut at the bound; ids only
    share = min(1.0, 1.1 * SAMPLE / max(total, 1))
    chosen = told.where(order.cast("double") / 2.0**64 + 0.5 <= share).orderBy(order).limit(SAMPLE)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # one row of a doc_id, however many share it
    sample = checkpointed(sample.groupBy("doc_id").agg(F.any_value("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")))
    sample = sample.select("toxic", "text")
    shared = spark.sparkContext.broadcast(characters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Reader(shared.value), (Counter(), Counter())
        sizes = [0, 0]
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(reader.read(text))
                sizes[toxic] += 1
        names = [-1, *(counts[0].keys() | counts[1].keys())]
        values = [[sizes[t], *(counts[t][x] for x in names[1:])] for t in (1, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), *(pa.array(v, pa.int64()) for v in values)], ["feature", "with", "without"])

    counted = sample.mapInArrow(count, "feature long, with long, without long")
    counted = counted.groupBy("feature").agg(F.sum("with").alias("k1"), F.sum("without").alias("k0"))
    counted = counted.where((F.col("feature") == -1) | (F.col("k1") + F.col("k0") >= LEAST_DOCS))
    both = [r for r in counted.where("feature = -1").collect()]
    n1, n0 = (both[0]["k1"], both[0]["k0"]) if both else (0, 0)
    if not n1 or not n0:
        return Model(characters, [], np.zeros(0), 500.0 if n1 else -500.0)

    def part(k: Column, n: int, rate: Column) -> Column:
        """Log-likelihood of k among n at a rate."""
        low = F.greatest(rate, F.lit(1e-9))
        return k * F.log(low) + (F.lit(n) - k) * F.log(F.greatest(1 - rate, F.lit(1e-9)))

    k1, k0 = F.col("k1"), F.col("k0")
    pooled = (k1 + k0) / (n1 + n0)
    ratio = part(k1, n1, k1 / n1) + part(k0, n0, k0 / n0) - part(k1, n1, pooled) - part(k0, n0, pooled)
    ranked = counted.where("feature >= 0").where(k1 * n0 > k0 * n1).withColumn("gain", ratio).where("gain > 10")
    names = [r["feature"] for r in ranked.orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, told = Reader(shared.value, names), 0
        for batch in batches:
            rows = [list(reader.read(x).items()) for x in batch.column(1).to_pylist()]
            spelled = [list(reader.spelled.items())[told:] if not i else [] for i in range(len(rows))]
            told = len(reader.spelled) if rows else told
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.map_(pa.int32(), pa.int32())), pa.array(spelled, pa.map_(pa.int32(), pa.string()))],
                ["toxic", "found", "spelled"],
            )

    rows = sample.mapInArrow(find, "toxic boolean, found map<int,int>, spelled map<int,string>").collect()
    weights, bias = regression([r["found"] for r in rows], np.array([float(r["toxic"]) for r in rows]), len(names))
    return Model(characters, names, weights, bias, frozenset(x for r in rows for x in r["spelled"].values()))


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns to keep, with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        reader = Reader(model.characters, model.chosen, model.starts, model.full)
        for batch in batches:
            scores = [model.score(reader.read(x or "")) for x in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                [*keep, "score", "predicted"],
            )

    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")
    return docs.select(*keep, F.col("text").alias("text to read")).mapInArrow(run, schema)
