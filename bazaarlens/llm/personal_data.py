"""Finds personal data, and the terms near it that would still tell whose it was.

1. Patterns give the protected entities: e-mail and IP addresses, card and phone numbers.
2. Around every mention, the words within WINDOW on each side are its context; each word counts as
   itself and by its beginning, the more general term. Over the whole corpus p(e), p(t) and p(e, t)
   are the shares of documents that hold an entity, a term, and the term in a context of the entity.
3. A term reveals an entity if it leaves at most RESIDUAL bits open, -log2 p(e|t), and tells at
   least GAIN bits, log2 p(e, t) / (p(e) p(t)), and if SUPPORT different contexts show it. Copies of
   a text have one context, so no text reveals by being copied; an entity that stands in many
   documents has little to tell.
4. A term that reveals is marked wherever it stands, outside the entities. In a sanitised text it is
   generalised to its beginning where that does not reveal the same entity, and removed otherwise.

Terms are told by hashes in the passes over all texts and compared as text in the end. Those
passes look for the terms in a Bloom filter of 2^BLOOM_BITS bits, whatever their number, which is
all that is broadcast; false positives go in an exact join. Contexts and counts are combined
before they are shuffled, so a hot entity or term is a number a task.

A word is a run of ASCII letters, digits and characters beyond ASCII, of LEAST characters or
more; ASCII letters count as lower case.

Edge cases: a null or empty text has no spans. Very long texts are searched whole by the
patterns, in time linear in their length, and for terms in pieces. Repeated rows count each as a
document and get equal spans; doc_id may be null or repeated. An empty table gives no rows. Other
columns do not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.common import STEP_BYTES, tidy, written
from bazaarlens.llm.hashing import PrefixHash, mixed

#: What a span may be, in the order that counts for equal starts; the last is the method's.
KINDS = ("email", "ip", "card", "phone", "term")
#: Words of a context on each side, within so many characters; characters of a beginning and of
#: the shortest word.
WINDOW, REACH, BEGINNING, LEAST = 8, 200, 3, 3
#: When a term reveals an entity: different contexts, bits told, bits left open.
SUPPORT, GAIN, RESIDUAL = 3, 3.0, 0.5
BLOOM_BITS = 24
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_TERM = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")
_LOWER = {i: i + 32 for i in range(65, 91)}
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER_BYTE = np.arange(256, dtype=np.uint8)
_LOWER_BYTE[65:91] += 32
_GENERAL = np.uint64(0x9E3779B97F4A7C15)

Span = tuple[int, int, int]


def _emails(text: str) -> Iterator[Span]:
    """From each sign back over the local part, and on over the domain; linear in the length."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, 0, done
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the protected entities, in order."""
    found = list(_emails(text))
    for m in _IP.finditer(text):
        parts = [x.lstrip("0") for x in m[0].split(".")]
        if all(len(x) < 4 and int(x or 0) <= 255 for x in parts):
            found.append((m.start(), 1, m.end()))
    for kind, pattern, least, most in ((2, _CARD, 14, 19), (3, _PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = _NOT_DIGITS.sub("", m[0])
            if least <= len(digits) <= most and (kind == 3 or _luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def entity(text: str, span: Span) -> str:
    """What a span names, however it is spelled."""
    value = text[span[0] : span[2]]
    value = value.translate(_LOWER) if span[1] == 0 else value if span[1] == 1 else _NOT_DIGITS.sub("", value)
    return f"{KINDS[span[1]]}:{value}"


def words_near(text: str, span: Span, spans: list[Span]) -> set[str]:
    """The words of a mention's context, those of entities excepted."""
    found = []
    for a, b in ((max(0, span[0] - REACH), span[0]), (span[2], min(len(text), span[2] + REACH))):
        side = []
        for m in _TERM.finditer(text, a, b):
            cut = m.start() == a > 0 and a != span[2] and _TERM.match(text[a - 1])
            cut = cut or m.end() == b < len(text) and b != span[0] and _TERM.match(text[b])
            if not cut and m.end() - m.start() >= LEAST and not any(s < m.end() and m.start() < e for s, _, e in spans):
                side.append(m[0].translate(_LOWER))
        found += side[-WINDOW:] if b == span[0] else side[:WINDOW]
    return set(found)


def general(word: str) -> str | None:
    """The more general term of a word, if it has one."""
    return word[:BEGINNING] + "*" if len(word) > BEGINNING else None


def hash_of(terms: list[str]) -> np.ndarray:
    """The hashes that terms_of gives."""
    raw = [t.removesuffix("*").encode() for t in terms]
    ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
    starts = ends - [len(x) for x in raw]
    hashes = PrefixHash(np.frombuffer(b"".join(raw), np.uint8)).pieces(starts, ends)
    return np.where([t.endswith("*") for t in terms], mixed(hashes + _GENERAL), hashes)


def terms_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends in some bytes, its hash and that of its general term, which
    is its own if it has none."""
    data = _LOWER_BYTE[data]
    inside = np.concatenate([[False], _WORD_BYTE[data], [False]])
    start, stop = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    letters = np.append(np.flatnonzero((data & 0xC0) != 0x80), [len(data)] * (BEGINNING + 1))
    first = np.searchsorted(letters, start)
    long = letters[first + LEAST - 1] < stop
    start, stop, first = start[long], stop[long], first[long]
    hashes = PrefixHash(data)
    own, cut = hashes.pieces(start, stop), letters[first + BEGINNING]
    wide = np.where(cut < stop, mixed(hashes.pieces(start, np.minimum(cut, stop)) + _GENERAL), own)
    return start, stop, own, wide


def _parts(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """Bytes of a text in pieces that no word crosses, and the characters before each."""
    raw, at, before = np.frombuffer(text.encode(), np.uint8), 0, 0
    while at < len(raw):
        end = min(at + STEP_BYTES, len(raw))
        while end < len(raw) and _WORD_BYTE[raw[end]]:
            following = np.flatnonzero(~_WORD_BYTE[raw[end : end + STEP_BYTES]])
            end = end + int(following[0]) if len(following) else min(end + STEP_BYTES, len(raw))
        yield before, raw[at:end]
        before += int(((raw[at:end] & 0xC0) != 0x80).sum())
        at = end


class Bloom:
    """A bounded filter of 64-bit hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for shift in (0, 20, 40):
            place = hashes >> np.uint64(shift) & np.uint64((1 << BLOOM_BITS) - 1)
            out &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def bloom_of(frame: DataFrame) -> Bloom:
    """The filter of the column hash; combined before the shuffle, a fixed size at the driver."""
    places = F.array(*[F.shiftrightunsigned("hash", n).bitwiseAND(F.lit((1 << BLOOM_BITS) - 1)) for n in (0, 20, 40)])
    place = frame.select(F.explode(places).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    found = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(1 << BLOOM_BITS - 6, np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bloom(words)


_SPANS = "array<struct<start:int,kind:int,end:int>>"
_READ = f"doc_id long, text_hash struct<a:long,b:long>, spans {_SPANS}, entity string, context long, terms array<struct<term:string,hash:long>>"


def _text_hash(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def read(docs: DataFrame) -> DataFrame:
    """A row with the base spans of every document, and one for each entity that it mentions, with
    its context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "spans", "entity", "context", "terms"]
        kinds = {
            "spans": pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])),
            "entity": pa.string(),
            "context": pa.int64(),
            "terms": pa.list_(pa.struct([("term", pa.string()), ("hash", pa.int64())])),
        }
        for batch in batches:
            of: list[int] = []
            out: dict[str, list] = {x: [] for x in kinds}

            def put(i: int, *values: object) -> None:
                of.append(i)
                for x, value in zip(out, values):
                    out[x].append(value)

            for i, text in enumerate(batch.column(2).to_pylist()):
                spans = base_spans(text) if text else []
                put(i, [dict(zip(("start", "kind", "end"), s)) for s in spans], None, None, None)
                contexts: dict[str, set[str]] = {}
                starts, upto = [s[0] for s in spans], list(accumulate((s[2] for s in spans), max))
                for span in spans:
                    near = spans[bisect_right(upto, span[0] - REACH) : bisect_left(starts, span[2] + REACH)]
                    contexts.setdefault(entity(text, span), set()).update(words_near(text, span, near))
                for name, words in contexts.items():
                    if words:
                        terms = sorted(words | {g for g in map(general, words) if g})
                        hashes = hash_of(terms).view(np.int64)
                        context = int(mixed(hashes.view(np.uint64)).sum(dtype=np.uint64).view(np.int64))
                        put(i, None, name, context, [{"term": t, "hash": h} for t, h in zip(terms, hashes.tolist())])
            rows = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(out[x], kinds[x]) for x in kinds)], names
            )

    return docs.select(F.col("doc_id").cast("long"), _text_hash(F.col("text")).alias("text_hash"), "text").mapInArrow(tidy(run), _READ)


def _documents_with(docs: DataFrame, bloom: Bloom) -> DataFrame:
    """hash, documents: in how many documents each term stands, of those the filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, found, held = shared.value, [], 0
        kept = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

        def together() -> tuple[np.ndarray, np.ndarray]:
            hashes, which = np.unique(np.concatenate([kept[0], *(f[0] for f in found)]), return_inverse=True)
            counts = np.concatenate([kept[1], *(f[1] for f in found)])
            return hashes, np.bincount(which, counts, len(hashes)).astype(np.int64)

        for batch in batches:
            own: list[np.ndarray] = []
            for text in batch.column(0).to_pylist():
                if text:
                    seen = [np.unique(np.concatenate(terms_of(data)[2:])) for _, data in _parts(text)]
                    own.append(np.unique(np.concatenate(seen)) if len(seen) > 1 else seen[0])
            if own:
                hashes, counts = np.unique(np.concatenate(own), return_counts=True)
                holds = bloom.holds(hashes)
                found.append((hashes[holds], counts[holds]))
                held += int(holds.sum())
            if held > 1 << 20:
                kept = together()
                found, held = [], 0
        kept = together()
        yield pa.RecordBatch.from_arrays([pa.array(kept[0].view(np.int64)), pa.array(kept[1])], ["hash", "documents"])

    counted = docs.select("text").mapInArrow(tidy(run), "hash long, documents long")
    return counted.groupBy("hash").agg(F.sum("documents").alias("documents"))


def revealing(mentions: DataFrame, docs: DataFrame) -> DataFrame | None:
    """term, hash and general (whether its beginning may stay) of the terms that reveal an entity;
    None if no entity has enough contexts."""
    contexts = mentions.groupBy("entity", "context").agg(F.count("*").alias("n"), F.any_value("terms").alias("terms"))
    contexts = written(contexts)
    entities = contexts.groupBy("entity").agg(F.sum("n").alias("mentioned"), F.count("*").alias("shown"))
    entities = entities.where(F.col("shown") >= SUPPORT).select(F.col("entity").alias("of"), "mentioned")
    # null-safe, so that both sides are shuffled for the join and a hot entity can be split
    usual = contexts.join(entities, F.col("entity").eqNullSafe(F.col("of")))
    pairs = usual.select("entity", "mentioned", "n", F.inline("terms"))
    pairs = pairs.groupBy("entity", "mentioned", "term", "hash").agg(F.sum("n").alias("together"), F.count("*").alias("shown"))
    pairs = written(pairs.where(F.col("shown") >= SUPPORT).drop("shown"))
    if pairs.isEmpty():
        return None
    counts = _documents_with(docs, bloom_of(pairs.select("hash").distinct()))
    whole = docs.count()
    told = pairs.join(counts, "hash")
    chance = F.col("together") / F.col("documents")
    told = told.where(-F.log2(chance) <= RESIDUAL).where(F.log2(chance * F.lit(float(whole)) / F.col("mentioned")) >= GAIN)
    told = told.select("entity", "term", "hash").withColumn("wide", F.col("term").endswith("*"))
    wide = told.where("wide").select("entity", F.col("term").alias("beginning"), F.lit(True).alias("reveals"))
    terms = told.where("NOT wide").withColumn("beginning", F.concat(F.substring("term", 1, BEGINNING), F.lit("*")))
    terms = terms.join(wide, ["entity", "beginning"], "left")
    stays = F.col("reveals").isNull() & (F.length("term") > BEGINNING)
    return terms.groupBy("term", "hash").agg(F.bool_and(stays).alias("general"))


def _places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """text_hash and places (start, end, general) of the terms, for every text that holds one."""
    terms = written(terms)
    shared = docs.sparkSession.sparkContext.broadcast(bloom_of(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = shared.value
        for batch in batches:
            of, found, hashes, starts, ends = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for before, data in _parts(text or ""):
                    start, stop, own, _ = terms_of(data)
                    hit = np.flatnonzero(bloom.holds(own))
                    if len(hit):
                        upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                        for k in hit.tolist():
                            a, b = int(start[k]), int(stop[k])
                            of.append(i)
                            found.append(data[a:b].tobytes().decode().translate(_LOWER))
                            hashes.append(int(own[k : k + 1].view(np.int64)[0]))
                            starts.append(before + int(upto[a]))
                            ends.append(before + int(upto[b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), pa.array(found, pa.string()), pa.array(hashes, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["text_hash", "found", "hash", "start", "end"],
            )

    schema = "text_hash struct<a:long,b:long>, found string, hash long, start int, end int"
    hits = docs.select(_text_hash(F.col("text")).alias("text_hash"), "text").mapInArrow(tidy(run), schema)
    exact = hits.join(terms, "hash").where("found = term").select("text_hash", F.struct("start", "end", "general").alias("place"))
    return exact.groupBy("text_hash").agg(F.sort_array(F.collect_set("place")).alias("places"))


def private_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans (start, kind, end) of the patterns, and places (start, end, general) of
    the terms that reveal an entity, for every document."""
    table = written(read(docs))
    own = table.where("entity IS NULL").select("doc_id", "text_hash", "spans")
    terms = revealing(table.where("entity IS NOT NULL").select("entity", "context", "terms"), docs)
    if terms is None:
        return own.withColumn("places", F.array().cast("array<struct<start:int,end:int,general:boolean>>"))
    places = _places(docs, terms).withColumnRenamed("text_hash", "of")
    # null-safe, so that a text of very many copies can be split
    told = own.join(places, F.col("text_hash").eqNullSafe(F.col("of")), "left").drop("of")
    inside = lambda p: F.exists("spans", lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"]))
    free = F.filter("places", lambda p: ~inside(p))
    return told.withColumn("places", F.coalesce(free, F.array()))


def told(found: DataFrame) -> DataFrame:
    """Of private_spans: doc_id, the counts of the patterns, base_sha256 and all spans as text."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    as_text = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])))
    own = F.transform("places", lambda p: F.struct(p["start"], F.lit(KINDS.index("term")).alias("kind"), p["end"]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:-1]],
        F.sha2(as_text(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        as_text(F.array_sort(F.concat("spans", own))).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The documents with their columns; in text, entities give way to their kind, and terms that
    reveal one to their beginning or to nothing but a mark."""
    found = private_spans(docs).select("text_hash", "spans", "places").dropDuplicates(["text_hash"])
    kept, place = docs.columns, docs.columns.index("text")
    joined = docs.select(*[docs[c] for c in kept], _text_hash(docs["text"]).alias("its hash")).join(
        found.toDF("found hash", "found spans", "found places"), F.col("its hash").eqNullSafe(F.col("found hash")), "left"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            spans, places = (batch.column(i).to_pylist() for i in (len(kept), len(kept) + 1))
            for i, text in enumerate(texts):
                cuts = [(s["start"], s["end"], f"[{KINDS[s['kind']]}]") for s in spans[i] or ()]
                for p in places[i] or ():
                    beginning = text[p["start"] : p["start"] + BEGINNING]
                    cuts.append((p["start"], p["end"], beginning + "*" if p["general"] else "[term]"))
                if cuts:
                    out, done = [], 0
                    for start, end, mark in sorted(cuts):
                        if start >= done:
                            out += [text[done:start], mark]
                        done = max(done, end)
                    texts[i] = "".join([*out, text[done:]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if i == place else batch.column(i) for i in range(len(kept))], kept
            )

    return joined.select(*kept, "found spans", "found places").mapInArrow(tidy(run), docs.schema)
