"""The registered queries on whole small tables: SQL, brute force, round trips, held-out rows."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bazaarlens.llm.queries import QUERIES
from bazaarlens.llm.sql import ORACLE_SQL

SMALL, DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
NAMES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def documents(directory):
    found = duckdb.sql(f"SELECT doc_id, text, lang FROM '{directory}/documents.parquet' ORDER BY doc_id").fetchall()
    return {k: (text or "", lang) for k, text, lang in found}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr)


def test_fingerprints_of_edited_texts(spark):
    docs = documents(DATA)
    rows = {r["doc_id"]: r for r in QUERIES["op2_document_fingerprints"](spark, DATA).collect()}
    order = sorted(docs, reverse=True)
    by_text = defaultdict(set)
    for i, k in enumerate(order):
        text, following = docs[k][0], docs[order[(i + 1) % len(order)]][0]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert rows[k]["n_chars"] == len(text)
        assert rows[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[k]["near_edited"] <= 1 and 0 <= rows[k]["near_next"] <= 1
        if "\n" not in text:
            by_text[text].add(rows[k]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    assert len({rows[k]["fingerprint"] for k in docs}) == len({tuple(sorted(t.split("\n"))) for t, _ in docs.values()})
    nearer = [rows[k]["near_edited"] > rows[k]["near_next"] for k in docs if len(docs[k][0]) > 100]
    assert np.mean(nearer) > 0.97


def shingles(text, n):
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_components(texts, n, percent):
    sets = {k: shingles(t, n) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, s in sets.items():
        for g in s:
            where[g].append(k)
    pairs = {(a, b) for ks in where.values() for a in ks for b in ks if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_ngram_join_is_exact(spark):
    docs = documents(DATA)
    want = brute_components({k: t for k, (t, _) in docs.items()}, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op3_ngram_jaccard_join"](spark, DATA).collect()}
    assert got == want
    assert sum(k != c for k, (_, c) in want.items()) > 20


def test_nearest_neighbours_recall_and_scores(spark):
    directory = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{directory}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, base = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    units = base / np.linalg.norm(base, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in QUERIES["op4_nearest_neighbours"](spark, directory).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        cosine = units @ units[at]
        cosine[at] = -2
        true = set(ids[np.lexsort((ids, -cosine))[:5]])
        found = got[ids[at]]
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        for _, v, s in found:
            assert v != ids[at] and abs(s - cosine[np.flatnonzero(ids == v)[0]]) < 1e-12
        hits += len(true & {v for _, v, _ in found})
        total += 5
    assert hits / total >= 0.9


def test_packing_round_trip(spark):
    docs = documents(SMALL)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op5_packing"](spark, SMALL).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for k, (text, _) in docs.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[k], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at and length > 0
            at += length
        assert at <= 4096 and at & (at - 1) == 0


def test_toxicity_on_held_out_labels(spark):
    directory = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{directory}/labels.parquet'").fetchall())
    rows = QUERIES["op6_toxicity"](spark, directory).collect()
    assert len(rows) == 10000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hit = sum(p and t for p, t in held)
    assert hit / sum(t for _, t in held) > 0.8
    assert hit / sum(p for p, _ in held) > 0.95


def test_suffix_dedup_is_exact(spark):
    raw = {k: t.encode() for k, (t, _) in documents(DATA).items()}
    starts = defaultdict(int)
    for text in raw.values():
        for i in range(len(text) - 199):
            starts[text[i : i + 200]] += 1
    removed = 0
    for r in QUERIES["op8_suffix_dedup"](spark, DATA).collect():
        text = raw[r["doc_id"]]
        edge = np.zeros(len(text) + 1, int)
        for i in range(len(text) - 199):
            if starts[text[i : i + 200]] > 1:
                edge[i] += 1
                edge[i + 200] -= 1
        lost = np.cumsum(edge)[: len(text)] > 0
        kept = bytes(b for b, x in zip(text, lost) if not x)
        runs = int((np.diff(np.concatenate([[0], lost.astype(int)])) == 1).sum())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(text), int(lost.sum()), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        removed += int(lost.sum())
    assert removed > 0


def test_language_on_held_out_documents(spark):
    docs = documents(DATA)
    rows = QUERIES["op9_language_id"](spark, DATA).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]][1] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.98
