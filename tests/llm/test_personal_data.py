"""Personal data: spans against plain patterns, revealing terms against brute force."""

import hashlib
import math
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazaarlens.llm import personal_data
from bazaarlens.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
#: The patterns as stated.
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
COUNTS = ["n_email", "n_ip", "n_card", "n_phone"]


def passes_luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and passes_luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def as_text(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@given(st.text(st.sampled_from("ab.@-+%_ 0123456789()é\n"), max_size=60))
@settings(max_examples=500, deadline=None)
def test_spans_are_those_of_the_patterns(text):
    assert personal_data.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x@y a.b@c-d.e-f.g@h", "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.1 1.1.1.1234", "4539 1488 0343 6467 and 4539-1488-0343-6467-1",
    "+1 (132) 555-1352 +49 (0) 30 1234567 .", "+1234567890123456 +12", "@ @@ a@ @b.c é@é.é ü.x@y.z", "4111111111111111 +4111111111111111",
])
def test_chosen_spans(text):
    assert personal_data.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    n = 2_000_000
    for text in ("a" * n, "1" * n, "1." * n, "a@" * n, "+1" * n, "+1(" * n, "1 " * n, "a." * n + "@" + "b-" * n):
        personal_data.base_spans(text)


def test_the_query_on_whole_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op13_personal_data"](spark, DATA).collect()
    assert len(rows) == len(texts)
    total = 0
    for r in rows:
        want = plain_spans(texts[r["doc_id"]])
        assert [r[c] for c in COUNTS] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(as_text(want).encode()).hexdigest()
        got = [x.split(":") for x in r["spans"].split(",")] if r["spans"] else []
        assert ",".join(":".join(x) for x in got if x[0] != "term") == as_text(want)
        assert [(int(a), personal_data.KINDS.index(k)) for k, a, _ in got] == sorted((int(a), personal_data.KINDS.index(k)) for k, a, _ in got)
        total += len(want)
    assert total > 50
    clean = [r for r in rows if not any(r[c] for c in COUNTS)]
    assert sum(not r["spans"] for r in clean) >= 0.99 * len(clean)


FILLER = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt labore dolore magna aliquyam erat voluptua".split()


def corpus():
    """One entity beside a telling name, one in every second document, one only in copies."""
    texts = []
    for i in range(60):
        words = [FILLER[(i * 7 + k * (i % 5 + 1)) % len(FILLER)] + ("x" if (i + k) % 3 else "") for k in range(40)]
        if i % 2:
            words.insert(30, "write support@shop.example.com thanks")
        if i % 12 == 0:
            words.insert(5 + i % 7, f"Zorblätt lives at z.b@mail.example.org zorba")
        if i == 30:
            words.insert(3, "zorblätt")
        if i in (4, 7):
            words.insert(9, "zorban Zorbas")
        texts.append(" ".join(words))
    texts += ["only copies tell of quux 10.20.30.40 here plugh"] * 9
    return [*texts, None, "", " ", "@", "zorblätt", "x" * 3000]


def brute_terms(texts):
    """Terms that reveal an entity, and whether their beginning may stay."""
    word = r"(?:[0-9A-Za-z]|[^\x00-\x7f])+"
    low = lambda x: "".join(c.lower() if c.isascii() else c for c in x)
    wide = lambda ws: ws | {w[:3] + "*" for w in ws if len(w) > 3}
    whole, shown, mentioned, together = defaultdict(int), defaultdict(set), defaultdict(int), defaultdict(int)
    for text in texts:
        text = text or ""
        for t in wide({low(m[0]) for m in re.finditer(word, text) if len(m[0]) > 2}):
            whole[t] += 1
        spans, contexts = plain_spans(text), defaultdict(set)
        for a, k, b in spans:
            found = [(m.start(), m.end(), low(m[0])) for m in re.finditer(word, text) if len(m[0]) > 2]
            found = [f for f in found if not any(s < f[1] and f[0] < e for s, _, e in spans)]
            before, after = [f for f in found if a - 200 <= f[0] and f[1] <= a], [f for f in found if f[0] >= b and f[1] <= b + 200]
            contexts[text[a:b]] |= {f[2] for f in before[-8:]} | {f[2] for f in after[:8]}
        for e, ws in contexts.items():
            mentioned[e] += 1
            for t in wide(ws):
                shown[e, t].add(frozenset(ws))
                together[e, t] += 1
    reveals = set()
    for (e, t), seen in shown.items():
        chance = together[e, t] / whole[t]
        if len(seen) >= 3 and -math.log2(chance) <= 0.5 and math.log2(chance * len(texts) / mentioned[e]) >= 3:
            reveals.add((e, t))
    out = {}
    for e, t in reveals:
        if not t.endswith("*"):
            out[t] = out.get(t, True) and len(t) > 3 and (e, t[:3] + "*") not in reveals
    return out


def test_terms_against_brute_force(spark):
    texts = corpus()
    rows = [(i if i % 9 else None, t, f"own {i}", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, hash int").repartition(5)
    want = brute_terms(texts)
    assert "zorblätt" in want and "quux" not in want and "write" not in want
    found = personal_data.private_spans(docs)
    expected = []
    for doc_id, text, _, _ in rows:
        spans = plain_spans(text or "")
        terms = [
            (m.start(), 4, m.end()) for m in re.finditer(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", text or "")
            if m[0].lower() in want and not any(s < m.end() and m.start() < e for s, _, e in spans)
        ]
        expected.append((doc_id, as_text(sorted([*spans, *terms]))))
    got = [(r["doc_id"], r["spans"]) for r in personal_data.told(found).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    clean = personal_data.sanitised(docs)
    assert clean.columns == docs.columns
    left = {r["spans"]: r["text"] for r in clean.collect()}
    assert left["own 60"] == "only copies tell of quux [ip] here plugh" and left["own 69"] is None
    mark = "Zor*" if want["zorblätt"] else "[term]"
    assert f"{mark} lives at [email] " in left["own 12"].replace("[term] at", "lives at")


def test_a_general_term_stays_where_it_tells_little(spark):
    texts = [f"{FILLER[i]} {FILLER[i + 1]} marvin {FILLER[i + 2]} called +49 30 123 456 78 on {FILLER[i + 3]}" for i in range(6)]
    texts += [f"marble market {FILLER[i % 9]} margin" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in personal_data.sanitised(docs).collect()}
    assert "mar* " in left[0] and "[phone]" in left[0] and "[term] [phone]" in left[0]
    assert left[20] == texts[20]


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert personal_data.told(personal_data.private_spans(docs)).count() == 0
    assert personal_data.sanitised(docs).count() == 0


def test_words_of_long_texts_are_found_in_pieces(monkeypatch):
    monkeypatch.setattr(personal_data, "STEP_BYTES", 64)
    text = "Ünder the sea 12 " * 40 + "x" * 300 + "é next"
    parts = list(personal_data._parts(text))
    assert b"".join(d.tobytes() for _, d in parts).decode() == text and len(parts) > 5
    found = []
    for before, data in parts:
        assert before == len(b"".join(d.tobytes() for b, d in parts if b < before).decode())
        start, stop, own, wide = personal_data.terms_of(data)
        found += [data[a:b].tobytes().decode().translate(personal_data._LOWER) for a, b in zip(start, stop)]
        if len(start):
            assert own.tolist() == personal_data.hash_of(found[-len(start) :]).tolist()
            general = [personal_data.general(w) or w for w in found[-len(start) :]]
            assert wide.tolist() == personal_data.hash_of(general).tolist()
    assert found == [w.translate(personal_data._LOWER) for w in personal_data._TERM.findall(text) if len(w) > 2]


def test_a_text_of_many_mentions(spark):
    text = "told by ann@example.org and bob@example.org or +49 30 123 456 78 " * 3000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    mentions = personal_data.read(docs).where("entity IS NOT NULL").collect()
    assert {r["entity"]: {t["term"] for t in r["terms"]} for r in mentions} == dict.fromkeys(
        ["email:ann@example.org", "email:bob@example.org", "phone:493012345678"], {"told", "tol*", "and"}
    )


def test_a_hot_entity_is_counted_once_a_context(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("call alice +49 30 123 456 78 now or never").alias("text"))
    table = personal_data.read(docs)
    mentions = table.where("entity IS NOT NULL")
    assert mentions.groupBy("entity", "context").count().collect()[0]["count"] == 4000
    assert personal_data.revealing(mentions.select("entity", "context", "terms"), docs) is None
